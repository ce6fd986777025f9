"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "terraloom", **conf: str) -> SparkSession:
    """A session with the library's defaults; conf overrides them (keys with dots go in a dict)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
