"""Lineage cuts in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a temporary one, in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="terraloom-")


def materialise(df: DataFrame) -> DataFrame:
    """Writes df once to the shared folder and reads it back: later uses neither repeat nor depend on its lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/terraloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
