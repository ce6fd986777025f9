"""Log conversion: SQLite log to a Parquet log with schemas, static transforms and a renamed frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import rename_frame
from ..operators.joins import running_number
from ..sources import schema_text, sqlite_log
from ..sources.decode import transforms_message

#: The topic whose frame is renamed, and its new frame.
SECOND_TOPIC, SECOND_FRAME, STATIC_TOPIC = "/lidar_secondary/points", "lidar_secondary", "/tf_static"


def registered(topics: DataFrame, known: dict[str, schema_text.Definition]) -> DataFrame:
    """topics with their schema text; topics of types that can't be resolved go, with all their messages."""
    rows = [(r["id"], r["name"], r["type"], schema_text.schema_text(r["type"], known)) for r in topics.select("id", "name", "type").collect() if r["type"] in known]
    return topics.sparkSession.createDataFrame(rows, "id int, topic string, type string, schema string")


def convert(spark: SparkSession, src: str, dst: str, known: dict[str, schema_text.Definition], transforms: list[tuple] = (), codec: str = "zstd", max_seconds: float = 0, rename: dict[str, str] | None = None) -> DataFrame:
    """Writes the log under dst (messages and schemas) and returns the messages written.

    The time slice is inclusive; a transform message is put in at the first time if there are transforms; sequence
    is the running number of a written message in order of time, then of the source's rows.
    """
    messages = sqlite_log.read_messages(spark, src)
    if max_seconds and (first := sqlite_log.bounds(messages).first()["t_min"]) is not None:
        messages = sqlite_log.read_messages(spark, src, t_max=first + int(max_seconds * 1e9))
    chans = registered(sqlite_log.read_topics(spark, src), known)
    out = messages.join(chans.select(F.col("id").alias("topic_id"), "topic"), "topic_id")
    data = F.col("data")
    for topic, frame in ({SECOND_TOPIC: SECOND_FRAME} if rename is None else rename).items():
        data = F.when(F.col("topic") == topic, rename_frame(F.col("data"), frame)).otherwise(data)
    out = running_number(out.withColumn("data", data), "timestamp", ["timestamp", "row_id"], "sequence")
    out = out.select("topic", F.col("timestamp").alias("log_time"), F.col("timestamp").alias("publish_time"), "sequence", "data")
    if transforms and (t0 := sqlite_log.bounds(messages).first()["t_min"]) is not None:
        one = spark.createDataFrame([(STATIC_TOPIC, t0, t0, 0, bytearray(transforms_message(t0, transforms)))], out.schema)
        out = out.unionByName(one)
    sqlite_log.write_log(out, f"{dst}/messages", codec)
    chans.drop("id").write.mode("overwrite").parquet(f"{dst}/schemas")
    return sqlite_log.read_log(spark, f"{dst}/messages")
