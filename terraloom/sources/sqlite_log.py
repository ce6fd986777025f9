"""Message logs: the SQLite layout (topics, messages) as a data source, and Parquet as the working format."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

TOPICS = "id INT, name STRING, type STRING, serialization_format STRING, offered_qos_profiles STRING"
MESSAGES = "topic_id INT, timestamp BIGINT, data BINARY, row_id BIGINT"


class Slice(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class _Reader(DataSourceReader):
    """Message rows by ranges of row ids; each partition opens the file read-only and streams its range."""

    def __init__(self, options: dict):
        self.path, self.table = options["path"], options.get("table", "messages")
        self.parts = int(options.get("partitions", "8"))
        self.bounds = [(sign, int(options[name])) for name, sign in (("tmin", ">="), ("tmax", "<=")) if name in options]

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        if self.table == "topics":
            return [Slice(0, 0)]
        with self._open() as db:
            lo, hi = db.execute("SELECT min(rowid), max(rowid) FROM messages").fetchone()
        if lo is None:
            return [Slice(0, 0)]
        step = -(-(hi - lo + 1) // self.parts)
        return [Slice(a, min(a + step, hi + 1)) for a in range(lo, hi + 1, step)]

    def read(self, partition):
        with self._open() as db:
            if self.table == "topics":
                for i, name, kind, fmt, qos in db.execute("SELECT id, name, type, serialization_format, offered_qos_profiles FROM topics ORDER BY id"):
                    yield i, name, kind, fmt, qos or ""
            else:
                more = "".join(f" AND timestamp {sign} ?" for sign, _ in self.bounds)
                rows = db.execute(f"SELECT topic_id, timestamp, data, rowid FROM messages WHERE rowid >= ? AND rowid < ?{more}", (partition.lo, partition.hi, *(v for _, v in self.bounds)))
                while some := list(_few(rows)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), (pa.int32(), pa.int64(), pa.binary(), pa.int64()))], ["topic_id", "timestamp", "data", "row_id"])


def _few(rows: sqlite3.Cursor) -> Iterator[tuple]:
    """Rows of a batch: some thousands, or some megabytes of payload."""
    held = n = 0
    while held < 8 << 20 and n < 4096 and (row := rows.fetchone()) is not None:
        held, n = held + len(row[2] or b""), n + 1
        yield row


class _PushedReader(_Reader):
    def pushFilters(self, filters):
        """Comparisons of the timestamp go to SQLite; the rest stays with Spark."""
        signs = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", EqualTo: "="}
        for f in filters:
            if self.table == "messages" and type(f) in signs and f.attribute == ("timestamp",):
                self.bounds.append((signs[type(f)], int(f.value)))
            else:
                yield f


class SqliteLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "terraloom_sqlite_log"

    def schema(self) -> str:
        return TOPICS if self.options.get("table") == "topics" else MESSAGES

    def reader(self, schema) -> DataSourceReader:
        return (_PushedReader if self.options.get("pushdown") == "true" else _Reader)(dict(self.options))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(SqliteLog)
    return spark.read.format("terraloom_sqlite_log").option("table", "topics").load(path)


def read_messages(spark: SparkSession, path: str, partitions: int = 8, t_min: int | None = None, t_max: int | None = None) -> DataFrame:
    """Messages, from t_min and up to t_max if given: the bounds are SQLite's to apply, and so are later comparisons of the
    timestamp where spark.sql.python.filterPushdown.enabled is set."""
    spark.dataSource.register(SqliteLog)
    reader = spark.read.format("terraloom_sqlite_log").option("partitions", partitions).option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for name, t in (("tmin", t_min), ("tmax", t_max)):
        reader = reader if t is None else reader.option(name, t)
    return reader.load(path)


def bounds(messages: DataFrame, t: str = "timestamp") -> DataFrame:
    """(t_min, t_max, n); an empty log has null bounds."""
    return messages.agg(F.min(t).alias("t_min"), F.max(t).alias("t_max"), F.count("*").alias("n"))


def summary(messages: DataFrame, topic: str = "topic") -> DataFrame:
    return messages.groupBy(topic).agg(F.count("*").alias("n"))


def write_log(messages: DataFrame, path: str, codec: str = "zstd") -> None:
    """messages(topic, log_time, publish_time, sequence, data), one folder a topic, in order of time within files and from file to
    file. A topic that is most of the log is cut into ranges of time."""
    codec = {"none": "uncompressed"}.get(codec, codec)
    messages.repartitionByRange("topic", "log_time").sortWithinPartitions("topic", "log_time", "sequence").write.mode("overwrite").option("compression", codec).partitionBy("topic").parquet(path)


def read_log(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """Topics prune partitions."""
    return of_topics(spark.read.parquet(path), topics)


def of_topics(messages: DataFrame, topics: list[str] | None, topic: str = "topic") -> DataFrame:
    return messages.where(F.col(topic).isin(topics)) if topics else messages


def first_of_topics(messages: DataFrame, values: list[str], order: list[str], topic: str = "topic") -> DataFrame:
    """Each topic with the values of its first message: the frame that its scans have, for one."""
    return messages.groupBy(topic).agg(F.min(F.struct(F.struct(*order).alias("o"), F.struct(*values).alias("v"))).alias("m")).select(topic, "m.v.*")


def with_channel(messages: DataFrame, channels: DataFrame, key: str) -> DataFrame:
    """messages of known channels, with what is known of them: one row a topic, so a table that is broadcast."""
    return messages.join(F.broadcast(channels), key)


def inject(messages: DataFrame, first: dict[str, object], t: str) -> DataFrame:
    """messages and one more at their first time, with the given values; none if there are no messages."""
    one = messages.agg(F.min(t).alias(t)).where(F.col(t).isNotNull())
    return messages.unionByName(one.select(t, *[F.lit(v).cast(messages.schema[c].dataType).alias(c) for c, v in first.items()]))
