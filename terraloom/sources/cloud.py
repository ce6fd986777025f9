"""Binary point-cloud files: an ASCII header, then x, y, z, intensity as little-endian single floats."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .parts import write_parts

_NEED = {"FIELDS": "x y z intensity", "SIZE": "4 4 4 4", "TYPE": "F F F F", "DATA": "binary"}


def parse_header(raw: bytes) -> tuple[int, int]:
    """(points, bytes of header); raises ValueError for any layout but the one this format has."""
    found, at = {}, 0
    while "DATA" not in found:
        end = raw.find(b"\n", at)
        if end < 0:
            raise ValueError("the header has no DATA line")
        line, at = raw[at:end].decode("ascii", "replace").strip(), end + 1
        if line and not line.startswith("#"):
            key, _, value = line.partition(" ")
            found[key.upper()] = " ".join(value.split())
    for key, want in _NEED.items():
        if found.get(key, "").lower() != want.lower():
            raise ValueError(f"{key} is {found.get(key)!r}, not {want!r}")
    n = int(found.get("POINTS") or found.get("WIDTH") or 0)
    if n <= 0:
        raise ValueError("the file has no points")
    return n, at


def header(n: int) -> bytes:
    """Fixed text but for the number of points."""
    lines = ["# .PCD v0.7 - Point Cloud Data file format", "VERSION 0.7", "FIELDS x y z intensity", "SIZE 4 4 4 4", "TYPE F F F F", "COUNT 1 1 1 1", f"WIDTH {n}", "HEIGHT 1", "VIEWPOINT 0 0 0 1 0 0 0", f"POINTS {n}", "DATA binary"]
    return ("\n".join(lines) + "\n").encode()


class Span(InputPartition):
    def __init__(self, lo: int, hi: int, start: int):
        super().__init__((lo, hi))
        self.lo, self.hi, self.start = lo, hi, start


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rowsPerPartition", 4_000_000))

    def partitions(self):
        with open(self.path, "rb") as f:
            n, start = parse_header(f.read(65536))
        if os.path.getsize(self.path) - start < 16 * n:
            raise ValueError("the payload is shorter than the header says")
        return [Span(a, min(a + self.rows, n), start) for a in range(0, n, self.rows)]

    def read(self, span):
        with open(self.path, "rb") as f:
            f.seek(span.start + 16 * span.lo)
            for a in range(span.lo, span.hi, 1 << 17):
                b = min(a + (1 << 17), span.hi)
                x = np.frombuffer(f.read(16 * (b - a)), "<f4").reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, b)), *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(4))], ["idx", "x", "y", "z", "i"])


class CloudFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "terraloom_cloud"

    def schema(self) -> str:
        return "idx BIGINT, x FLOAT, y FLOAT, z FLOAT, i FLOAT"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_cloud(spark: SparkSession, path: str, rows_per_partition: int = 4_000_000) -> DataFrame:
    """Byte ranges of one file, which all executors must see."""
    spark.dataSource.register(CloudFile)
    return spark.read.format("terraloom_cloud").option("rowsPerPartition", rows_per_partition).load(path)


def write_cloud(points: DataFrame, path: str, order: str = "key") -> int:
    """One file in the given order, from parts that tasks write. Returns the number of points."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    names = ("x", "y", "z", "i")
    render = lambda batch: np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype("<f4") for k in range(4)], 1).tobytes()
    return write_parts(points.select(F.col(order).alias("__order"), *[F.col(c).cast("float").alias(c) for c in names]), ["__order"], names, path, render, header)
