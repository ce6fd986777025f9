"""Voxel and cell aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pack_key, voxel_index

CHANNELS = ("x", "y", "z", "i")


def voxel_sums(points: DataFrame, size: float, cols: Sequence[str] = CHANNELS) -> DataFrame:
    """(key, sx, sy, sz, si, n) by packed cell: the state that merges under any split of the input."""
    if size <= 0:
        raise ValueError("a voxel's side is positive")
    x, y, z = (F.col(c).cast("float") for c in cols[:3])
    keyed = points.withColumn("key", pack_key(voxel_index(x, size), voxel_index(y, size), voxel_index(z, size)))
    return keyed.groupBy("key").agg(*[F.sum(F.col(c).cast("float").cast("double")).alias(f"s{c}") for c in cols], F.count("*").alias("n"))


def merge_sums(*parts: DataFrame) -> DataFrame:
    """Sums of several batches as one."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("key").agg(*[F.sum(c).alias(c) for c in out.columns if c not in ("key", "n")], F.sum("n").alias("n"))


def voxel_means(sums: DataFrame) -> DataFrame:
    """(key, x, y, z, i, n): means in single precision."""
    return sums.select("key", *[(F.col(c) / F.col("n")).cast("float").alias(c[1:]) for c in sums.columns if c not in ("key", "n")], "n")


def voxel_mean(points: DataFrame, size: float = 0.2, cols: Sequence[str] = CHANNELS) -> DataFrame:
    return voxel_means(voxel_sums(points, size, cols))


def cell_percentile(points: DataFrame, by: Sequence[str], value: str, q: float, name: str = "val") -> DataFrame:
    """The exact percentile of each cell, linear between values; cells without values have no row."""
    return points.where(F.col(value).isNotNull()).groupBy(*by).agg(F.percentile(F.col(value).cast("double"), q).alias(name))
