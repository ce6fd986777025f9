"""Row filters, sampling and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite

#: The position types of a usable pose.
POSITION_TYPES = ("INS_RTKFIXED", "INS_RTKFLOAT", "INS_PSRDIFF", "INS_PSRSP", "NARROW_INT", "NARROW_FLOAT", "L1_FLOAT", "WIDE_INT", "IONOFREE_FLOAT")


def time_slice(df: DataFrame, t: str, span: int) -> DataFrame:
    """Rows up to span after the first, inclusive; a span of 0 keeps all. The bound is one scalar aggregate."""
    if not span:
        return df
    bound = df.agg(F.min(t).alias("__t0"))
    return df.join(F.broadcast(bound), F.col(t) <= F.col("__t0") + span).drop("__t0")


def quality(df: DataFrame, col: str, accepted: Sequence[str] = POSITION_TYPES, accept_all: bool = False) -> DataFrame:
    return df if accept_all else df.where(F.col(col).isin(*accepted))


def systematic_sample(df: DataFrame, step: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every step-th row of each group, from its first."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return df.withColumn("__n", n).where(F.col("__n") % step == 0).drop("__n")


def first_per_group(df: DataFrame, k: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """At most k rows of each group, counted among the rows given; k of 0 or less keeps all."""
    if k <= 0:
        return df
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= k).drop("__n")


def row_cap(df: DataFrame, most: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """At most this many rows, chosen by hash of the keys: the same for any partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(most) if most > 0 else df


def range_ok(x: str, y: str, z: str, near: float, far: float) -> Column:
    """near <= distance <= far in single precision; finite coordinates only."""
    x, y, z = (F.col(c).cast("float") for c in (x, y, z))
    r2 = x * x + y * y + z * z
    return finite(x) & finite(y) & finite(z) & r2.between(F.lit(near * near).cast("float"), F.lit(far * far).cast("float"))


def inside_box(cols: Sequence[str], box: Sequence[float]) -> Column:
    """Within the closed intervals (x_min, x_max, y_min, y_max, z_min, z_max)."""
    out = F.lit(True)
    for i, c in enumerate(cols):
        out = out & F.col(c).cast("double").between(float(box[2 * i]), float(box[2 * i + 1]))
    return out


def parse_box(text: str | None) -> tuple[float, ...] | None:
    """Six numbers with each minimum below its maximum; none, off or nothing disables the box."""
    if text is None or text.strip().lower() in ("", "none", "off"):
        return None
    box = tuple(float(x) for x in text.split(","))
    if len(box) != 6 or any(box[i] >= box[i + 1] for i in (0, 2, 4)):
        raise ValueError(f"a box is x_min,x_max,y_min,y_max,z_min,z_max: {text!r}")
    return box


def z_bounds(track: DataFrame, z: str, below: float, above: float, low: float | None = None, high: float | None = None) -> tuple[float, float]:
    """The gate around a track's heights; given values override. One aggregate row reaches the driver. A track without
    heights has no gate: an error, unless both values are given."""
    row = track.agg(F.min(z), F.max(z)).first()
    if row[0] is None:
        if low is None or high is None:
            raise ValueError("the track has no heights")
        return low, high
    return row[0] - below if low is None else low, row[1] + above if high is None else high


def funnel(df: DataFrame, by: str, steps: dict[str, Column], topics: DataFrame | None = None) -> DataFrame:
    """Rows of each group that pass the first step, the first two, and so on; groups without rows count zero. kept_pct is the
    share of all rows that pass all steps; with steps after_range and after_ego, ego_pct is the share of rows in range that the box removes."""
    passed, aggs = F.lit(True), [F.count("*").alias("raw")]
    for name, test in steps.items():
        passed = passed & F.coalesce(test, F.lit(False))
        aggs.append(F.sum(passed.cast("long")).alias(name))
    out = df.groupBy(by).agg(*aggs)
    if topics is not None:
        out = topics.select(by).distinct().join(out, by, "left").fillna(0)
    names = list(steps)
    if "after_range" in names and "after_ego" in names:
        out = out.withColumn("ego_pct", F.round(100.0 * (F.col("after_range") - F.col("after_ego")) / F.greatest(F.col("after_range"), F.lit(1)), 4))
    return out.withColumn("kept_pct", F.round(100.0 * F.col(list(steps)[-1]) / F.greatest(F.col("raw"), F.lit(1)), 4))


def rename_frame(payload: Column, name: str) -> Column:
    """A scan payload with another frame id: little-endian length at byte 12, text with its final NUL, padding to four
    bytes from the payload's start at byte 4; the rest as it was."""
    byte = lambda i: F.conv(F.hex(F.substring(payload, i, 1)), 16, 10).cast("int")
    old = byte(13) + byte(14) * 256 + byte(15) * 65536
    size = len(name.encode()) + 1
    head = size.to_bytes(4, "little") + name.encode() + b"\0" * (1 + (-(12 + size)) % 4)
    start = F.lit(17) + old + F.pmod(-(old + 12), F.lit(4))
    return F.concat(F.substring(payload, 1, 12), F.lit(bytearray(head)), F.substr(payload, start))
