"""Ordered joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import rotation
from ..scratch import shuffle_width


def asof_nearest(left: DataFrame, right: DataFrame, t: str, tolerance: int, right_t: str | None = None, right_seq: Sequence[str] = (), by: Sequence[str] = (), values: Sequence[str] = ()) -> DataFrame:
    """left with the values of the right row nearest in time, and `dt`; rows without one within the tolerance go.

    Candidates are the first right row at or after the time and the last before it, in order of
    right_seq among equal times; of two equally near, the later. Time is cut into buckets that are some
    tolerances wide, and right rows go to the one or two they can reach, so that no key's whole history is one
    task. Within a bucket, two running windows look back and ahead in linear time.
    """
    right_t = right_t or t
    width = max(1, tolerance) * 64
    bucket = lambda c: F.floor(c / width)
    item = F.struct(F.col(right_t).alias("__t"), *[F.col(c) for c in values])
    r = right.where(F.col(right_t).isNotNull()).withColumn("__b", F.explode(F.sequence(bucket(F.col(right_t) - tolerance), bucket(F.col(right_t) + tolerance))))
    r = r.select(*by, "__b", F.col(right_t).alias("__at"), F.lit(1).alias("__kind"), F.struct(*right_seq).alias("__seq") if right_seq else F.lit(0).alias("__seq"), item.alias("__item"))
    q = left.where(F.col(t).isNotNull()).select(*by, bucket(F.col(t)).alias("__b"), F.col(t).alias("__at"), F.lit(0).alias("__kind"), F.struct(*[F.col(c) for c in left.columns]).alias("__row"))
    both = q.unionByName(r, allowMissingColumns=True)
    part = Window.partitionBy(*by, "__b")
    back = part.orderBy("__at", "__kind", "__seq").rowsBetween(Window.unboundedPreceding, -1)
    ahead = part.orderBy(F.desc("__at"), F.desc("__kind"), F.desc("__seq")).rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("__prev", F.last("__item", True).over(back)).withColumn("__next", F.last("__item", True).over(ahead)).where(F.col("__kind") == 0)
    gap = lambda c: F.abs(F.col(f"{c}.__t") - F.col("__at"))
    pick = F.when(F.col("__prev").isNull() | (gap("__next") <= gap("__prev")), F.col("__next")).otherwise(F.col("__prev"))
    pick = F.when(F.col("__next").isNull(), F.col("__prev")).otherwise(pick)
    out = both.withColumn("__pick", pick).where(F.abs(F.col("__pick.__t") - F.col("__at")) <= tolerance)
    return out.select("__row.*", *[F.col(f"__pick.{c}").alias(c) for c in values], (F.col("__pick.__t") - F.col("__at")).alias("dt"))


def asof_forward(left: DataFrame, right: DataFrame, key: str, values: Sequence[str], by: Sequence[str] = (), right_order: Sequence[str] = ()) -> DataFrame:
    """left with the values of the first right row whose key is at least its own, or else of the last right row.

    Without by, keys are cut into ranges of about as many right rows each, so that no task sorts all rows: a row whose own
    range has no answer takes the first right row of a later one. One row a range reaches the driver.
    """
    if not by and (edges := _edges(right, key)):
        return _forward_by_ranges(left, right, key, values, right_order, edges)
    item = F.struct(*[F.col(c) for c in values])
    order = F.struct(*right_order) if right_order else F.lit(0)
    r = right.select(*by, F.col(key).alias("__k"), F.lit(1).alias("__kind"), order.alias("__seq"), item.alias("__item"))
    q = left.select(*by, F.col(key).alias("__k"), F.lit(0).alias("__kind"), F.struct(*[F.col(c) for c in left.columns]).alias("__row"))
    both = q.unionByName(r, allowMissingColumns=True)
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ahead = part.orderBy(F.desc("__k"), F.desc("__kind"), F.desc("__seq")).rowsBetween(Window.unboundedPreceding, -1)
    final = F.max(F.when(F.col("__kind") == 1, F.struct("__k", "__seq", "__item"))).over(part)
    both = both.withColumn("__next", F.last("__item", True).over(ahead)).withColumn("__last", final).where(F.col("__kind") == 0)
    return both.select("__row.*", *[F.coalesce(F.col(f"__next.{c}"), F.col(f"__last.__item.{c}")).alias(c) for c in values])


def _edges(df: DataFrame, key: str) -> list[float]:
    """Keys that cut the rows into ranges of about equal size, as many as a shuffle has parts."""
    parts = shuffle_width(df.sparkSession)
    return sorted(set(df.approxQuantile(key, [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []


def _range_of(key: str, edges: list[float]) -> Column:
    """The number of edges below the key."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(key).cast("double")))


def running_number(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """df with the number of each row, from 0, in the order given, which begins with the key. Rows are numbered within ranges of the
    key and the counts of the ranges before added, one number a range, so that no task sorts all rows."""
    df = df.withColumn("__part", _range_of(key, _edges(df, key)) if df.limit(1).count() else F.lit(0))
    starts, total = {}, 0
    for r in sorted(df.groupBy("__part").agg(F.count("*").alias("n")).collect()):
        starts[r["__part"]], total = total, total + r["n"]
    start = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("__part")) if starts else F.lit(0)
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return df.withColumn(name, (own + start).cast("long")).drop("__part")


def _forward_by_ranges(left: DataFrame, right: DataFrame, key: str, values: Sequence[str], right_order: Sequence[str], edges: list[float]) -> DataFrame:
    order = F.struct(*right_order) if right_order else F.lit(0)
    item = F.struct(F.col(key).alias("k"), order.alias("s"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    r = right.where(F.col(key).isNotNull()).select(_range_of(key, edges).alias("part"), item.alias("item"))
    ends = {x["part"]: (x["lo"], x["hi"]) for x in r.groupBy("part").agg(F.min("item").alias("lo"), F.max("item").alias("hi")).collect()}
    if not ends:
        return left.withColumns({c: F.lit(None).cast(right.schema[c].dataType) for c in values})
    kind = r.schema["item"].dataType
    later = [(p, next((ends[q][0] for q in sorted(ends) if q > p), ends[max(ends)][1])) for p in range(len(edges) + 1)]
    after = left.sparkSession.createDataFrame(later, StructType([StructField("part", IntegerType()), StructField("later", kind)]))
    row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(left.columns)])
    q = left.select(_range_of(key, edges).alias("part"), F.col(key).alias("k"), F.lit(0).alias("kind"), row.alias("row"), F.lit(None).cast(kind).alias("item"))
    both = q.unionByName(r.select("part", F.col("item.k").alias("k"), F.lit(1).alias("kind"), F.lit(None).cast(q.schema["row"].dataType).alias("row"), "item"))
    ahead = Window.partitionBy("part").orderBy(F.desc("k"), F.desc("kind"), F.desc("item")).rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("next", F.last("item", True).over(ahead)).where("kind = 0").join(F.broadcast(after), "part", "left")
    pick = F.coalesce("next", "later")
    own = [F.col("row").getField(f"f{i}").alias(c) for i, c in enumerate(left.columns) if c not in values]
    return both.select(*own, *[pick.getField(f"v{i}").alias(c) for i, c in enumerate(values)])


def apply_static(points: DataFrame, transforms: DataFrame, key: str, xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """points with x, y, z moved by the transform of their key (r11 to r33, tx, ty, tz); identity where there is
    none. All columns of points stay, whatever their names. Spark broadcasts the transforms while they are as small as its threshold."""
    names = [f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)]
    row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(points.columns)])
    joined = points.select(F.col(key).alias("key"), row.alias("row")).join(transforms.select(F.col(key).alias("key"), *names, "tx", "ty", "tz"), "key", "left")
    at = {c: F.col("row").getField(f"f{i}") for i, c in enumerate(points.columns)}
    r = [[F.coalesce(F.col(f"r{i}{j}"), F.lit(float(i == j))) for j in (1, 2, 3)] for i in (1, 2, 3)]
    t = tuple(F.coalesce(F.col(c), F.lit(0.0)) for c in ("tx", "ty", "tz"))
    at.update(zip(xyz, rotation.apply(r, tuple(at[c].cast("double") for c in xyz), t)))
    return joined.select(*[x.alias(c) for c, x in at.items()])
