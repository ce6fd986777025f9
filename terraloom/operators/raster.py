"""Sparse rasters: a row (ix, iy, val) for each cell that holds a value."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite
from ..scratch import materialise
from .components import connected_components

_FOUR, _EIGHT = ((1, 0), (0, 1)), tuple((a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)


def _shifted(offsets: Sequence[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct((F.col("ix") + a).alias("ix"), (F.col("iy") + b).alias("iy")) for a, b in offsets])).alias("c")


def rasterise(points: DataFrame, cell: float, bounds: tuple[float, float, float, float], x: str = "x", y: str = "y") -> DataFrame:
    """points with ix, iy: truncated cells from (x_min, x_max, y_min, y_max), clipped to the grid. Points without a finite place go."""
    x0, x1, y0, y1 = bounds
    size = lambda a, b: math.ceil((b - a) / cell) + 1
    at = lambda c, a, n: F.least(F.greatest(((F.col(c).cast("double") - F.lit(float(a))) / cell).cast("long"), F.lit(0)), F.lit(n - 1))
    return points.where(finite(F.col(x)) & finite(F.col(y))).withColumn("ix", at(x, x0, size(x0, x1))).withColumn("iy", at(y, y0, size(y0, y1)))


def box_smooth(grid: DataFrame, radius: int = 1) -> DataFrame:
    """Each cell's mean over the populated cells of its (2r + 1) square. Values scatter to their neighbours, one shuffle."""
    if radius <= 0:
        return grid
    reach = range(-radius, radius + 1)
    spread = grid.select(_shifted([(a, b) for a in reach for b in reach]), "val", F.lit(0).alias("__own"))
    spread = spread.select("c.*", "val").withColumn("own", F.lit(False)).unionByName(grid.select("ix", "iy", F.lit(None).cast("double").alias("val"), F.lit(True).alias("own")))
    g = spread.groupBy("ix", "iy").agg(F.avg("val").alias("val"), F.max("own").alias("own"))
    return g.where("own").drop("own")


def _id(ix: Column, iy: Column) -> Column:
    return F.shiftleft(ix.cast("long"), 32).bitwiseOR(iy.cast("long").bitwiseAND((1 << 32) - 1))


def components(cells: DataFrame) -> DataFrame:
    """cells(ix, iy) with label: the least packed id of the four-connected component."""
    own = cells.select("ix", "iy").distinct().withColumn("id", _id(F.col("ix"), F.col("iy")))
    pairs = own.select("id", _shifted(_FOUR)).select("id", "c.*").withColumn("to", _id(F.col("ix"), F.col("iy")))
    edges = pairs.join(own.select(F.col("id").alias("to")), "to").select(F.col("id").alias("a"), F.col("to").alias("b"))
    roots = connected_components(edges)
    return own.join(roots, own.id == roots.node, "left").select("ix", "iy", F.coalesce("root", "id").alias("label"))


def drop_small(grid: DataFrame, least: int) -> DataFrame:
    """grid without the components of fewer cells; 0 or less keeps all."""
    if least <= 0:
        return grid
    lab = components(grid)
    big = lab.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("label")
    return grid.join(lab.join(big, "label", "left_semi").select("ix", "iy"), ["ix", "iy"], "left_semi")


def _fill(grid: DataFrame, least: int) -> DataFrame:
    """Empty cells with enough populated neighbours, at their mean."""
    spread = grid.select(_shifted(_EIGHT), "val").select("c.*", "val")
    near = spread.groupBy("ix", "iy").agg(F.avg("val").alias("val"), F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
    return near.join(grid.select("ix", "iy"), ["ix", "iy"], "left_anti")


def enclosed_runs(grid: DataFrame, nx: int, ny: int) -> DataFrame:
    """(ix, lo, hi): runs of empty cells of the nx * ny grid whose four-connected component doesn't reach the grid's border.

    Only gaps between populated cells of a column are looked at, as one row each: empty cells before the first and after the last
    reach the border, and so does what touches those of the columns beside it.
    """
    column = Window.partitionBy("ix").orderBy("iy")
    gaps = grid.select("ix", "iy", (F.lag("iy").over(column) + 1).alias("lo")).where("lo < iy").select("ix", "lo", (F.col("iy") - 1).alias("hi"))
    ends = materialise(grid.groupBy("ix").agg(F.min("iy").alias("first"), F.max("iy").alias("last")))
    side = lambda d, n: ends.select((F.col("ix") - d).alias("ix"), F.col("first").alias(f"f{n}"), F.col("last").alias(f"l{n}"))
    out = lambda n: F.coalesce((F.col("lo") < F.col(f"f{n}")) | (F.col("hi") > F.col(f"l{n}")), F.lit(True))
    gaps = gaps.join(side(-1, 0), "ix", "left").join(side(1, 1), "ix", "left")
    edge = out(0) | out(1) | F.col("ix").isin(0, nx - 1) | (F.col("lo") <= 0) | (F.col("hi") >= ny - 1)
    gaps = materialise(gaps.select("ix", "lo", "hi", edge.alias("edge"), _id(F.col("ix"), F.col("lo")).alias("id")))
    beside = gaps.select((F.col("ix") - 1).alias("ix"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("id").alias("b"))
    links = gaps.join(beside, "ix").where("lo <= hi2 AND lo2 <= hi").select(F.col("id").alias("a"), "b")
    lab = materialise(gaps.join(connected_components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("root", "id")))
    inner = materialise(lab.groupBy("label").agg(F.max("edge").alias("out")).where(~F.col("out")).select("label"))
    return lab.join(inner, "label", "left_semi").select("ix", "lo", "hi")


def enclosed(grid: DataFrame, nx: int, ny: int) -> DataFrame:
    """(ix, iy): the cells of enclosed_runs()."""
    return enclosed_runs(grid, nx, ny).select("ix", F.explode(F.sequence("lo", "hi")).alias("iy"))


def fill_holes(grid: DataFrame, nx: int, ny: int, passes: int = 4, least: int = 3) -> DataFrame:
    """Fills enclosed cells with enough of eight neighbours, all at once in each pass; enclosure is found anew.
    Each pass is written, so that the grid is read from its source once."""
    grid = materialise(grid.select("ix", "iy", "val"))
    for _ in range(passes):
        inner = enclosed_runs(grid, nx, ny).withColumnRenamed("ix", "jx")
        new = _fill(grid, least)
        new = new.join(inner, (new["ix"] == inner["jx"]) & new["iy"].between(inner["lo"], inner["hi"]), "left_semi")
        grid = materialise(grid.unionByName(new.select("ix", "iy", "val")))
    return grid


def thicken(grid: DataFrame, nx: int, ny: int, passes: int = 2) -> DataFrame:
    """Fills cells of the nx * ny grid with two neighbours in the first pass, three in later ones. Each pass is written."""
    grid = materialise(grid.select("ix", "iy", "val"))
    for k in range(passes):
        new = _fill(grid, 2 if k == 0 else 3).where(F.col("ix").between(0, nx - 1) & F.col("iy").between(0, ny - 1))
        grid = materialise(grid.unionByName(new.select("ix", "iy", "val")))
    return grid
