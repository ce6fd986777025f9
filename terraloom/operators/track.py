"""Operators over ordered tracks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite, safe


def _order(by: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*by).orderBy(*order)


def arclength(track: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "along") -> DataFrame:
    """track with the plane length from its first point."""
    w = _order(by, order)
    step = F.coalesce(F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)), F.lit(0.0))
    return track.withColumn("__d", step).withColumn(name, F.sum("__d").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__d")


def tangents(track: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """track with tx, ty: central differences, one-sided at the ends, to length one in the plane; zero where points stand still."""
    w = _order(by, order)
    d = {c: F.coalesce(F.lead(c).over(w), F.col(c)) - F.coalesce(F.lag(c).over(w), F.col(c)) for c in ("x", "y")}
    out = track.withColumns({f"__d{c}": e for c, e in d.items()})
    norm = safe(F.hypot("__dx", "__dy"))
    return out.withColumn("tx", F.col("__dx") / norm).withColumn("ty", F.col("__dy") / norm).drop("__dx", "__dy")


def lane_offsets(track: DataFrame, by: Sequence[str], order: Sequence[str], half_width: float = 1.75) -> DataFrame:
    """track with lx, ly and rx, ry: points half a lane to the left and to the right."""
    t = tangents(track, by, order)
    sides = {f"{s}{c}": F.col(c) + sign * half_width * n for s, sign in (("l", 1.0), ("r", -1.0)) for c, n in (("x", -F.col("ty")), ("y", F.col("tx")))}
    return t.withColumns(sides)


def greedy(xyz: np.ndarray, kept: np.ndarray | None, step: float) -> list[int]:
    """Places of the first point (if none is kept before) and of each point at least step from the one kept last."""
    picks, at, ahead = [], 0, 64
    if kept is None and len(xyz):
        picks, kept, at = [0], xyz[0], 1
    while at < len(xyz):
        d = xyz[at : at + ahead] - kept
        far = np.flatnonzero(np.sqrt(d[:, 0] ** 2 + d[:, 1] ** 2 + d[:, 2] ** 2) >= step)
        if len(far):
            at += int(far[0])
            picks.append(at)
            kept, at, ahead = xyz[at], at + 1, max(16, 2 * int(far[0]))
        else:
            at, ahead = at + ahead, min(2 * ahead, 1 << 14)
    return picks


def decimate(track: DataFrame, by: Sequence[str], order: Sequence[str], step: float, keep_last: bool = False) -> DataFrame:
    """Of each track the first point, and each at least step from the last one kept; with keep_last also the
    final point, unless it has the position of the last one kept. The state is one point, so that a
    track streams through its task batch by batch, sorted by Spark, in bounded memory. Points without a finite place go."""
    ok = finite(F.col("x")) & finite(F.col("y")) & finite(F.col("z"))
    sorted_ = track.where(ok).withColumn("__key", F.struct(*by)).repartition("__key").sortWithinPartitions("__key", *order)
    names = track.columns
    places = [names.index(c) for c in "xyz"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, last = None, None, None  # of the track that goes on: its key, the point kept last, its last row so far
        for batch in batches:
            if not len(batch):
                continue
            xyz = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in places], 1)
            rows = pa.RecordBatch.from_arrays(batch.columns[: len(names)], names)
            picks: list[int] = []
            for a, b in _runs(batch.column(len(names))):
                own = batch.column(len(names))[a].as_py()
                if own != key:
                    if keep_last and last is not None and tuple(last[1]) != tuple(kept):
                        if a == 0:
                            yield last[0]
                        else:
                            picks.append(a - 1)
                    key, kept = own, None
                found = [a + i for i in greedy(xyz[a:b], kept, step)]
                picks += found
                if found:
                    kept = xyz[found[-1]]
                last = rows.slice(b - 1, 1), xyz[b - 1]
            yield rows.take(pa.array(picks, pa.int64()))
        if keep_last and last is not None and tuple(last[1]) != tuple(kept):
            yield last[0]

    return sorted_.select(*names, "__key").mapInArrow(run, track.schema)


def _runs(keys: pa.Array) -> list[tuple[int, int]]:
    """[from, to) of the runs of equal keys."""
    same = np.ones(max(len(keys) - 1, 0), bool)
    for part in keys.flatten():
        code = part.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        same &= code[1:] == code[:-1]
    cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(keys)]
    return list(zip(cuts[:-1], cuts[1:]))
