"""Streaming forms of the mergeable and the ordered operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.voxel import voxel_means, voxel_sums


def voxel_stream(points: DataFrame, size: float = 0.2) -> DataFrame:
    """Running voxel means of a stream; write in complete or update mode. Equal to the batch result at the end of input."""
    return voxel_means(voxel_sums(points, size))


class _Decimator(StatefulProcessor):
    """State of a track: the last point kept."""

    def __init__(self, step: float, order: list[str]):
        self.step, self.order = step, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "x double, y double, z double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        kept, picks = self.last.get() if self.last.exists() else None, []
        for n, p in enumerate(zip(pdf["x"], pdf["y"], pdf["z"])):
            if kept is None or sum((a - b) ** 2 for a, b in zip(p, kept)) ** 0.5 >= self.step:
                kept = tuple(map(float, p))
                picks.append(n)
        if picks:
            self.last.update(kept)
        yield pdf.iloc[picks]

    def close(self) -> None:
        pass


def decimate_stream(track: DataFrame, key: str, order: list[str], step: float) -> DataFrame:
    """Greedy distance decimation of a stream of tracks. Batches must come in the order of each track; it needs the RocksDB state store."""
    return track.groupBy(key).transformWithStateInPandas(statefulProcessor=_Decimator(step, order), outputStructType=track.schema, outputMode="Append", timeMode="None")
