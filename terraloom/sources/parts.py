"""One file from a sorted table: tasks write parts beside it, which are then joined in their order."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame


def write_parts(rows: DataFrame, order: Sequence[str], columns: Sequence[str], path: str, render: Callable[[pa.RecordBatch], bytes], head: Callable[[int], bytes] = lambda n: b"", append: bool = False) -> int:
    """Writes render() of the rows' columns, in order, behind head(number of rows), and returns that number.

    Rows are range-partitioned and sorted by Spark; each task renders its range into a file in `path`.parts, which all executors
    must see, under a name of its attempt, so that a task that is run again does no harm. The driver joins bytes, not rows.
    """
    folder = f"{os.path.abspath(path)}.parts"
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        name = f"{folder}/{task.partitionId()}-{task.taskAttemptId()}"
        with open(name, "wb") as f:
            for batch in batches:
                f.write(render(batch))
                n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([n], pa.int64()), pa.array([name])], ["part", "n", "name"])

    try:
        ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
        done = sorted(tuple(r) for r in ordered.mapInArrow(run, "part int, n long, name string").collect())
        total = sum(n for _, n, _ in done)
        with open(path, "ab" if append else "wb") as f:
            f.write(head(total))
            for _, _, name in done:
                with open(name, "rb") as part:
                    shutil.copyfileobj(part, f, 1 << 20)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return total


def lines(batch: pa.RecordBatch) -> bytes:
    """Rows of one string column as lines."""
    return "".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode()
