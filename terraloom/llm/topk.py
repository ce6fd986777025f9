"""Exact top-k inner products from a bit-sliced index."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, QUERY_ROWS = 16384, 256
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


class BitSlices:
    """Bitmaps of the binary digits of each attribute of a shard, rows in order of their ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        n, d = self.rows.shape
        self.words = -(-n // 64)
        self.low = int(self.rows.min()) if rows.size else 0
        self.bits = max(1, (int(self.rows.max()) - self.low).bit_length()) if rows.size else 1
        shifted = (self.rows - self.low).astype(np.uint64)
        flat = np.zeros((2, d * self.bits, self.words), np.uint64)
        for j in range(d):
            for b in range(self.bits):
                bit = np.zeros(self.words * 64, np.uint8)
                bit[:n] = shifted[:, j] >> np.uint64(b) & np.uint64(1)
                flat[0, j * self.bits + b] = np.packbits(bit, bitorder="little").view(np.uint64)
        flat[1] = flat[0] ^ _ONES
        self.flat = flat.reshape(-1, self.words)
        every = np.zeros(self.words * 64, np.uint8)
        every[:n] = 1
        self.every = np.packbits(every, bitorder="little").view(np.uint64)

    def score_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Digits of each row's inner product with the query, but for a constant: slices are added where
        their weights have a digit, by carry-save adders over whole bitmaps; negative weights take the
        complements."""
        d = len(query)
        at: dict[int, list[int]] = {}
        half = d * self.bits
        for j, w in enumerate(query.tolist()):
            first = j * self.bits + (half if w < 0 else 0)
            w, k = abs(w), 0
            while w:
                if w & 1:
                    for b in range(self.bits):
                        at.setdefault(b + k, []).append(first + b)
                w, k = w >> 1, k + 1
        out: list[np.ndarray] = []
        p, carried = 0, np.zeros((0, self.words), np.uint64)
        while len(carried) or any(x >= p for x in at):
            rows = np.concatenate([self.flat[at[p]], carried]) if p in at else carried
            up = []
            while len(rows) > 2:
                k = len(rows) // 3
                a, b, c = rows[:k], rows[k : 2 * k], rows[2 * k : 3 * k]
                x = a ^ b
                up.append(a & b | x & c)
                rows = np.concatenate([x ^ c, rows[3 * k :]])
            if len(rows) == 2:
                up.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
            out.append(rows[0] if len(rows) else np.zeros(self.words, np.uint64))
            carried = np.concatenate(up) if up else np.zeros((0, self.words), np.uint64)
            p += 1
        return out

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows other than those with the id own, smaller ids first among equals."""
        sure, open_ = np.zeros(self.words, np.uint64), self.every.copy()
        a, b = np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
        for i in range(a, b):
            open_[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        for s in reversed(self.score_slices(query)):
            both = open_ & s
            n = int(np.bitwise_count(sure | both).sum())
            if n > k:
                open_ = both
            else:
                sure |= both
                open_ = open_ & ~s if n < k else np.zeros_like(open_)
                if n == k:
                    break
        rows = self._rows(sure)
        if len(rows) < k:
            rows = np.concatenate([rows, self._rows(open_)[: k - len(rows)]])
        return self.ids[rows], self.rows[rows] @ query

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        w, b = np.nonzero(bits)
        return words[w] * 64 + b


class Exact:
    """Rows scored one by one with Python's integers, where a component is too wide for bit slices."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows.astype(object)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
        """As BitSlices.top, in order."""
        scores = [sum(x * y for x, y in zip(row, query)) for row in self.rows]
        best = sorted((i for i, x in enumerate(self.ids.tolist()) if x != own), key=lambda i: (-scores[i], self.ids[i]))[:k]
        return self.ids[best], [scores[i] for i in best]


def valid(id_col: str, vector_col: str) -> Column:
    """Rows that take part: an id, and a vector of finite components."""
    x = F.col(vector_col)
    return F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def narrow(vector_col: str) -> Column:
    """Vectors of which floor(256 * x) fits in 31 bits."""
    return F.forall(vector_col, lambda v: F.abs(v) < float(1 << 22))


def _floor(x: float) -> int:
    """floor(256 * x), exact also where 256 * x is beyond a double."""
    return int(x) * 256 if abs(x) >= 1 << 53 else math.floor(256.0 * x)


def _blocks(size: int):
    """Rows (part, id, vector, wide) -> (part, n, ids, cells): up to size rows of a part in a block. One of vector, integers,
    and wide, doubles, is null. A block of wide rows has a negative n."""

    def pack(part: int, wide: bool, ids: list[int], vectors: list[list[int]]) -> pa.RecordBatch:
        width = max(map(len, vectors), default=0)
        vectors = [v + [0] * (width - len(v)) for v in vectors]
        cells = pickle.dumps(vectors) if wide else np.array(vectors, np.int64).reshape(len(ids), width).astype(np.int32).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([-len(ids) if wide else len(ids)], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([cells], pa.binary())], ["part", "n", "ids", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], tuple[list, list]] = {}
        for batch in batches:
            for part, i, v, w in zip(*(batch.column(c).to_pylist() for c in range(4))):
                at = (part, v is None)
                ids, vectors = held.setdefault(at, ([], []))
                ids.append(i)
                vectors.append([_floor(x) for x in w] if v is None else v)
                if len(ids) >= size:
                    yield pack(*at, *held.pop(at))
        for at, (ids, vectors) in held.items():
            yield pack(*at, ids, vectors)

    return run


def _unpack(n: int, ids: bytes, cells: bytes) -> tuple[np.ndarray, np.ndarray]:
    if n < 0:
        return np.frombuffer(ids, np.int64), np.array(pickle.loads(cells), object).reshape(-n, -1)
    return np.frombuffer(ids, np.int64), np.frombuffer(cells, np.int32).astype(np.int64).reshape(n, -1)


def _long(score: int) -> int | None:
    """The score; null if it is below all longs, so that it comes last."""
    if score >= 1 << 63:
        raise OverflowError(f"the score {score} is beyond a long")
    return score if score >= -(1 << 63) else None


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for n, ids, cells, qn, qids, qcells in zip(*(batch.column(i).to_pylist() for i in range(6))):
                kind = BitSlices if n > 0 and qn > 0 else Exact
                if last != (ids, kind):
                    last, index = (ids, kind), kind(*_unpack(n, ids, cells))
                out: list[tuple] = []
                queries, vectors = _unpack(qn, qids, qcells)
                d = index.rows.shape[1]
                for q, v in zip(queries.tolist(), vectors):
                    v = np.concatenate([v[:d], np.zeros(max(0, d - len(v)), v.dtype)])
                    v = v.astype(object) if kind is Exact else v
                    found, scores = index.top(v, q, k)
                    scores = [_long(x) for x in scores] if kind is Exact else scores.tolist()
                    out += zip([q] * len(found), found.tolist(), scores)
                cols = list(zip(*out)) if out else [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    return run


def top_k(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k rows with the
    highest inner products of the integers floor(256 * x), ties to the smaller id.

    Rows go to shards by hash of the id, each a bit-sliced index; blocks of queries meet every
    shard by an equi-join on its number, and the shards' best rows are ranked. Components that the shorter
    of two vectors lacks count as zero. Null ids and vectors, and vectors with null or non-finite
    components take no part. Vectors with components from 2 ** 22 on, and pairs with one, are scored row by row with Python's
    integers; a score among the results that no long holds is an error. A query skips all rows of its own id; of repeated rows with another
    id, each is a candidate. An empty table gives no rows.
    """
    cells = F.transform(vector_col, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    rows = table.where(valid(id_col, vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.when(narrow(vector_col), cells).alias("v"), F.when(~narrow(vector_col), F.col(vector_col).cast("array<double>")).alias("w")
    )
    n = table.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n // (every * QUERY_ROWS)))
    part = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int").alias("part")
    kind = "part int, n int, ids binary, cells binary"
    index = rows.select(part(shards), "id", "v", "w").repartition(shards, "part").mapInArrow(_blocks(shard_rows), kind)
    asked = rows.where(F.col("id") % every == 0).select(part(blocks), "id", "v", "w").repartition(blocks, "part").mapInArrow(_blocks(QUERY_ROWS), kind)
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part"), F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("cells").alias("qcells"))
    met = index.join(asked, "part").select("n", "ids", "cells", "qn", "qids", "qcells").mapInArrow(_score(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.coalesce("score", F.raise_error(F.lit("a score is beyond a long")).cast("long")).alias("score"))


def oracle(k: int = 5, every: int = 50) -> str:
    return f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""
