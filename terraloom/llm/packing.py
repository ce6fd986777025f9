"""Sequence packing along a Hilbert curve through document space."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise, shuffle_width
from .vocab import library, whole_texts

#: Hashed features, dimensions of the curve and bits of each.
FEATURES, DIMS, BITS = 256, 4, 8
#: Bytes of packed ids that a range of the curve holds on average, at most.
RANGE_BYTES = 64 << 20


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer points (n, d), each coordinate of the given bits."""
    x = points.astype(np.int64).copy()
    d = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            hit = (x[:, i] & q) != 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(hit, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip, q = np.zeros(len(x), np.int64), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[:, d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def _bucket(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)


@lru_cache(maxsize=1)
def _buckets(size: int) -> np.ndarray:
    return _bucket(np.arange(size)).astype(np.uint8)


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(7).choice([-1.0, 1.0], (FEATURES, DIMS)) / np.sqrt(FEATURES)


def curve_keys(counts: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors (n, FEATURES): scaled to length one, projected by fixed signs, quantised."""
    unit = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)
    at = np.clip((np.tanh(8 * (unit @ _projection())) + 1) * (1 << (BITS - 1)), 0, (1 << BITS) - 1)
    return hilbert_keys(at.astype(np.int64))


def tokenised(docs: DataFrame, path: str, end_id: int, text_col: str, id_col: str) -> DataFrame:
    """(doc_id, place, n, ids): the packed ids with the end id, and a place on the curve that the
    document's own hash refines, so that copies don't share one."""
    dtype = id_type(path, end_id)
    size, code = np.dtype(dtype).itemsize, "H" if dtype == "<u2" else "I"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bucket = whole_texts(path).ids, _buckets(1 << 16)
        for whole in batches:
            for first in range(0, len(whole), 512):
                batch = whole.slice(first, 512)
                blobs, counts = [], np.zeros((len(batch), FEATURES))
                for i, text in enumerate(batch.column(1).to_pylist()):
                    ids = array(code, encode(text or ""))
                    ids.append(end_id)
                    flat = np.frombuffer(ids, dtype)
                    counts[i] = np.bincount(bucket[flat] if size == 2 else _bucket(flat), minlength=FEATURES)
                    blobs.append(ids.tobytes())
                n = [len(b) // size for b in blobs]
                place = (curve_keys(counts) << 31) | batch.column(2).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place, pa.int64()), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "place", "n", "ids"])

    text = F.col(text_col).cast("string")
    ref = F.shiftrightunsigned(F.xxhash64(F.col(id_col), text), 33).alias("h")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), ref).mapInArrow(run, "doc_id long, place long, n long, ids binary")


def id_type(path: str, end_id: int) -> str:
    tok = library(path)
    size = max(end_id + 1, tok.get_vocab_size() if path.endswith(".json") else tok.get_piece_size())
    return "<u2" if size <= 1 << 16 else "<u4"


def _tail_starts(total: int, width: int) -> list[int]:
    """Starts of the sequences that hold the last, unfilled width: powers of two, so without padding."""
    out, at, rest = [], total - total % width, total % width
    while rest:
        out.append(at)
        at += 1 << (rest.bit_length() - 1)
        rest -= 1 << (rest.bit_length() - 1)
    return out


def pack(docs: DataFrame, path: str, width: int = 2048, end_id: int = 1, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (array<int>).

    Documents are tokenised whole (a null text is empty), each closed by end_id. Their hashed vectors are
    projected to four dimensions and range-sorted by Hilbert key; the stream of ids along the curve is cut
    every width ids, so neighbours share sequences and only the last, unfilled width is left, which is
    cut into powers of two. Ranges of the curve hold about equal numbers of documents, also where copies share a
    point, and their number grows with the ids; their token totals, one number a range, make the global offsets.
    Repeated rows and null ids are packed like any other; a text of any length is tokenised whole and cut; other
    columns play no part; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ids = materialise(tokenised(docs, path, end_id, text_col, id_col))
    size = ids.agg(F.sum("n")).first()[0] or 0
    ranges = max(shuffle_width(spark), -(-size * np.dtype(id_type(path, end_id)).itemsize // RANGE_BYTES))
    bounds = ids.approxQuantile("place", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    edges = np.array(sorted(set(bounds)))

    @F.pandas_udf("int")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, place.to_numpy(np.float64), side="right").astype(np.int32))

    ids = ids.withColumn("range", range_of("place"))
    totals = {r["range"]: r["n"] for r in ids.groupBy("range").agg(F.sum("n").alias("n")).collect()}
    starts, total = {}, 0
    for k in sorted(totals):
        starts[k], total = total, total + totals[k]
    last, tail = total - total % width, _tail_starts(total, width)
    dtype = id_type(path, end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        tails = np.array([*tail, total])
        for batch in batches:
            rows: list[tuple] = []
            for rng, doc, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if rng != now:
                    now, at = rng, starts[rng]
                tokens = np.frombuffer(blob, dtype).astype("<u4")
                done = 0
                while done < len(tokens):
                    if at < last:
                        seq, off = divmod(at, width)
                        room = width - off
                    else:
                        k = int(np.searchsorted(tails, at, side="right")) - 1
                        seq, off, room = last // width + k, int(at - tails[k]), int(tails[k + 1] - at)
                    part = tokens[done : done + room]
                    rows.append((doc, done, len(part), zlib.crc32(part.tobytes()), len(tokens), seq, off, part.astype(np.int32)))
                    done, at = done + len(part), at + len(part)
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    ordered = ids.repartitionById(ranges, "range").sortWithinPartitions("range", "place", "doc_id", "n", "ids").select("range", "doc_id", "ids")
    return ordered.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")
