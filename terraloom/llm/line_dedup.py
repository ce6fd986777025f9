"""Line dedup: content-defined chunks and the short windows of lines in and across them, removed where another
document or place has them first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise
from .rows import as_columns, as_struct
from .suffix_dedup import _slices, document_key

_MIX = np.uint64(0x9E3779B97F4A7C15)


def chunk_spans(lines: list[bytes]) -> list[tuple[int, int]]:
    """[from, to) of the chunks. A rolling hash over two neighbouring lines' hashes ends a chunk after each
    line where it has a local minimum: borders depend on the lines around them alone, so that a passage is
    cut alike wherever it stands, but for its ends. Chunks have two lines at least, except at an end of the text."""
    n = len(lines)
    if n < 3:
        return [(0, n)] if n else []
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, n)
    roll = h[1:] * _MIX + (h[:-1] << np.uint64(31) | h[:-1] >> np.uint64(33))  # roll[i] covers lines i and i + 1
    roll ^= roll >> np.uint64(29)
    ends = np.flatnonzero((roll[1:-1] < roll[:-2]) & (roll[1:-1] <= roll[2:])) + 2
    edges = [0, *ends.tolist(), n]
    return list(zip(edges[:-1], edges[1:]))


def chunks_of(body: bytes, min_lines: int = 2) -> tuple[list[bytes], list[tuple[int, int]], list[bool]]:
    """Lines, spans, and which spans can be removed: those with min_lines lines that aren't blank. The spans, in
    order, are the chunks and all windows from one line that isn't blank to the min_lines-th: the windows find the
    ends of a shared passage, which its chunks don't reach, and passages of no whole chunk."""
    lines = body.split(b"\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    windows = [(a, b + 1) for a, b in zip(full, full[min_lines - 1 :])] if min_lines > 0 else []
    spans = sorted({*chunk_spans(lines), *windows})
    solid = np.zeros(len(lines) + 1, np.int64)
    solid[np.array(full, np.int64) + 1] = 1
    solid = np.cumsum(solid).tolist()
    return lines, spans, [solid[b] - solid[a] >= min_lines for a, b in spans]


def repeated_chunks(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_lines: int = 2) -> DataFrame:
    """(row, text, removed) for each row of docs: its other columns as rows.as_struct() has them, its text, and the numbers
    of the spans of chunks_of to remove (array<int>).

    A span is removed where the same bytes are a span earlier: in a smaller id, or in the same id at a
    smaller place. Rows with one id count as one document; rows with a null id come last (ids are below 2 ** 62), each
    different text a document of its own, in order of a hash. So of each passage of min_lines
    lines or more that an earlier place has, no line stays but blank ones at its ends. A line that goes has
    an earlier copy, and the first copy of all stays, though removed spans that overlap a first passage can cut it. Hashes only choose
    candidates; spans are then compared byte by byte. Null and empty texts have no chunks; texts of any length are read
    whole; all columns stay, whatever their names; an empty table gives an empty one. Hot chunks are counted before
    they are shuffled, and their counts written before they are joined, so that adaptive execution can split their rows.
    """
    text = F.col(text_col).cast("string")
    base = docs.select(document_key(id_col, text).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"), as_struct(docs, text_col).alias("row"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for doc, hsh, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines, spans, ok = chunks_of((t or "").encode("utf-8", "surrogatepass"), min_lines)
                for k, ((a, b), good) in enumerate(zip(spans, ok)):
                    if good:
                        d = xxhash.xxh3_128_digest(b"\n".join(lines[a:b]))
                        rows.append((doc, hsh, k, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["doc", "hash", "k", "h1", "h2"])

    found = materialise(base.select("doc", "hash", "text").mapInArrow(hashes, "doc long, hash long, k int, h1 long, h2 long"))
    many = materialise(found.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"))
    told = found.join(many, ["h1", "h2"]).groupBy("doc").agg(F.collect_list(F.struct("hash", "k")).alias("ks"))

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for doc, hsh, t, ks in zip(*(batch.column(i).to_pylist() for i in range(4))):
                mine = {x["k"] for x in ks or () if x["hash"] == hsh}
                if mine:
                    lines, spans, _ = chunks_of(t.encode("utf-8", "surrogatepass"), min_lines)
                    rows += [(doc, hsh, k, b"\n".join(lines[a:b])) for k, (a, b) in enumerate(spans) if k in mine]
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["doc", "hash", "k", "body"])

    some = base.select("doc", "hash", "text").join(told, "doc").select("doc", "hash", "text", "ks").mapInArrow(bodies, "doc long, hash long, k int, body binary")
    some = materialise(some)
    first = materialise(some.groupBy("body").agg(F.min(F.struct("doc", "k")).alias("first"), F.count("*").alias("c")).where("c > 1").select("body", "first"))
    late = some.join(first, "body").where(F.struct("doc", "k") > F.col("first")).groupBy("doc").agg(F.collect_set(F.struct("hash", "k")).alias("gone"))
    out = base.join(late, "doc", "left").select("doc", "hash", "text", "row", "gone")
    mine = F.transform(F.filter("gone", lambda x: x["hash"] == F.col("hash")), lambda x: x["k"])
    return out.select("row", "text", F.array_sort(F.coalesce(mine, F.array().cast("array<int>"))).alias("removed"))


def without(text: str | None, removed: list[int], min_lines: int = 2) -> tuple[str, int]:
    """text without the lines of those spans of chunks_of, and how many lines went."""
    lines, spans, _ = chunks_of((text or "").encode("utf-8", "surrogatepass"), min_lines)
    gone = {i for k in removed for i in range(*spans[k])}
    return b"\n".join([x for i, x in enumerate(lines) if i not in gone]).decode("utf-8", "surrogatepass"), len(gone)


def _clean(docs: DataFrame, text_col: str, id_col: str, min_lines: int) -> DataFrame:
    found = repeated_chunks(docs, text_col, id_col, min_lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("text", pa.string()), ("lines", pa.int64())])
        for batch in _slices(batches):
            out = []
            for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text, n = without(t, r, min_lines) if r else (t, 0)
                out.append({"text": text, "lines": n})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind), batch.column(2)], ["row", "new", "removed"])

    return found.mapInArrow(run, T.StructType([found.schema["row"], *T.StructType.fromDDL("new struct<text: string, lines: bigint>, removed array<int>").fields]))


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_lines: int = 2) -> DataFrame:
    """docs with repeated chunks and windows cut out of the text (a null text stays null); all columns and rows stay."""
    done = _clean(docs, text_col, id_col, min_lines)
    return done.select(*as_columns(docs, text_col, F.col("new.text")))


def digest(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_lines: int = 2) -> DataFrame:
    """(doc_id, n_removed_chunks, n_removed_lines, kept_chars, kept_sha256) of each row of docs; n_removed_chunks
    counts spans, chunks and windows alike."""
    done = _clean(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "text", "doc_id", min_lines)
    text = F.coalesce("new.text", F.lit(""))
    return done.select(F.col("row.f0").alias("doc_id"), F.size("removed").cast("long").alias("n_removed_chunks"), F.col("new.lines").alias("n_removed_lines"), F.length(text).cast("long").alias("kept_chars"), F.sha2(F.encode(text, "UTF-8"), 256).alias("kept_sha256"))
