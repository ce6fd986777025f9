"""Removal of repeated byte strings, found by suffix order with common prefixes.

Every start of a long enough string is filed under the least hash of the short grams inside it, a key that
depends on the string alone. Keys that occur once need no sorting; the text around the others is dealt
out by key, so that equal strings meet in one shard, whose suffixes are put in order by external
induced sorting. Neighbours whose common prefix is long enough are one class; all but its first are removed.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .induced_sort import sorted_suffixes
from .rows import as_columns, as_struct
from ..scratch import materialise, shuffle_width

GRAM, SLICE, ROWS = 32, 1 << 20, 512
#: Keys and bytes that a task gathers before it sends them on.
FLUSH_KEYS, FLUSH_BYTES = 1 << 21, 16 << 20
#: Bytes of differing segments at which a shard is sorted. A key with more is parted on disk, each time into FAN files for each half of its starts.
SHARD_BYTES, FAN = 1 << 20, 16
_HEAD = struct.Struct("<4qI")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
#: Bytes of text that a part holds on average, at most.
PART_BYTES = 64 << 20


def _grams(buf: bytes) -> np.ndarray:
    """Hashes of all grams."""
    n = len(buf) - GRAM + 1
    words = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    h = words[:n] * _ODD[0]
    for i in range(1, GRAM // 8):
        h ^= words[8 * i : 8 * i + n] * _ODD[i]
        h = (h << np.uint64(23) | h >> np.uint64(41)) * _ODD[4]
    h ^= h >> np.uint64(32)
    return h


def start_keys(buf: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of width bytes in buf, the least hash of its grams, and whether its first gram has it."""
    h = grams = _grams(buf)
    want, have = width - GRAM + 1, 1
    while have < want:
        step = min(have, want - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h, grams[: len(h)] == h


def runs(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text index, start, length, key) of runs of starts whose first least gram is one and the same, for
    slices of the texts in bounded memory. Equal strings have equal keys, and lie in different runs."""
    part: list[tuple[int, int, bytes]] = []
    held = 0
    for i, t in enumerate(texts):
        for s in range(0, max(len(t) - width + 1, 0), SLICE):
            part.append((i, s, t[s : s + SLICE + width - 1]))
            held += len(part[-1][2])
            if held >= SLICE:
                yield _runs(part, width)
                part, held = [], 0
    if part:
        yield _runs(part, width)


def _runs(part: list[tuple[int, int, bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    keys, leaves = start_keys(b"".join(p[2] for p in part), width)
    sizes = np.array([len(p[2]) for p in part])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    step = np.zeros(len(keys) + width, np.int32)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + sizes - width + 1, -1)
    valid = np.cumsum(step[: len(keys)]) > 0
    brk = np.ones(len(keys), bool)
    brk[1:] = (keys[1:] != keys[:-1]) | leaves[:-1] | (valid[1:] != valid[:-1])
    brk[begin] = True
    at = np.flatnonzero(brk)
    n = np.diff(np.append(at, len(keys)))
    at, n = at[valid[at]], n[valid[at]]
    own = np.searchsorted(begin, at, side="right") - 1
    return np.array([p[0] for p in part])[own], at - begin[own] + np.array([p[1] for p in part])[own], n, keys[at]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, len(batch), ROWS):
            yield batch.slice(i, ROWS)


def _blob(*arrays: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(a, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _arrays(blob: bytes, n: int) -> list[np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(x.reshape(8, -1).T).view("<i8").ravel() for x in raw.reshape(n, -1)] if size else [np.zeros(0, np.int64)] * n


def _groups(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal values in a sorted array."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    return at, np.diff(np.append(at, len(a)))


def _later(doc: np.ndarray, start: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Which rows aren't the first of their class by (doc, start); rows equal to the first are first too."""
    order = np.lexsort((start, doc, cls))
    at, n = _groups(cls[order])
    head = np.repeat(order[at], n)
    out = np.zeros(len(doc), bool)
    out[order] = (doc[order] != doc[head]) | (start[order] != start[head])
    return out


def _key_rows(width: int, parts: int):
    """Documents -> (part, kind, body). Kind 0: a key's first document in this task, for the count over
    all tasks; kind 1: documents whose key this task has met twice, so that a hot key sends one row a task."""

    def flush(keys: list[np.ndarray], docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        at, n = _groups(key)
        many = np.repeat(n > 1, n)
        part = (key[at].view(np.uint64) % np.uint64(parts)).astype(np.int64)
        rows = []
        for p in np.unique(part):
            i = at[part == p]
            i = i[np.argsort(doc[i], kind="stable")]
            rows.append((int(p), 0, _blob(doc[i], key[i])))
        order = np.argsort(doc[many], kind="stable")
        d, k = doc[many][order], key[many][order]
        step = 1 << 14
        rows += [(int(k[i].view(np.uint64) % np.uint64(parts)), 1, _blob(d[i : i + step], k[i : i + step])) for i in range(0, len(d), step)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], ["part", "kind", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, held = [], [], 0
        for batch in _slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for own, _, _, key in runs([x or b"" for x in batch.column(2).to_pylist()], width):
                keys.append(key.view(np.int64))
                docs.append(ids[own])
                held += len(key)
                if held >= FLUSH_KEYS:
                    yield from flush(keys, docs)
                    keys, docs, held = [], [], 0
        if held:
            yield from flush(keys, docs)

    return run


def _packed(rows: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """rows (doc, ...) as a blob for each range of documents' ids modulo parts: (part, body)."""
    part = rows[0] % parts
    order = np.argsort(part, kind="stable")
    at, n = _groups(part[order])
    cells = [(int(part[order[a]]), _blob(*rows[:, order[a : a + k]])) for a, k in zip(at, n)]
    if cells:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), (pa.int32(), pa.binary()))], ["part", "body"])


def _by_document(width: int, name: str):
    """All blobs of some documents -> (doc, name): one row for each document, the other arrays one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.stack(_arrays(b, width)) for batch in batches for b in batch.column(1).to_pylist()]
        if not found:
            return
        rows = np.concatenate(found, axis=1)
        found.clear()
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        tail = np.searchsorted(rows[0], 1 << 62)
        if tail < len(rows[0]):  # rows with one text and no id tell the same
            rows = np.concatenate([rows[:, :tail], np.unique(rows[:, tail:], axis=1)], axis=1)
        at, n = _groups(rows[0])
        for i in range(0, len(at), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(rows[0][at[i : i + 10_000]]), pa.array([rows[1:, a : a + k].tobytes() for a, k in zip(at[i : i + 10_000], n[i : i + 10_000])], pa.binary())], ["doc", name])

    return run


def _repeated(parts: int):
    """All rows of some keys -> documents with those of their keys that occur again, packed for their documents' parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        told: list[np.ndarray] = []
        for batch in batches:
            for kind, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                (told if kind else seen).append(np.stack(_arrays(body, 2)))
        if seen:
            rows = np.concatenate(seen, axis=1)
            rows = rows[:, np.argsort(rows[1], kind="stable")]
            _, n = _groups(rows[1])
            told.append(rows[:, np.repeat(n > 1, n)])
        if told:
            yield from _packed(np.concatenate(told, axis=1), parts)

    return run


def _segments(width: int, parts: int):
    """Documents with their repeated keys -> (part, key, doc, hash, start, n, body): the text around runs of
    starts. A task sends the first of equal texts under a key; later ones it settles itself (negative n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[tuple[int, bytes], tuple] = {}
        done: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            signed = lambda k: k - (1 << 64) if k >> 63 else k
            rows = [(k % parts, signed(k), *v, b) for (k, b), v in first.items()] + [(d % parts, signed(k), d, h, s, -n, b"") for k, d, h, s, n in done]
            for i in range(0, len(rows), 20_000):
                cols = list(zip(*rows[i : i + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["part", "key", "doc", "hash", "start", "n", "body"])
            first.clear()
            done.clear()

        for batch in _slices(batches):
            docs, hashes, texts, keys, copies = (batch.column(i).to_pylist() for i in range(5))
            live = [i for i in range(len(docs)) if keys[i] and texts[i] and hashes[i] not in (copies[i] or ())]
            wanted = {i: np.unique(np.frombuffer(b"".join(k for k in keys[i] if k), "<u8")) for i in live}
            for own, start, n, key in runs([texts[i] for i in live], width):
                at, m = _groups(own)
                for a, k in zip(at, m):
                    i = live[own[a]]
                    want = wanted[i]
                    if not len(want):
                        continue
                    some = key[a : a + k]
                    hit = np.minimum(np.searchsorted(want, some), len(want) - 1)
                    text = texts[i]
                    for j in np.flatnonzero(want[hit] == some) + a:
                        s, c, x = int(start[j]), int(n[j]), int(key[j])
                        body = text[s : s + c + width - 1]
                        mine = (docs[i], hashes[i], s, c)
                        known = first.setdefault((x, body), mine)
                        if known is mine:
                            held += len(body)
                        elif (mine[0], s) < (known[0], known[2]):
                            first[x, body] = mine
                            done.append((x, *known))
                        elif (mine[0], s) > (known[0], known[2]):
                            done.append((x, *mine))
                if held >= FLUSH_BYTES:
                    yield from flush()
                    held = 0
        yield from flush()

    return run


def _sorted_marks(pieces: list[bytes], info: np.ndarray, width: int, memory: int) -> np.ndarray:
    """Runs (doc, hash, start, n) of starts in the pieces, rows (doc, hash, start, n) of info, whose string is that
    of an earlier start, from the pieces' suffixes in order."""
    doc, hsh, start, n = info
    cls, parts = 0, []
    for at, lcp, begin in sorted_suffixes(pieces, width, memory):
        ids = cls + np.cumsum(lcp < width)
        cls = int(ids[-1])
        own = np.searchsorted(begin, at, side="right") - 1
        off = at - begin[own]
        ok = off < n[own]
        parts.append((ids[ok], own[ok], off[ok]))
    ids, own, off = (np.concatenate(x) for x in zip(*parts))
    _, m = _groups(ids)
    many = np.repeat(m > 1, m)
    ids, own, off = ids[many], own[many], off[many]
    late = _later(doc[own], start[own] + off, ids)
    own, off = own[late], off[late]
    order = np.lexsort((off, own))
    own, off = own[order], off[order]
    brk = np.ones(len(own), bool)
    brk[1:] = (own[1:] != own[:-1]) | (off[1:] != off[:-1] + 1)
    at = np.flatnonzero(brk)
    return np.stack([doc[own[at]], hsh[own[at]], start[own[at]] + off[at], np.diff(np.append(at, len(own)))])


class KeyParts:
    """Segments of one key that are more than memory holds, parted by further characters in files.

    In each start's string the key's gram has a place; equal strings have the same. The places from lo to hi are
    halved, a segment is cut where its starts change halves, and each piece goes to a file by a hash of
    the characters that all strings of its half have in common. So equal strings meet in one file; for a
    single place these characters are the whole string.
    """

    def __init__(self, key: int, width: int, lo: int, hi: int, depth: int):
        self.key, self.width, self.depth = key, width, depth
        mid = (lo + hi) // 2
        self.halves = [(lo, mid), (mid, hi)] if hi - lo > 1 else [(lo, hi)]
        self.files: dict[tuple[int, int, int], object] = {}

    def add(self, doc: int, hsh: int, start: int, n: int, body: bytes) -> None:
        at = int(np.argmax(_grams(body).view(np.int64) == self.key))
        for lo, hi in self.halves:
            a, b = max(0, at - hi + 1), min(n, at - lo + 1)
            if a < b:
                shared = body[at - lo : at - hi + 1 + self.width]
                to = (lo, hi, xxhash.xxh3_64_intdigest(shared, self.depth) % FAN)
                if to not in self.files:
                    self.files[to] = tempfile.TemporaryFile()
                piece = body[a : b + self.width - 1]
                self.files[to].write(_HEAD.pack(doc, hsh, start + a, b - a, len(piece)) + piece)

    def take(self) -> Iterator[tuple[int, int, Iterator[tuple]]]:
        """(lo, hi, rows) of each file, which is closed after its rows."""
        for lo, hi, k in list(self.files):
            with self.files.pop((lo, hi, k)) as f:
                f.seek(0)
                yield lo, hi, self._rows(f)

    @staticmethod
    def _rows(f) -> Iterator[tuple]:
        while head := f.read(_HEAD.size):
            *row, size = _HEAD.unpack(head)
            yield (*row, f.read(size))


def _marks(width: int, memory: int, parts: int):
    """Segments, in order of key -> (doc, hash, start, n), packed for their documents' parts: runs of starts whose string of width bytes starts
    earlier elsewhere. Of equal segments under a key all but the first are settled at once. Keys with different
    segments are put together, up to a bound of bytes, in shards to sort; a key beyond the bound is parted on disk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[bytes] = []
        info: list[tuple] = []
        done: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            rows = [np.array(done, np.int64).T] if done else []
            if pieces:
                rows.append(_sorted_marks(pieces, np.array(info, np.int64).T, width, memory))
            if rows:
                yield from _packed(np.concatenate(rows, axis=1), parts)
            for x in (pieces, info, done):
                x.clear()
            held = 0

        def gather(key: int, rows: Iterable[tuple], lo: int, hi: int, depth: int) -> Iterator[pa.RecordBatch]:
            nonlocal held
            first: dict[bytes, tuple] = {}
            size, parted = 0, None
            for doc, hsh, start, n, body in rows:
                mine = (doc, hsh, start, n)
                if n < 0:
                    done.append((doc, hsh, start, -n))
                elif parted:
                    parted.add(*mine, body)
                else:
                    known = first.setdefault(body, mine)
                    if known is mine:
                        size += len(body)
                    elif (doc, start) < (known[0], known[2]):
                        first[body] = mine
                        done.append(known)
                    elif (doc, start) > (known[0], known[2]):
                        done.append(mine)
                    if size > SHARD_BYTES:
                        parted = KeyParts(key, width, lo, hi, depth)
                        for b, x in first.items():
                            parted.add(*x, b)
                        first.clear()
                if len(done) >= 1 << 18:
                    yield from flush()
            if parted:
                for a, b, some in parted.take():
                    yield from gather(key, some, a, b, depth + 1)
            elif len(first) > 1 and hi - lo > 1:  # with a single place, different segments are different strings
                pieces.extend(first)
                info.extend(first.values())
                held += size
                if held >= SHARD_BYTES:
                    yield from flush()

        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(1, 7))))
        for key, some in groupby(rows, lambda row: row[0]):
            yield from gather(key, (row[1:] for row in some), 0, width - GRAM + 1, 0)
        yield from flush()

    return run


def removed_spans(marks: list[bytes], own_hash: int, width: int) -> list[tuple[int, int]]:
    """Maximal removed runs [from, to) of the document with this hash."""
    x = [np.frombuffer(m, "<i8").reshape(3, -1) for m in marks]
    rows = np.concatenate(x, axis=1) if x else np.zeros((3, 0), np.int64)
    rows = rows[:, rows[0] == own_hash]
    out: list[list[int]] = []
    for s, n in sorted(zip(rows[1].tolist(), rows[2].tolist())):
        end = s + n + width - 1
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([s, end])
    return [tuple(x) for x in out]


def _grouped(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy("doc").agg(F.collect_list(col).alias(col))


def document_key(id_col: str, text: Column) -> Column:
    """A document's place among all: its id, and after all ids below 2 ** 62 a hash of the text where there is none."""
    return F.coalesce(F.col(id_col).cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(1 << 62)))


def _text_bytes(col: str) -> Column:
    return F.encode(F.col(col).cast("string"), "UTF-8")


def repeated_spans(docs: DataFrame, width: int = 100, text_col: str = "text", id_col: str = "doc_id", memory: int = 64 << 20) -> DataFrame:
    """(row, body, spans) for each row of docs: its other columns as rows.as_struct() has them, its text's bytes, and (array
    of structs of long: lo, hi) the maximal runs of bytes covered by strings of width bytes that also start earlier.

    Earlier: in a smaller id, or in the same id at a smaller start. Rows with one id count as one
    document, so that equal rows keep the same; rows with a null id come after all others (ids are below
    2 ** 62), each different text a document of its own, in order of a hash. Matches never cross texts and are
    judged on the input; null and empty texts have none, and texts of any length are read in slices. All columns
    stay, whatever their names; rows keep their number; an empty table gives an empty one.
    """
    base = docs.select(document_key(id_col, _text_bytes(text_col)).alias("doc"), F.xxhash64(_text_bytes(text_col)).alias("hash"), _text_bytes(text_col).alias("body"), as_struct(docs, text_col).alias("row"))
    light = base.select("doc", "hash", "body")
    whole = materialise(light.select("doc", "hash", F.sha2("body", 256).alias("sha"), F.octet_length("body").alias("n")).where(F.col("n") >= width))
    width_n = max(shuffle_width(docs.sparkSession), -(-(whole.agg(F.sum("n")).first()[0] or 0) // PART_BYTES))
    head = materialise(whole.groupBy("sha").agg(F.min("doc").alias("head"), F.count("*").alias("c")).where("c > 1").select("sha", "head"))
    copies = materialise(whole.join(head, "sha").where("doc > head").groupBy("doc").agg(F.collect_set("hash").alias("copies")))
    rows = light.mapInArrow(_key_rows(width, width_n), "part int, kind int, body binary")
    packed = "part int, body binary"
    keys = rows.repartitionById(width_n, "part").mapInArrow(_repeated(width_n), packed).repartitionById(width_n, "part").mapInArrow(_by_document(2, "keys"), "doc long, keys binary")
    told = keys.withColumn("copy", F.lit(None).cast("array<long>")).unionByName(copies.select("doc", F.lit(None).cast("binary").alias("keys"), F.col("copies").alias("copy")))
    told = told.groupBy("doc").agg(F.collect_list("keys").alias("keys"), F.flatten(F.collect_list("copy")).alias("copies"))
    text = base.select("doc", "hash", "body", "row")
    segments = text.join(told, "doc", "left").select("doc", "hash", "body", "keys", "copies", "row").mapInArrow(_segments(width, width_n), "part int, key long, doc long, hash long, start long, n long, body binary")
    marks = segments.repartitionById(width_n, "part").sortWithinPartitions("key").mapInArrow(_marks(width, memory, width_n), packed)
    marks = marks.repartitionById(width_n, "part").mapInArrow(_by_document(4, "marks"), "doc long, marks binary")
    marks = marks.withColumn("copy", F.lit(None).cast("array<long>")).unionByName(copies.select("doc", F.lit(None).cast("binary").alias("marks"), F.col("copies").alias("copy")))
    marks = marks.groupBy("doc").agg(F.collect_list("marks").alias("marks"), F.flatten(F.collect_list("copy")).alias("copies"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for batch in _slices(batches):
            out = []
            for hsh, body, mark, copy in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4, 5))):
                found = [(0, len(body or b""))] if hsh in (copy or ()) else removed_spans(mark or [], hsh, width)
                out.append([{"lo": a, "hi": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(2), pa.array(out, kind)], ["row", "body", "spans"])

    rowtype = text.schema["row"].dataType.simpleString()
    done = text.join(marks, "doc", "left").select("doc", "hash", "body", "row", "marks", "copies").mapInArrow(finish, f"row {rowtype}, body binary, spans array<struct<lo: bigint, hi: bigint>>")
    return done.select("row", "body", "spans")


def digest(docs: DataFrame, width: int = 100, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of docs after removal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for body, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                body, sha, at = body or b"", hashlib.sha256(), 0
                for x in spans:
                    sha.update(body[at : x["lo"]])
                    at = x["hi"]
                sha.update(body[at:])
                rows.append((len(body), sum(x["hi"] - x["lo"] for x in spans), len(spans), sha.hexdigest()))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = repeated_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), width)
    return found.select(F.col("row.f0").alias("doc_id"), "body", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = 100, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with its repeated bytes cut out of the text; bytes that no longer form UTF-8 become U+FFFD."""

    @F.pandas_udf("string")
    def kept(body: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for b, s in zip(body, spans):
            cut, at, b = [], 0, b or b""
            for x in s:
                cut.append(b[at : x["lo"]])
                at = x["hi"]
            out.append((b"".join(cut) + b[at:]).decode("utf-8", "replace"))
        return pd.Series(out)

    found = repeated_spans(docs, width, text_col, id_col)
    return found.select(*as_columns(docs, text_col, F.when(F.col("body").isNotNull(), kept("body", "spans"))))
