"""SimHash near-duplicate groups found through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..scratch import materialise

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ONE_BALL = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
#: Home rows that a shard aims at, the most shards, and the sampled fingerprints a leaf of the routing tree rests on.
SHARD_ROWS, MOST_SHARDS, SAMPLE_PER_SHARD = 16384, 65536, 4
_LEAF, _DENSE, _PASS = 64, 4096, 1 << 22


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> bytes:
    """The eight bytes of a text's fingerprint, most significant first; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return bytes(8)
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    k = min(shingle_words, len(words))
    starts = [0] + [e + 1 for e in ends[: len(words) - k]]
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(joined[s:e], seed) for s, e in zip(starts, ends[k - 1 :])]), np.uint8).reshape(-1, 8)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(raw), 65536):
        votes += np.unpackbits(raw[i : i + 65536], axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > len(raw)).tobytes()


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. Whole texts; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join([fingerprint(t, shingle_words) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.frombuffer(raw, ">u8").astype("<u8").view("<i8"))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


@dataclass
class Node:
    """Inner side: distance to vp of at most mu. A leaf has a shard and no children."""

    vp: np.uint64 = np.uint64(0)
    mu: int = 0
    inner: Node | None = None
    outer: Node | None = None
    shard: int = -1


def _vantage(points: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """Of a few points, the one whose distances spread most, with them."""
    best = None
    for p in points[:: max(1, len(points) // 6)][:6]:
        d = np.bitwise_count(points ^ p).astype(np.int16)
        if best is None or d.var() > best[0]:
            best = (d.var(), p, d)
    return best[1], best[2]


def _split(d: np.ndarray) -> int:
    """A distance with points on both sides of it, near the median; -1 if all are equal."""
    mu = int(np.median(d))
    mu = mu if (d > mu).any() else mu - 1
    return mu if (d <= mu).any() else -1


def build_routes(sample: np.ndarray, shards: int) -> tuple[Node, int]:
    """A vantage-point tree over a sample, with about as many leaves as shards, numbered from 0."""
    made = 0

    def grow(points: np.ndarray, want: int) -> Node:
        nonlocal made
        if want > 1 and len(points) > 1:
            vp, d = _vantage(points)
            if (mu := _split(d)) >= 0:
                return Node(vp, mu, grow(points[d <= mu], (want + 1) // 2), grow(points[d > mu], want // 2))
        made += 1
        return Node(shard=made - 1)

    return grow(sample, shards), made


def route(root: Node, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, shard, home): every shard that a ball of the radius around fps[index] can reach by the
    triangle inequality; home marks the one that holds the fingerprint itself."""
    out, todo = [], [(root, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        node, idx, home = todo.pop()
        if not len(idx):
            continue
        if node.inner is None:
            out.append((idx, np.full(len(idx), node.shard, np.int32), home))
            continue
        d = np.bitwise_count(fps[idx] ^ node.vp).astype(np.int16)
        a, b = d <= node.mu + radius, d > node.mu - radius
        todo += [(node.inner, idx[a], home[a] & (d[a] <= node.mu)), (node.outer, idx[b], home[b] & (d[b] > node.mu))]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool))


def _ball_links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all points within two bits of each other: they share a value one bit or none away."""
    a, b = [], []
    passes = 1 + len(points) * 65 // _PASS
    for part in range(passes):
        near = (points[:, None] ^ _ONE_BALL[None, :]).ravel() if passes == 1 else None
        if near is None:
            kept = [(i, v[m]) for i in range(0, len(points), 4096) for v in [(points[i : i + 4096, None] ^ _ONE_BALL).ravel()] for m in [(v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(passes) == part] if m.any()]
            near = np.concatenate([v for _, v in kept])
            own = np.concatenate([i + np.flatnonzero((w * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(passes) == part) // 65 for i in range(0, len(points), 4096) for w in [(points[i : i + 4096, None] ^ _ONE_BALL).ravel()]])
        else:
            own = np.repeat(np.arange(len(points)), 65)
        order = np.argsort(near, kind="stable")
        same = np.flatnonzero(near[order][1:] == near[order][:-1])
        a.append(points[own[order[same]]])
        b.append(points[own[order[same + 1]]])
    return np.concatenate(a), np.concatenate(b)


def _search(members: np.ndarray, queries: np.ndarray, radius: int, out: list) -> None:
    """Appends links between queries and members within the radius, by a local vantage-point tree.
    Where a dense cluster defeats pruning, the one-bit neighbourhoods link it exactly, in linear space."""
    todo = [(members, queries)]
    while todo:
        m, q = todo.pop()
        if not len(m) or not len(q):
            continue
        if len(m) > _LEAF:
            vp, d = _vantage(m)
            if (mu := _split(d)) >= 0:
                dq = np.bitwise_count(q ^ vp).astype(np.int16)
                qa, qb = q[dq <= mu + radius], q[dq > mu - radius]
                if radius != 2 or len(m) <= _DENSE or len(qa) + len(qb) < 1.9 * len(q):
                    todo += [(m[d <= mu], qa), (m[d > mu], qb)]
                    continue
                out.append(_ball_links(np.unique(np.concatenate([m, q]))))
                continue
        step = max(1, (1 << 20) // len(m))
        for i in range(0, len(q), step):
            x, y = np.nonzero(np.bitwise_count(m[:, None] ^ q[None, i : i + step]) <= radius)
            x, y = m[x], q[i + y]
            out.append((x[x != y], y[x != y]))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the links that isn't its component's smallest: the node and that smallest."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = idx[: len(a)], idx[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all() and (label[x] == label[y]).all():
            break
        label = new
    kept = label != np.arange(len(nodes))
    return nodes[kept], nodes[label[kept]]


def link(fps: DataFrame, radius: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """fps(fp), distinct -> edges(a, b) that connect, directly or over others, all fingerprints which
    differ in at most radius bits. A sample of about 4 * MOST_SHARDS fingerprints at most, those with the lowest
    hashes, shapes the routing tree; it balances the shards and has no say in the result."""
    spark = fps.sparkSession
    n = fps.count()
    shards = min(MOST_SHARDS, max(1, -(-n // shard_rows)))
    share = min(1.0, SAMPLE_PER_SHARD * max(shards, 256) / max(n, 1))
    sample = fps.where(F.shiftrightunsigned(F.xxhash64("fp"), 1) <= int(share * (2**63 - 1024))).collect() if shards > 1 else []
    root, shards = build_routes(np.array([r[0] for r in sample], np.int64).view(np.uint64), shards)
    tree = spark.sparkContext.broadcast(root)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            i, shard, home = route(tree.value, x.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(x[i]), pa.array(home)], ["shard", "fp", "home"])

    def local(table: pa.Table) -> pa.Table:
        x = table.column("fp").to_numpy().view(np.uint64)
        found = [(x[:0], x[:0])]
        _search(x[table.column("home").to_numpy()], x, radius, found)
        a, b = _forest(*(np.concatenate(side) for side in zip(*found)))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return fps.select("fp").mapInArrow(spread, "shard int, fp long, home boolean").groupBy("shard").applyInArrow(local, "a long, b long")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of docs: (doc_id, fingerprint, component_id).

    Texts are lower-cased in A-Z, split at the six ASCII blanks and cut into word shingles; fewer words
    make one shingle, none (empty or null text) fingerprint zero, which links like any other. Fingerprints
    link at radius or fewer differing bits; component_id is the smallest doc_id reachable. Exact copies
    meet as one fingerprint, so a group of copies costs one row in the search. Repeated rows each
    return. A row with a null doc_id returns its fingerprint, links nothing, and has a null component_id.
    Texts of any length are read whole; an empty table gives no rows; other columns play no part. Labels are
    written before they are joined, so that adaptive execution can split the rows of a hot fingerprint.
    """
    fps = materialise(fingerprints(docs, text_col, id_col, shingle_words))
    rep = materialise(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    comps = materialise(connected_components(link(rep.select("fp"), radius)))
    linked = comps.join(rep, comps.node == rep.fp).select("fp", "rep", "root")
    low = materialise(linked.groupBy("root").agg(F.min("rep").alias("low")))
    labels = materialise(rep.join(linked.join(low, "root").select("fp", "low"), "fp", "left").select("fp", F.coalesce("low", "rep").alias("component_id")))
    return fps.join(labels, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_representatives(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    """docs without the rows whose component has a smaller doc_id; all columns stay. Rows with a null id stay."""
    found = near_duplicates(docs, text_col, id_col, **how)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti")
