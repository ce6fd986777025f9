"""Groups of texts with a similarity of 0.8 or more: SimHash links, and shingle sets compared exactly.

On 64 bits, texts that share four fifths of their five-word shingles differ in up to 14 places, a radius at
which no tree prunes. So the vantage-point search links the closest texts, and the others meet under
least hashes of their shingle sets, where their sets are compared in full. Large buckets are compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..scratch import materialise
from .simhash import _LOWER, _forest, fingerprint, link

#: Keys of a text, and least hashes in each: a pair of similarity 0.8 misses all with a chance of 2e-4, one of 0.9 with 5e-8.
BANDS, ROWS = 16, 4
#: Shingles of one block of a bucket, and bytes of sets sent in one batch.
BLOCK_SHINGLES, BATCH_BYTES = 1 << 20, 8 << 20
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_MIX = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words make one shingle, none an empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * _MIX[i % 64]
        out ^= out >> np.uint64(31)
    return np.unique(out)


def band_keys(shingles: np.ndarray) -> list[int]:
    """BANDS signed keys; each holds ROWS least hashes, so that two sets share one with a chance of their similarity to the power ROWS."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[i : i + 4096, None] * _FACTORS).min(0))
    raw = least.tobytes()
    return [int.from_bytes(xxhash.xxh3_64_digest(raw[b * ROWS * 8 : (b + 1) * ROWS * 8], b), "little", signed=True) for b in range(BANDS)]


def similar_pairs(ids: np.ndarray, sets: list[np.ndarray], similarity: float, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links between all pairs of sets whose shared part of their union is similarity or more, by an inverted index.
    If first is given, only pairs of one of the first sets and one of the others."""
    a, b = [ids[:0]], [ids[:0]]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, idx = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(size)])
    known = idx[: at[first or len(sets)]]
    order = np.argsort(known, kind="stable")
    posts, start = owner[order], np.concatenate([[0], np.cumsum(np.bincount(known, minlength=idx.max(initial=0) + 1))])
    for i in range(first, len(sets)):
        mine = idx[at[i] : at[i + 1]]
        n = start[mine + 1] - start[mine]
        some = n > (0 if first else 1)
        mine, n = mine[some], n[some]
        if len(n):
            place = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            upto = first or i
            both = np.bincount(posts[place], minlength=upto)[:upto]
            j = np.flatnonzero(both >= similarity * (size[i] + size[:upto] - both) - 1e-9)
            a.append(np.repeat(ids[i], len(j)))
            b.append(ids[j])
    return np.concatenate(a), np.concatenate(b)


def _sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """docs(doc_id, text, hash) -> (doc_id, hash, h1, h2, fp, n, keys): equal shingle sets have equal h1, h2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, hsh in zip(*(batch.column(i).to_pylist() for i in range(3))):
                s = shingle_set(text, shingle_words)
                d = xxhash.xxh3_128_digest(s.tobytes())
                rows.append((doc, hsh, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), int.from_bytes(fingerprint(text, shingle_words), "big", signed=True), len(s), band_keys(s) if len(s) else []))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "hash", "h1", "h2", "fp", "n", "keys"])

    return docs.mapInArrow(run, "doc_id long, hash long, h1 long, h2 long, fp long, n long, keys array<long>")


def _blocks(reps: DataFrame) -> DataFrame:
    """(doc, node, h1, key, i, j, own): the sets to compare. Of buckets with the same members one stays. A bucket of over
    BLOCK_SHINGLES is dealt over blocks by hash, and a set stands at every pair (i, j) that its block, own, is in."""
    rows = materialise(reps.where("n > 0").select("doc", "node", "h1", "n", F.xxhash64("h1", "h2").alias("h"), F.explode("keys").alias("key")))
    sizes = rows.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("mass"), F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h")).alias("y")).where("c > 1")
    kept = sizes.groupBy("c", "x", "y").agg(F.min(F.struct("key", "mass")).alias("k")).select("k.key", "c", F.ceil(F.col("k.mass") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    both = rows.join(kept, "key").withColumn("own", F.pmod(F.xxhash64("h", "key"), F.col("blocks")).cast("int"))
    both = both.select("doc", "node", "h1", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return both.select("doc", "node", "h1", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")


def _verified(docs: DataFrame, reps: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """edges(a, b) between nodes of the representatives: they connect what is similar within a bucket."""
    told = _blocks(reps).groupBy("doc", "node", "h1").agg(F.collect_list(F.struct("key", "i", "j", "own")).alias("at"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text, h1, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = shingle_set(text, shingle_words).tobytes()
                if int.from_bytes(xxhash.xxh3_128_digest(raw)[:8], "little", signed=True) != h1:
                    continue  # another row of the same id
                step = max(1, BATCH_BYTES // max(1, len(raw)))
                for k in range(0, len(at), step):
                    some = at[k : k + step]
                    cols = [[node] * len(some), *([x[c] for x in some] for c in ("key", "i", "j", "own")), [raw] * len(some)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["node", "key", "i", "j", "own", "raw"])

    def local(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        table = table.sort_by("own")
        first = 0 if i == j else int((table.column("own").to_numpy() == i).sum())
        ids, raw = table.column("node").to_numpy(), table.column("raw").to_pylist()
        if i != j and first in (0, len(ids)):
            ids, raw = ids[:0], []
        a, b = _forest(*similar_pairs(ids, [np.frombuffer(x, np.uint64) for x in raw], similarity, first)) if raw else (ids, ids)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    spread = docs.withColumnRenamed("doc_id", "doc").join(told, "doc").select("node", "text", "h1", "at").mapInArrow(sets, "node long, key long, i int, j int, own int, raw binary")
    return spread.groupBy("key", "i", "j").applyInArrow(local, "a long, b long")


def _labels(docs: DataFrame, similarity: float, text_col: str, id_col: str, shingle_words: int, radius: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, hash, h1, h2, ..) of each row, and (h1, h2, root) of each set of shingles: sets that link have one root.
    Nodes are the sets' smallest ids; unless by_id, sets that share that id are nodes of their own."""
    text = F.col(text_col).cast("string")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    base = materialise(_sketches(plain, shingle_words))
    reps = base.where("doc_id IS NOT NULL").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "fp", "n", "keys")).alias("x")).select(F.col("x.doc_id").alias("doc"), "h1", "h2", "x.fp", "x.n", "x.keys")
    if by_id:
        reps = materialise(reps.withColumn("node", F.col("doc")))
    else:
        reps = materialise(reps)
        shared = materialise(reps.groupBy("doc").agg(F.count("*").alias("c")).where("c > 1").select("doc", F.lit(True).alias("shared")))
        reps = reps.join(shared, "doc", "left").withColumn("node", F.when(F.col("shared"), F.col("h1")).otherwise(F.col("doc"))).drop("shared")
    lead = materialise(reps.groupBy("fp").agg(F.min("node").alias("lead")))
    same = reps.join(lead, "fp").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    at = lambda side: lead.select(F.col("fp").alias(side), F.col("lead").alias(f"{side}_doc"))
    close = link(lead.select("fp"), radius).join(at("a"), "a").join(at("b"), "b").select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"))
    edges = same.unionAll(close).unionAll(_verified(plain.drop("hash"), reps, similarity, shingle_words))
    comps = materialise(connected_components(edges))
    return base, materialise(reps.join(comps, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("root")))


def near_copies(docs: DataFrame, similarity: float = 0.8, text_col: str = "text", id_col: str = "doc_id", shingle_words: int = 5, radius: int = 2) -> DataFrame:
    """(doc_id, component_id), one row per row of docs: the smallest id reachable over similar texts.

    Texts link where their SimHash fingerprints differ in radius bits or fewer, and where their sets of word
    shingles have a Jaccard similarity of similarity or more. Words as in simhash.near_duplicates(); texts
    without words are copies of each other. Repeated rows each return; rows that share an id have each the
    component of its own text. Rows with a null id link nothing and have a null component_id. Equal sets meet
    as one, named by their smallest id, so that copies cost one row in the search. Texts of any length are read
    whole; an empty table gives no rows; other columns play no part.
    """
    base, labels = _labels(docs, similarity, text_col, id_col, shingle_words, radius, True)
    return base.join(labels, ["h1", "h2"], "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id"))


def keep_one_copy(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", similarity: float = 0.8, shingle_words: int = 5, radius: int = 2) -> DataFrame:
    """docs with one row of each group of texts that link as in near_copies; all columns stay, and rows with a null id.

    That with the smallest id stays. Rows are told apart by id and text: texts that share an id link only if they
    are similar, and of those with the group's smallest id one stays, any one of rows with the same text.
    """
    base, labels = _labels(docs, similarity, text_col, id_col, shingle_words, radius, False)
    rows = materialise(base.where("doc_id IS NOT NULL").join(labels, ["h1", "h2"]).groupBy("root", "doc_id", "hash").agg(F.count("*").alias("c")))
    stay = materialise(rows.groupBy("root").agg(F.min(F.struct("doc_id", "hash", "c")).alias("x")).select("x.*"))
    many = materialise(stay.where("c > 1").select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash")))
    gone = rows.join(stay, ["doc_id", "hash"], "left_anti").select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"))
    keyed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__hash": F.xxhash64(F.col(text_col).cast("string"))})
    once = keyed.join(gone.unionAll(many), ["__id", "__hash"], "left_anti")
    return once.unionByName(keyed.join(many, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"])).drop("__id", "__hash")
