"""Token counts from a two-tier lookup on the map side."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .vocab import GPT_PATTERN, assigned, chunks, cuts_at_spaces, library_ids, pattern, special_strings

#: Entries of the broadcast table, of one task's summary, and summaries that are merged at a time.
TABLE_ROWS, SUMMARY_ROWS, FAN_IN = 1 << 16, 1 << 14, 64
#: Distinct groups that a task counts before it lets rare ones go, and the longest that are counted or remembered.
COUNTED, LONGEST = 1 << 18, 64


def groups(text: str, special: tuple[str, ...]) -> list[str] | None:
    """text cut into pre-tokens, or into groups of a few that end where pre-tokens do; None if it has special strings
    or characters that the pattern and the library may class differently."""
    if any(s in text for s in special):
        return None
    if (parts := chunks(text)) is not None:
        return parts
    return pattern(GPT_PATTERN).findall(text) if assigned(text) else None


class Lengths(dict):
    """Lengths in tokens. The first tier is the table of frequent pre-tokens; the second, in bounded memory, holds
    the groups and pre-tokens that this worker has met besides: the first KEPT stay, later ones go to a part that starts afresh when full."""

    KEPT, RECENT = 300_000, 1 << 16

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(table)
        self.path, self.recent, self.most, self.cut = path, {}, self.KEPT + len(table), pattern(GPT_PATTERN).findall

    def __missing__(self, part: str) -> int:
        if (got := self.recent.get(part)) is not None:
            return got
        tokens = self.cut(part)
        got = sum(map(self.__getitem__, tokens)) if len(tokens) > 1 else len(library_ids(self.path, [part])[0])
        if len(part) <= LONGEST:
            if len(self) < self.most:
                self[part] = got
            else:
                if len(self.recent) >= self.RECENT:
                    self.recent.clear()
                self.recent[part] = got
        return got


_held: dict[str, Lengths] = {}


def held_lengths(key: str, table: Broadcast, path: str) -> Lengths:
    """The worker process's lookup for one broadcast table; tasks find it by the module."""
    if key not in _held:
        _held.clear()
        parts, sizes = table.value
        _held[key] = Lengths(path, dict(zip(parts.split("\0") if sizes else (), sizes)))
    return _held[key]


def _lighter(counts: Counter, keep: int) -> Counter:
    """The keep largest counts, less the next one: a summary of bounded size whose counts are short by that at most."""
    top = counts.most_common(keep + 1)
    least = top[keep][1] if len(top) > keep else 0
    return Counter({x: n - least for x, n in top[:keep] if n > least})


def _summary(slot: int, counts: Counter, rows: int) -> pa.RecordBatch:
    top = counts.most_common(rows)
    kinds = (pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((slot, [x for x, _ in top], [n for _, n in top]), kinds)], ["slot", "parts", "counts"])


def frequent_pre_tokens(docs: DataFrame, path: str, text_col: str, rows: int = TABLE_ROWS) -> list[str]:
    """At most rows pre-tokens, the most frequent of all texts. Each task sends one summary of bounded size, counted
    over all its texts with rare groups let go; summaries are merged FAN_IN at a time, so that no pre-token is shuffled by
    itself. The table only warms the lookup: what it lacks is encoded by the worker."""
    special = special_strings(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, cut, tokens = Counter(), pattern(GPT_PATTERN).findall, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(groups(text or "", special) or ())
                if len(seen) > COUNTED:
                    seen = _lighter(seen, COUNTED // 2)
        for part, n in seen.items():
            for x in cut(part):
                if len(x) <= LONGEST and "\0" not in x:
                    tokens[x] += n
        yield _summary(TaskContext.get().partitionId(), tokens, min(rows, SUMMARY_ROWS))

    def merge(table: pa.Table) -> pa.Table:
        total: Counter = Counter()
        for parts, counts in zip(*(table.column(i).to_pylist() for i in (1, 2))):
            for x, n in zip(parts, counts):
                total[x] += n
        return pa.Table.from_batches([_summary(table.column(0)[0].as_py() // FAN_IN, total, rows)])

    kind = "slot int, parts array<string>, counts array<long>"
    found = materialise(docs.select(F.col(text_col).cast("string")).mapInArrow(count, kind))
    slots = (found.agg(F.max("slot")).first()[0] or 0) + 1
    while slots > 1:
        found, slots = found.groupBy(F.floor(F.col("slot") / FAN_IN).alias("of")).applyInArrow(merge, kind), -(-slots // FAN_IN)
    row = found.select("parts").first()
    return row["parts"] if row else []


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text_col: str = "text", id_col: str = "doc_id", table_rows: int = TABLE_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each whole text, as the file's own library counts.

    Byte-level .json files: texts are cut into pre-tokens, or into groups that are cut further when first met; lengths
    come from a broadcast table of the most frequent pre-tokens of all texts (at most table_rows, of 64 characters at
    most), then from the worker's cache, then from the library, with no shuffle of pre-tokens. Texts with special strings
    or characters unassigned in Unicode 15.1, and files of other kinds, go to the library whole. A null text is empty;
    null ids, repeated rows and texts of any length are counted like any other; an empty table gives no rows; other columns play no part.
    """
    fast = cuts_at_spaces(path)
    parts = frequent_pre_tokens(docs, path, text_col, table_rows) if fast else []
    table = docs.sparkSession.sparkContext.broadcast(("\0".join(parts), [len(x) for x in library_ids(path, parts)]))
    special, key = special_strings(path) if fast else (), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if fast:
            get = held_lengths(key, table, path).__getitem__
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = [0] * len(texts)
            for i, text in enumerate(texts):
                parts = groups(text, special) if fast else None
                out[i] = len(library_ids(path, [text])[0]) if parts is None else sum(map(get, parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.int64()), pa.array([n > limit for n in out], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
