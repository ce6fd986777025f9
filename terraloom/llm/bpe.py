"""Byte-level BPE by backtracking over longest matches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vocab import GPT_PATTERN, chunks, load_ranks, pattern

#: Neighbour pairs that are remembered before the memo starts afresh.
PAIR_ROWS = 1 << 20


class PieceCache(dict):
    """What encode gives for pieces of text, in bounded memory.

    The first KEPT pieces stay, as frequent ones come early; later ones go to a smaller part that
    starts afresh when full. A new piece that is a word with marks after it is put together from both.
    """

    KEPT, RECENT, LONGEST = 300_000, 1 << 16, 64
    MARKS = "\n!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, encode, join, table: dict | None = None):
        super().__init__(table or {})
        self.encode, self.join, self.recent, self.most = encode, join, {}, self.KEPT + len(self)

    def __missing__(self, part: str):
        word = part.rstrip(self.MARKS)
        if len(word) < len(part) and word and word[-1].isalnum():
            return self.join(self.of(word), self.of(part[len(word) :]))
        return self.of(part)

    def of(self, part: str):
        if (got := self.get(part)) is not None or (got := self.recent.get(part)) is not None:
            return got
        got = self.encode(part)
        if len(part) <= self.LONGEST:
            if len(self) < self.most:
                self[part] = got
            else:
                if len(self.recent) >= self.RECENT:
                    self.recent.clear()
                self.recent[part] = got
        return got


class BytePairEncoder:
    """Exact BPE of a rank table in time linear in the input.

    Bytes stand as Latin-1 characters in an Aho-Corasick trie. Encoding takes the longest token at
    each place, and steps back to a shorter one, or past the previous token, where two neighbours could
    not stand side by side after the merges. Whether they could is found by undoing merges across their
    border, and is remembered for each pair.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = {k.decode("latin-1"): v for k, v in ranks.items()}
        self.size = 1 + max(ranks.values(), default=-1)
        self.text = [""] * self.size
        self.trie = ahocorasick.Automaton()
        for k, v in self.ids.items():
            self.text[v] = k
            self.trie.add_word(k, v)
        self.raw = [x.encode("latin-1") for x in self.text]
        self.len = [len(x) for x in self.text]
        self.shorter = [self._prefix(x[:-1]) for x in self.text]
        self.left, self.right = list(range(self.size)), list(range(self.size))
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        for token in range(self.size):
            head = self.shorter[token]
            while head >= 0:
                tail = self.ids.get(self.text[token][self.len[head] :])
                if tail is not None and head < token and tail < token and self._compatible(head, tail):
                    self.merged[head, tail] = token
                    self.left[token], self.right[token] = head, tail
                    break
                head = self.shorter[head]

    def _prefix(self, s: str) -> int:
        n = self.trie.longest_prefix(s) if s else 0
        while n:
            if (found := self.ids.get(s[:n])) is not None:
                return found
            n -= 1
        return -1

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves a border between the tokens: no merge across it comes before both are made."""
        merged, left, right, limit = self.merged, self.left, self.right, self.size
        while True:
            if merged.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, right[a]
                if a == limit:
                    limit, b = b + 1, left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    limit, a = a, right[a]
                    if a == limit:
                        return True

    def fits(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIR_ROWS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one pre-token."""
        s = piece.decode("latin-1")
        if (whole := self.ids.get(s)) is not None:
            return [whole]
        out: list[int] = []
        pos, end, dead = 0, len(s), set()
        token = self._prefix(s) if s else -1
        while token >= 0:
            last = out[-1] if out else -1
            while True:
                stop = pos + self.len[token]
                if stop not in dead and (last < 0 or self.fits(last, token)):
                    out.append(token)
                    pos = stop
                    token = self._prefix(s[pos : pos + 512]) if pos < end else -1
                    break
                token = self.shorter[token]
                if token < 0:
                    dead.add(pos)
                    if out:
                        out.pop()
                        pos -= self.len[last]
                    token = last
                    break
        return out


def _joined(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    return a[0] + b"," + b[0], a[1] + b[1]


class TextEncoder:
    """Whole texts: cuts them into pre-tokens, and keeps what it has encoded in bounded caches.

    Only the one pattern that is known to end a match at each single blank is cut there first; any other is matched as it stands."""

    def __init__(self, ranks: dict[bytes, int], source: str):
        self.bpe, self.pattern, self.cuts = BytePairEncoder(ranks), pattern(source), source == GPT_PATTERN
        self.known = PieceCache(self._pair, _joined)

    def ids(self, text: str) -> list[int]:
        if self.cuts and text.removeprefix(" ").isalpha() and text.isascii():
            return self.bpe.encode(text.encode())
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out += self.bpe.encode(piece.encode("utf-8", "surrogatepass"))
        return out

    def decode(self, ids: list[int]) -> bytes:
        raw = self.bpe.raw
        return b"".join([raw[i] for i in ids])

    def _pair(self, text: str) -> tuple[bytes, bytes]:
        ids = self.ids(text)
        return ",".join(map(str, ids)).encode(), self.decode(ids)

    def both(self, text: str) -> tuple[bytes, bytes]:
        """Decimal ids joined by commas, and the bytes they decode to."""
        parts = chunks(text) if self.cuts else None
        if parts is None:
            return self._pair(text)
        got = [x for x in map(self.known.__getitem__, parts) if x[0]]
        return b",".join([x[0] for x in got]), b"".join([x[1] for x in got])


_held: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, source: str) -> TextEncoder:
    """The worker process's own encoder for a rank file."""
    if (path, source) not in _held:
        _held.clear()
        _held[path, source] = TextEncoder(load_ranks(path), source)
    return _held[path, source]


def encode_documents(docs: DataFrame, ranks_path: str, source: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>): the tokens of each whole text, without special tokens; a null text is empty.

    Rows are independent: null ids and repeated rows pass through, an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, source)
        for batch in batches:
            ids = pa.array([enc.ids(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, source: str) -> DataFrame:
    """(doc_id, decoded binary) from (doc_id, ids); null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, source)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([enc.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, source: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each whole text, encoded and decoded in one pass.

    A null text is empty: no tokens, the digests of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sha = encoder(ranks_path, source), hashlib.sha256
        for batch in batches:
            n, a, b = [], [], []
            for text in batch.column(1).to_pylist():
                ids, raw = enc.both(text or "")
                n.append(ids.count(b",") + 1 if ids else 0)
                a.append(sha(ids).hexdigest())
                b.append(sha(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
