"""Suffix order with common prefixes by external induced sorting."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Separators are 0 and bytes 1 to 256; queue blocks hold so many entries.
ALPHABET, BLOCK = 257, 1 << 20
_ENTRY = np.dtype([("at", "<i8"), ("lcp", "<i2")])
_FAR = np.int16(32000)


class BucketQueues:
    """First-in-first-out queues of suffix tuples, one for each first character. Induction meets
    suffixes in order, so that the queues together are its priority queue; past the limit of memory the
    longest ones go to unnamed files of the task."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in range(ALPHABET)]
        self.files: dict[int, object] = {}

    def push(self, c: int, at: np.ndarray, lcp: np.ndarray) -> None:
        x = np.empty(len(at), _ENTRY)
        x["at"], x["lcp"] = at, lcp
        self.parts[c].append(x)
        self.held += x.nbytes
        while self.held > self.limit:
            big = max(range(ALPHABET), key=lambda k: sum(p.nbytes for p in self.parts[k]))
            if big not in self.files:
                self.files[big] = tempfile.TemporaryFile()
            f = self.files[big]
            f.seek(0, 2)
            for p in self.parts[big]:
                self.held -= p.nbytes
                f.write(p.tobytes())
            self.parts[big] = []

    def take(self, c: int) -> Iterator[np.ndarray]:
        """Blocks in order, until none is left; entries may be pushed meanwhile."""
        at = 0
        while True:
            if c in self.files:
                f = self.files[c]
                f.seek(at)
                if raw := f.read(BLOCK * _ENTRY.itemsize):
                    at += len(raw)
                    yield np.frombuffer(raw, _ENTRY)
                    continue
            if not self.parts[c]:
                break
            x = np.concatenate(self.parts[c])
            self.parts[c] = []
            self.held -= x.nbytes
            yield x

    def read(self, c: int, backwards: bool) -> Iterator[np.ndarray]:
        """All blocks of a queue that is no longer pushed to."""
        n = 0
        if c in self.files:
            n = self.files[c].seek(0, 2) // _ENTRY.itemsize
        spans = list(range(0, n, BLOCK))
        def filed():
            for s in reversed(spans) if backwards else spans:
                self.files[c].seek(s * _ENTRY.itemsize)
                yield np.frombuffer(self.files[c].read(min(BLOCK, n - s) * _ENTRY.itemsize), _ENTRY)
        if not backwards:
            yield from filed()
        if self.parts[c]:
            yield np.concatenate(self.parts[c])
        if backwards:
            yield from filed()

    def close(self) -> None:
        for f in self.files.values():
            f.close()


class Inducer:
    """Puts predecessors of sources, which come in order, into their queues, and carries common prefixes:
    that of two neighbours in a queue is one more than the least between their sources."""

    def __init__(self, text: np.ndarray, take: np.ndarray, queues: BucketQueues, cap: int):
        self.text, self.take, self.queues, self.cap = text, take, queues, cap
        self.least = np.full(ALPHABET, -1, np.int16)  # since the last source of each character; -1: none yet

    def feed(self, at: np.ndarray, lcp: np.ndarray) -> None:
        text, m = self.text, len(at)
        if not m:
            return
        ok = np.flatnonzero(at > 0)
        ok = ok[self.take[at[ok] - 1]]
        lcp = np.append(lcp, _FAR)
        low = lcp[:m].min()
        seen = self.least >= 0
        if len(ok):
            pred = at[ok] - 1
            chars = text[pred]
            order = np.argsort(chars, kind="stable")
            k, c, pred = ok[order], chars[order], pred[order]
            first = np.empty(len(c), bool)
            first[0], first[1:] = True, c[1:] != c[:-1]
            begin = np.where(first, 0, np.append(0, k[:-1]) + 1)
            pairs = np.empty(2 * len(k), np.int64)
            pairs[::2], pairs[1::2] = begin, k + 1
            new = np.minimum.reduceat(lcp, pairs)[::2]
            heads = np.flatnonzero(first)
            before = self.least[c[heads]]
            new[heads] = np.where(before < 0, -1, np.minimum(new[heads], before))
            new = np.minimum(new + 1, self.cap).astype(np.int16)
            ends = np.append(heads[1:], len(c))
            self.least[seen] = np.minimum(self.least[seen], low)
            for h, e in zip(heads, ends):
                ch = int(c[h])
                self.queues.push(ch, pred[h:e], new[h:e])
                tail = lcp[k[e - 1] + 1 : m]
                self.least[ch] = tail.min() if len(tail) else _FAR
        else:
            self.least[seen] = np.minimum(self.least[seen], low)


def _word(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Seven characters from at + depth as one integer, zero after a separator; text ends with zeros."""
    out, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for i in range(7):
        ch = np.where(alive, text[np.minimum(at + depth + i, len(text) - 1)], 0).astype(np.int64)
        alive &= ch > 0
        out = out << 9 | ch
    return out


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffixes a and b, at most cap; separators differ from each other."""
    out, live = np.zeros(len(a), np.int16), np.arange(len(a))
    for d in range(cap):
        x, y = text[a[live] + d], text[b[live] + d]
        live = live[(x == y) & (x > 0)]
        if not len(live):
            break
        out[live] += 1
    return out


def _seeds(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Left-most S suffixes in order, as far as the depth: groups that are still equal are parted by the next characters."""
    order, rank = lms, np.zeros(len(lms), np.int64)
    d = 0
    while d < depth and len(order):
        group = np.flatnonzero(np.bincount(rank, minlength=1)[rank] > 1) if d else np.arange(len(order))
        if not len(group):
            break
        w = _word(text, order[group], d)
        s = np.lexsort((w, rank[group]))
        order[group] = order[group][s]
        new = np.zeros(len(order), bool)
        new[0] = True
        new[1:] = rank[1:] != rank[:-1]
        w = w[s]
        r = rank[group]
        split = np.zeros(len(group), bool)
        split[1:] = (r[1:] == r[:-1]) & (w[1:] != w[:-1])
        new[group[split]] = True
        rank = np.cumsum(new) - 1
        d += 7
    return order


def sorted_suffixes(pieces: list[bytes], cap: int, memory: int = 256 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (start, lcp) of all suffixes of the pieces, from the last in order to the first, and the
    pieces' starts in the joined text. lcp, at most cap, is the common prefix with the suffix given
    before. Suffixes that agree in cap characters or more stand together; matches don't cross pieces."""
    if not pieces:
        return
    size = sum(map(len, pieces)) + len(pieces)
    pad = cap + 16
    if size * 2 > memory:
        file = tempfile.TemporaryFile()
        text = np.memmap(file, np.uint16, "w+", shape=(size + pad,))
    else:
        text = np.zeros(size + pad, np.uint16)
    starts = np.zeros(len(pieces), np.int64)
    np.cumsum([len(p) + 1 for p in pieces[:-1]], out=starts[1:])
    for s, p in zip(starts, pieces):
        text[s : s + len(p)] = np.frombuffer(p, np.uint8).astype(np.uint16) + 1
    body = text[:size]
    # S type: smaller than the next suffix; equal characters take the type of the next one
    diff = np.ones(size, np.int8)
    diff[:-1] = np.sign(body[1:].astype(np.int32) - body[:-1].astype(np.int32))
    known = np.where(diff != 0, np.arange(size), size)
    known = np.minimum.accumulate(known[::-1])[::-1]
    small = (diff[np.minimum(known, size - 1)] > 0) | (body == 0)
    lms = np.flatnonzero(small & np.append(False, ~small[:-1]) & (body > 0))
    seeds = _seeds(text, lms, cap + 4)
    gap = np.zeros(len(seeds), np.int16)
    gap[1:] = common(text, seeds[1:], seeds[:-1], cap)
    bounds = np.searchsorted(body[seeds], np.arange(ALPHABET + 1))
    incoming, kept, smalls = BucketQueues(memory // 4), BucketQueues(memory // 4), BucketQueues(memory // 4)
    try:
        up = Inducer(text, ~small & (body > 0), incoming, cap)
        ends = np.flatnonzero(body == 0)
        up.feed(ends, np.zeros(len(ends), np.int16))
        for c in range(1, ALPHABET):
            last = -1
            for block in incoming.take(c):
                kept.push(c, block["at"], block["lcp"])
                up.feed(block["at"].astype(np.int64), block["lcp"].copy())
                last = int(block["at"][-1])
            lo, hi = bounds[c], bounds[c + 1]
            if hi > lo:
                g = gap[lo:hi].copy()
                g[0] = common(text, seeds[lo : lo + 1], np.array([last]), cap)[0] if last >= 0 else 0
                up.feed(seeds[lo:hi], g)
        down = Inducer(text, small & (body > 0), smalls, cap)
        for c in range(ALPHABET - 1, 0, -1):
            last = -1
            for block in smalls.take(c):
                at = block["at"].astype(np.int64)
                down.feed(at, block["lcp"].copy())
                yield at, block["lcp"], starts
                last = int(at[-1])
            carry = None
            for block in kept.read(c, backwards=True):
                at, own = block["at"][::-1].astype(np.int64), block["lcp"][::-1]
                lcp = np.empty(len(at), np.int16)
                lcp[1:] = own[:-1]
                lcp[0] = carry if carry is not None else (common(text, at[:1], np.array([last]), cap)[0] if last >= 0 else 0)
                carry = own[-1]
                down.feed(at, lcp)
                yield at, lcp, starts
    finally:
        for q in (incoming, kept, smalls):
            q.close()
