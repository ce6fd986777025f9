"""Vocabulary files, whole texts as ids, and texts cut where the pre-token pattern always cuts."""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
from functools import lru_cache

import regex

#: The split of byte-level pre-tokens that tokenizers files with use_regex imply, and the same split for
#: texts in which no two blanks are neighbours, which needs no look ahead.
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONE_BLANKS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
#: Blanks as Unicode's White_Space property, as the tokenizer libraries read the pattern's classes.
_SPACE = {r"\s": r"\p{White_Space}", r"\S": r"\P{White_Space}"}
_PLAIN, _TWO_BLANKS = re.compile("[^\n -~¡-ɏ]"), re.compile(r"\s\s")


@lru_cache(maxsize=8)
def pattern(source: str) -> regex.Pattern:
    for short, full in _SPACE.items():
        source = source.replace(short, full)
    return regex.compile(source)


def chunks(text: str) -> list[str] | None:
    """text cut before its single spaces and line ends, where byte-level pre-tokens always end; None if
    it has rarer characters or runs of blanks that such a cut could part, and so needs the pattern itself."""
    if _PLAIN.search(text) or "  " in text or " \n" in text:
        return None
    if "\n\n" not in text:
        text = text.replace("\n", "\0\n")
    return text.replace(" ", "\0 ").split("\0")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=8)
def special_strings(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(x["content"] for x in json.load(f).get("added_tokens") or ())


@lru_cache(maxsize=8)
def cuts_at_spaces(path: str) -> bool:
    """Whether a tokenizers file has the byte-level pre-tokens that chunks() respects and nothing else that looks across them."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")


@lru_cache(maxsize=2)
def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The rank table that a byte-level .json file amounts to; None if its merges aren't in the order of its ids."""
    if not cuts_at_spaces(path):
        return None
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or sorted(vocab[c] for c in sign) != list(range(256)):
        return None
    return {bytes(map(sign.__getitem__, k)): v for k, v in vocab.items() if v < 256 + len(merges)}


def quiet_threads() -> None:
    """One thread to a worker: executors give a task one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


@lru_cache(maxsize=2)
def library(path: str):
    """The tokenizer of a .json or .model file, kept by the worker process."""
    quiet_threads()
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return tok
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=path)
    raise ValueError(f"neither .json nor .model: {path}")


def library_ids(path: str, texts: list[str]) -> list[list[int]]:
    """Whole texts as the library gives them, without added begin or end tokens."""
    tok = library(path)
    if path.endswith(".model"):
        return tok.encode(texts, num_threads=1) if texts else []
    return [x.ids for x in tok.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=1 << 16)
def _is_assigned(c: str) -> bool:
    return unicodedata.category(c) != "Cn"


def assigned(text: str) -> bool:
    """Whether all libraries class all characters alike: code points that Unicode 15.1 hasn't assigned differ by version."""
    return text.isascii() or all(map(_is_assigned, set(text)))


class WholeTexts:
    """Ids of whole texts as the library of a .json or .model file gives them.

    Where the file amounts to a rank table, tiktoken's encoder gives the same ids in a tenth of the time. Texts with
    special strings or unassigned characters, and files of other kinds, go to the library itself.
    """

    def __init__(self, path: str):
        self.path, self.special = path, special_strings(path) if path.endswith(".json") else ()
        self.every = self.lone = None
        if (ranks := merge_ranks(path)) is not None:
            import tiktoken

            self.every, self.lone = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (GPT_PATTERN, LONE_BLANKS))

    def ids(self, text: str) -> list[int]:
        if self.every is None or any(s in text for s in self.special) or not assigned(text):
            return library_ids(self.path, [text])[0]
        return self.every(text) if _TWO_BLANKS.search(text) else self.lone(text)


@lru_cache(maxsize=1)
def whole_texts(path: str) -> WholeTexts:
    """The worker process's encoder for a file."""
    return WholeTexts(path)
