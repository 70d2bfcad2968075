"""Token counts by rank-synchronous array merging.

The rules come from a tokenizer file (byte-level BPE with word ends, lower case). Pre-tokens that a
task has not met before are held as one ragged numpy array of symbols; each round finds the lowest
merge rank of every pre-token, applies that pair everywhere in it at once, and stops when no
pre-token has a pair left. The symbols that survive are its tokens. Counts of pre-tokens are kept in
a table of bounded size; a text's count is the sum over its pre-tokens.

Defined cases: a null or empty text has no tokens. Special strings inside a text count as one token
each, as the library has it by default. Whole texts are counted, without truncation.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from weirstone.llm.arrays import slices

KEPT_WORDS = 250_000


class MergeRules:
    """Merge ranks and symbols of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = _byte_letters()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.width = max(ids.values()) + 1
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.inner = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[letters[b] + suffix] for b in range(256)], np.int64)
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.marks = tuple(t["content"] for t in spec["added_tokens"])

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and the number of special strings in it."""
        if any(mark in text for mark in self.marks):
            parts = self.special.split(text)
            found = [self.split.findall(self.folded(p)) for p in parts]
            return [w for ws in found for w in ws], len(parts) - 1
        return self.split.findall(self.folded(text)), 0

    @staticmethod
    def folded(text: str) -> str:
        if text.isascii():
            return text.lower()
        # lower case letter by letter: no special form of sigma at the end of a word
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token, all merged together."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[data]
        symbol[np.cumsum(sizes) - 1] = self.last[data[np.cumsum(sizes) - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        result = sizes.copy()
        none = len(self.keys)
        while len(symbol) > 1:
            key = symbol[:-1] * self.width + symbol[1:]
            at = np.searchsorted(self.keys, key)
            at[at == none] = 0
            valid = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.where(valid, self.rank[at], none)
            lowest = np.full(len(words), none, np.int64)
            np.minimum.at(lowest, word[:-1], rank)
            chosen = valid & (rank == lowest[word[:-1]])
            spots = np.flatnonzero(chosen)
            if not len(spots):
                break
            # of touching pairs such as (a a) a every second one stays, from the left
            breaks = np.concatenate([[True], np.diff(spots) > 1])
            begin = np.maximum.accumulate(np.where(breaks, np.arange(len(spots)), 0))
            spots = spots[(np.arange(len(spots)) - begin) % 2 == 0]
            symbol[spots] = self.made[at[spots]]
            keep = np.ones(len(symbol), bool)
            keep[spots + 1] = False
            result -= np.bincount(word[spots], minlength=len(words))
            # a pre-token without any pair left is finished
            keep &= lowest[word] < none
            symbol, word = symbol[keep], word[keep]
        return result


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@cache
def rules(path: str) -> MergeRules:
    return MergeRules(path)


class Counter:
    """Counts texts; pre-tokens met before are looked up. Holds two generations of words at most."""

    def __init__(self, merge_rules: MergeRules, kept: int = KEPT_WORDS):
        self.rules, self.kept = merge_rules, kept
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> list[int]:
        split = [self.rules.pre_tokens(t) if t else ([], 0) for t in texts]
        fresh = {w for ws, _ in split for w in ws if w not in self.known}
        if len(self.known) + len(fresh) > self.kept:
            fresh = {w for ws, _ in split for w in ws}
            self.known = {}
        if fresh:
            listed = list(fresh)
            self.known.update(zip(listed, self.rules.counts(listed).tolist(), strict=True))
        look = self.known.__getitem__
        return [sum(map(look, ws)) + specials for ws, specials in split]


def token_counter(path: str) -> Callable[[Column], Column]:
    """Column function: text to its number of tokens under the tokenizer file at ``path``."""

    @F.arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(rules(path))
        for column in parts:
            found = []
            for first, last in slices(column):
                found.extend(counter(column.slice(first, last - first).to_pylist()))
            yield pa.array(found, pa.int64())

    return count
