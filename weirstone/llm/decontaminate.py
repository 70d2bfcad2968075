"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming tables, exact check.

A window is as many consecutive words of a document as an item has. A document with fewer words than
an item is one window as a whole, as long as it has 0.8 of the item's shingles: with fewer it cannot
reach the similarity. Only windows that share a shingle with an item of their size can be similar to one, so
these are formed, all of them. Each window gets a 64-bit SimHash of its shingles. Items lie in eight
tables by the bytes of their own SimHash: fingerprints within ``RADIUS`` bits agree up to
``RADIUS // 8`` bits in at least one byte, so the tables return every item within the radius. What
they return is verified by the weighted Jaccard similarity of the shingles (a shingle weighs as
often as it occurs), 0.8 or more. At that similarity a bit of two fingerprints differs with
probability 0.15, so 23 of 64 differing bits lie beyond four standard deviations; a similar window
that is missed there has neighbours, one word on, that are tried as well (a whole document has none).

Words are lower-cased runs of letters, digits and non-ASCII; shingles have five words, or all words
of a shorter item. Items go to the tasks in blocks of at most ``BLOCK_WORDS`` words, whatever the
size of the benchmark; a larger benchmark takes more passes.

Defined cases: null or empty texts and items without words match nothing. Equal items are all
reported. Of several windows of a document that match an item the most similar one is given, of
equal ones the first. An empty table of either kind gives no match.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.arrays import LOWER, NOT_WORD, Lookup, Prefixes, shingles, slices, text_buffer, words

RADIUS = 23
SHINGLE = 5
BLOCK_WORDS = 1_000_000
WINDOWS_AT_ONCE = 1024
MATCH = "array<struct<item:int,start:long,words:long,similarity:double,distance:int>>"

_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NEAR = [np.flatnonzero(_BITS[np.arange(256) ^ v] <= RADIUS // 8) for v in range(256)]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, stops, first = words(data, offsets, NOT_WORD)
    return Prefixes(data).windows(starts, stops), first


def simhash(rows: np.ndarray) -> np.ndarray:
    """Fingerprint of each row of a matrix of shingle hashes, as eight bytes."""
    bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8).reshape(*rows.shape, 8), axis=2)
    return np.packbits(2 * bits.sum(axis=1, dtype=np.int32) > rows.shape[1], axis=1)


class ItemIndex:
    """A block of items: their shingles, and the tables of their fingerprints."""

    def __init__(self, texts: list[str]):
        hashed, first = word_hashes(pa.array(texts, pa.string()))
        self.sizes = np.diff(first)
        self.shingle = np.minimum(self.sizes, SHINGLE)
        found, row = shingles(hashed, first, SHINGLE)
        self.begin = np.searchsorted(row, np.arange(len(texts) + 1))
        self.found = found
        self.fingerprint = np.zeros((len(texts), 8), np.uint8)
        for i in np.flatnonzero(self.sizes):
            self.fingerprint[i] = simhash(found[None, self.begin[i] : self.begin[i + 1]])[0]
        usable = np.flatnonzero(self.sizes)
        # tables[b][v]: items whose byte b is within the byte's share of the radius of v
        self.tables = []
        for b in range(8):
            lists: list[list[int]] = [[] for _ in range(256)]
            for i in usable.tolist():
                for v in _NEAR[self.fingerprint[i, b]].tolist():
                    lists[v].append(i)
            ends = np.cumsum([len(x) for x in lists])
            self.tables.append((np.concatenate([[0], ends]), np.array([i for x in lists for i in x], np.int64)))
        # for every shingle size the known shingles, and the item sizes that each belongs to
        self.gates = {}
        for k in np.unique(self.shingle[usable]).tolist():
            members = usable[self.shingle[usable] == k]
            pairs = {(int(h), int(self.sizes[i])) for i in members for h in found[self.begin[i] : self.begin[i + 1]]}
            self.gates[k] = [(size, Lookup(np.array([h for h, s in pairs if s == size], np.uint64))) for size in sorted({s for _, s in pairs})]

    def near(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, item and distance for all items of ``size`` words within the radius."""
        keys = []
        for b, (ends, members) in enumerate(self.tables):
            value = prints[:, b]
            n = ends[value.astype(np.int64) + 1] - ends[value]
            window = np.repeat(np.arange(len(prints)), n)
            item = members[np.repeat(ends[value] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            keys.append(window[self.sizes[item] == size] * len(self.sizes) + item[self.sizes[item] == size])
        window, item = np.divmod(np.unique(np.concatenate(keys)), len(self.sizes))
        distance = _BITS[prints[window] ^ self.fingerprint[item]].sum(axis=1, dtype=np.int64)
        within = distance <= RADIUS
        return window[within], item[within], distance[within]

    def similarity(self, rows: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of each row of shingles with its item."""
        n = self.begin[item + 1] - self.begin[item]
        theirs = self.found[np.repeat(self.begin[item] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        pair = np.concatenate([np.repeat(np.arange(len(item)), rows.shape[1]), np.repeat(np.arange(len(item)), n)])
        value = np.concatenate([rows.ravel(), theirs])
        ours = np.arange(len(value)) < rows.size
        order = np.lexsort((value, pair))
        pair, value, ours = pair[order], value[order], ours[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (pair[1:] != pair[:-1])
        group = np.cumsum(new) - 1
        left = np.bincount(group, weights=ours)
        right = np.bincount(group, weights=~ours)
        owner = pair[new]
        return np.bincount(owner, weights=np.minimum(left, right), minlength=len(item)) / np.bincount(owner, weights=np.maximum(left, right), minlength=len(item))

    def matches(self, column: pa.Array, threshold: float) -> dict[int, dict[int, tuple]]:
        """For each row of the column its items, with the best window."""
        hashed, first = word_hashes(column)
        result: dict[int, dict[int, tuple]] = {}
        counts = np.diff(first)
        for k, gates in self.gates.items():
            found, row = shingles(hashed, first, k)
            full = counts[row] >= k  # a shorter document has no shingle of this size
            found, row = found[full], row[full]
            base = np.searchsorted(row, np.arange(len(counts)))
            for size, lookup in gates:
                spot, _ = lookup(found)
                width = size - k + 1
                long = counts[row[spot]] >= size
                whole = np.unique(row[spot[~long]])
                whole = whole[(counts[whole] - k + 1) / width >= threshold]
                self._compare(result, found, base[whole], whole, base, counts[whole], k, size, threshold)
                spot = spot[long]
                start = (spot[:, None] - np.arange(width)[None, :]).ravel()
                owner = np.repeat(row[spot], width)
                inside = (start >= base[owner]) & (start - base[owner] + size <= counts[owner])
                start, one = np.unique(start[inside], return_index=True)
                owner = owner[inside][one]
                self._compare(result, found, start, owner, base, np.full(len(start), size), k, size, threshold)
        return result

    def _compare(self, result: dict[int, dict[int, tuple]], found: np.ndarray, start: np.ndarray, owner: np.ndarray, base: np.ndarray, length: np.ndarray, k: int, size: int, threshold: float) -> None:
        """Enter into ``result`` the windows of ``length`` words from the shingles ``start`` on that match items of ``size`` words."""
        for n in np.unique(length).tolist():
            some_n = np.flatnonzero(length == n)
            for a in range(0, len(some_n), WINDOWS_AT_ONCE):
                chosen = some_n[a : a + WINDOWS_AT_ONCE]
                rows = found[start[chosen][:, None] + np.arange(n - k + 1)[None, :]]
                window, item, distance = self.near(simhash(rows), size)
                if not len(window):
                    continue
                alike = self.similarity(rows[window], item)
                for w, i, s, d in zip(chosen[window].tolist(), item.tolist(), alike.tolist(), distance.tolist(), strict=True):
                    if s >= threshold:
                        doc = int(owner[w])
                        at = int(start[w] - base[doc])
                        best = result.setdefault(doc, {})
                        if i not in best or (s, -at) > (best[i][0], -best[i][1]):
                            best[i] = (s, at, n, d)


def item_blocks(items: DataFrame, key: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> list[tuple[list, ItemIndex]]:
    """The benchmark as blocks of bounded size, each collected by itself."""
    sized = items.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    letters = sized.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-letters // (2 * block_words)))
    made = []
    for b in range(blocks):
        rows = sized.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r.k is None, r.k, r.t))
        if rows:
            made.append(([r.k for r in rows], ItemIndex([r.t for r in rows])))
    return made


def matcher(index: ItemIndex, spark, threshold: float = 0.8) -> Callable[[Column], Column]:
    """Column function: text to the items of one block that it contains."""
    shared = spark.sparkContext.broadcast(index)

    @F.arrow_udf(MATCH)
    def match(texts: pa.Array) -> pa.Array:
        rows: list[list[dict]] = []
        for first, last in slices(texts):
            found = shared.value.matches(texts.slice(first, last - first), threshold)
            for i in range(last - first):
                rows.append([{"item": k, "start": at, "words": n, "similarity": s, "distance": d} for k, (s, at, n, d) in sorted(found.get(i, {}).items())])
        fields = [("item", pa.int32()), ("start", pa.int64()), ("words", pa.int64()), ("similarity", pa.float64()), ("distance", pa.int32())]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    return match


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per document and item in it: keys, place of the window, similarity, distance."""
    spark = docs.sparkSession
    parts = []
    for keys, index in item_blocks(items, item_key, item_text):
        names = F.array(*(F.lit(k) for k in keys)) if len(keys) <= 1000 else None
        found = docs.select(F.col(key).alias("doc"), F.explode(matcher(index, spark, threshold)(F.col(text))).alias("m"))
        if names is not None:
            named = found.withColumn("name", F.element_at(names, F.col("m.item") + 1))
        else:
            listed = spark.createDataFrame(list(enumerate(keys)), f"item int, name {items.schema[item_key].dataType.simpleString()}")
            named = found.withColumn("item", F.col("m.item")).join(listed, "item")
        parts.append(named.select(F.col("doc").alias(key), F.col("name").alias(item_key), F.col("m.start").alias("start_word"), F.col("m.words").alias("n_words"), "m.similarity", "m.distance"))
    if not parts:
        empty = docs.limit(0).select(F.col(key).alias(key)).withColumn(item_key, F.lit(None).cast(items.schema[item_key].dataType))
        return empty.selectExpr(f"`{key}`", f"`{item_key}`", "0L start_word", "0L n_words", "0D similarity", "0 distance")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns stay."""
    columns = docs.columns
    for _, index in item_blocks(items, item_key, item_text):
        docs = docs.where(F.size(matcher(index, docs.sparkSession, threshold)(F.col(text))) == 0)
    return docs.select(*columns)
