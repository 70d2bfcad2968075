"""Words of a corpus grouped with their spelling variants by blocked Gram matrices.

Counting: each task counts the words of its texts in a table of bounded size, and Spark adds up.

Near pairs: two words that differ by one inserted, deleted or replaced letter have letter counts at a
squared distance of one or two. The counts of a word in ``GROUPS`` groups of letters name its block; their sum is its
length. One edit moves a word to its own block, to one with a letter moved between two groups, or to
one with a letter less, so a word visits these blocks, and of two neighbouring blocks always the same
one is visited. A large block is dealt into tiles, and a word also visits the tiles of its own
block that come before its own. In a task, the letter counts of a tile times those of the words that visit
it, in pieces, give all squared distances in one NumPy product (the squares are two more columns);
pairs at two or less are compared letter by letter. What leaves the task is, per word and piece, the
number of its near words and the best form among them.

Forms: a word's form is its near word of largest count, if that is at least ``RATIO`` times its own.
Counts grow along forms by that factor, so no chain is longer than the digits of a count, and
doubling the step five times reaches every root.

Defined cases: null and empty texts have no words, a null key deletes no letter, and an empty table
gives no rows. Rows are counted as they come, repeated ones too. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.arrays import slices
from weirstone.session import fresh_dir
from weirstone.sources.tables import staged

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
GROUPS = 4
TILE = 2048  # words of a tile, about
PIECE = 1 << 20  # entries of one product
KEPT_WORDS = 200_000

_LOWER = {c: c + 32 for c in range(65, 91)}
# Column of each letter's count: a-z and the letters beyond ASCII; A-Z do not occur in words.
_COLUMN = np.zeros(256, np.int64)
_COLUMN[97:123] = np.arange(26)
_COLUMN[192:256] = np.arange(26, 90)
WIDTH = 90

Edit = Callable[[object, str], str]


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def slipped(key: object, run: str, one_in: int = 31) -> str:
    """The run without one letter if a hash of key and run says so."""
    if key is None:
        return run
    h = crc32(f"{key}:{run}".encode())
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, edit: Edit, key: str = "doc_id", text: str = "text", kept: int = KEPT_WORDS) -> DataFrame:
    """(word, n) of all words of ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences, after ``edit``."""
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")  # a longer run cannot begin inside a shorter one

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own: Counter[str] = Counter()
                    for run, n in Counter(runs.findall(t or "")).items():
                        own[lowered(run)] += n
                    for run, n in own.items():
                        word = edit(k, run)
                        if len(word) >= LEAST_LENGTH:
                            found[word] += n
                if len(found) > kept:
                    yield _counted(found)
                    found = Counter()
        yield _counted(found)

    pairs = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(count, "word string, n long")
    return pairs.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _counted(found: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def _letters_of(group: int) -> str:
    return "".join(chr(c) for c in [*range(97, 123), *range(192, 256)] if c % GROUPS == group)


def block_of(word: Column) -> list[Column]:
    """Letters of the word in each group."""
    return [(F.length(word) - F.length(F.translate(word, _letters_of(g), ""))).cast("int") for g in range(GROUPS)]


def visited(block: list[Column]) -> Column:
    """Blocks that a word of ``block`` visits: (block, kind), kind 0 for its own length and 1 for one letter less."""

    def moved(add: int | None, take: int) -> Column:
        cells = [c + (int(g == add) - int(g == take)) for g, c in enumerate(block)]
        return F.when(block[take] > 0, F.struct(F.array(*cells).alias("block"), F.lit(int(add is None)).alias("kind")))

    same = [moved(i, j) for i in range(GROUPS) for j in range(i + 1, GROUPS)]
    return F.array_compact(F.array(*same, *(moved(None, g) for g in range(GROUPS))))


def meetings(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(block, tile, kind, word, n): who meets in a tile. Kind -1 lives there, 0 has the same length, 1 a letter more."""
    cells = F.array(*block_of(F.col("word")))
    placed = words.select("word", "n", cells.alias("block"))
    sizes = placed.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    spot = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    home = placed.join(sizes, "block").withColumn("tile", spot)
    living = home.select("block", "tile", F.lit(-1).alias("kind"), "word", "n")
    beside = home.filter(F.col("tile") > 0).select("block", F.explode(F.sequence(F.lit(0), F.col("tile") - 1)).alias("tile"), F.lit(0).alias("kind"), "word", "n")
    calls = placed.select("word", "n", F.explode(visited([F.col("block")[g] for g in range(GROUPS)])).alias("v")).select("v.block", "v.kind", "word", "n")
    calling = calls.join(sizes, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "kind", "word", "n")
    return living.unionByName(beside).unionByName(calling)


class Words:
    """Words of one length as letters, counts of letters, and occurrences ``n``."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.n = n
        self.text = np.array([w.encode("latin-1") for w in words])
        self.letters = np.frombuffer(b"".join(w.encode("latin-1") for w in words), np.uint8).reshape(len(words), -1)
        length = self.letters.shape[1]
        spot = np.arange(len(words))[:, None] * WIDTH + _COLUMN[self.letters]
        # squares of counts must be exact
        kind = np.float32 if length < 2000 else np.float64
        self.counts = np.bincount(spot.ravel(), minlength=len(words) * WIDTH).reshape(-1, WIDTH).astype(kind)
        self.half = (self.counts**2).sum(1, keepdims=True) / -2

    def left(self) -> np.ndarray:
        return np.hstack([self.counts, self.half, np.ones_like(self.half)])

    def right(self) -> np.ndarray:
        return np.hstack([self.counts, np.ones_like(self.half), self.half])

    def part(self, first: int, last: int) -> Words:
        out = object.__new__(Words)
        out.n, out.text, out.letters = self.n[first:last], self.text[first:last], self.letters[first:last]
        out.counts, out.half = self.counts[first:last], self.half[first:last]
        return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` is one edit from that of ``b``, which is as long or one letter longer."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(1) == 1
    before = np.cumprod(a == b[:, :size], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    after = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    return before + after >= size


def near(a: Words, b: Words) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``a`` and ``b`` that are one edit apart."""
    # minus half of the squared distance
    i, j = np.nonzero(a.left() @ b.right().T >= -1)
    step = max(1, PIECE // a.letters.shape[1])
    good = [one_edit(a.letters[i[k : k + step]], b.letters[j[k : k + step]]) for k in range(0, len(i), step)]
    good = np.concatenate([np.zeros(0, bool), *good])
    return i[good], j[good]


def _best(own: Words, i: np.ndarray, other: Words, j: np.ndarray) -> list[tuple[bytes, int, int, bytes]]:
    """(word, near words, largest count among them, smallest word with it) of the words ``i``."""
    order = np.lexsort((other.text[j], -other.n[j], i))
    at, first, count = np.unique(i[order], return_index=True, return_counts=True)
    best = j[order][first]
    return list(zip(own.text[at].tolist(), count.tolist(), other.n[best].tolist(), other.text[best].tolist(), strict=True))


def _step(living: Words) -> int:
    return max(64, PIECE // len(living.n))


def _within(living: Words) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
    """Near words of a tile among themselves."""
    for k in range(0, len(living.n), _step(living)):
        i, j = near(living, living.part(k, k + _step(living)))
        if len(i):  # a pair comes from either side
            yield _best(living, i, living, j + k)


def _visits(living: Words, calling: Words) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
    """Near words between a tile and those who visit it, for both."""
    for k in range(0, len(calling.n), _step(living)):
        piece = calling.part(k, k + _step(living))
        i, j = near(living, piece)
        if len(i):
            yield _best(living, i, piece, j)
            yield _best(piece, j, living, i)


NEAR = "word string, n_near long, form_n long, form string"


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, form_n, form) of every word with a near word: their number, and the best of them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, living, made = None, None, []

        def sent() -> pa.RecordBatch:
            columns = zip(*made, strict=True)
            text = lambda xs: pa.array([x.decode("latin-1") for x in xs], pa.string())
            word, count, n, form = columns
            return pa.RecordBatch.from_arrays([text(word), pa.array(count, pa.int64()), pa.array(n, pa.int64()), text(form)], names=["word", "n_near", "form_n", "form"])

        for place, kind, group in _runs(batches):
            if kind == -1:
                current, living = place, group
                found = _within(living)
            elif place == current:
                found = _visits(living, group)
            else:
                continue  # the block has no words of its own
            for part in found:
                made.extend(part)
                if len(made) > 20_000:
                    yield sent()
                    made = []
        if made:
            yield sent()

    met = meetings(words, tile).withColumn("place", F.concat_ws(",", "block", F.col("tile").cast("string")))
    dealt = met.select("place", "kind", "word", "n").repartition("place").sortWithinPartitions("place", "kind")
    parts = dealt.mapInArrow(compare, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.less")).alias("form_n"), "b.form")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Words]]:
    """(place, kind, words) in order: those who live there in one piece, visitors in pieces of a batch."""
    held: list[tuple[list[str], np.ndarray]] = []
    open_at: tuple[str, int] | None = None

    def closed() -> Words:
        return Words([w for ws, _ in held for w in ws], np.concatenate([n for _, n in held]))

    for batch in batches:
        place, kind = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
        if not len(place):
            continue
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (kind[1:] != kind[:-1])
        starts = [*np.flatnonzero(new).tolist(), len(place)]
        for first, last in zip(starts, starts[1:], strict=False):
            at = (place[first], int(kind[first]))
            if at != open_at and held:
                yield *open_at, closed()
                held = []
            open_at = at
            held.append((batch.column(2).slice(first, last - first).to_pylist(), batch.column(3).slice(first, last - first).to_numpy()))
            if at[1] != -1 and sum(len(ws) for ws, _ in held) >= TILE:
                yield *open_at, closed()
                held = []
    if held:
        yield *open_at, closed()


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, n, form, ...) with ``root``: the last word that forms lead to."""
    root = forms.select("word", F.coalesce("form", "word").alias("root"))
    for _ in range(5):  # 32 steps; counts of 64 bits allow 19
        root = staged(root, fresh_dir(forms.sparkSession, "spelling-roots"))
        further = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        root = root.join(further, "root").select("word", F.col("next").alias("root"))
    return forms.join(root, "word")


def variants(docs: DataFrame, edit: Edit = lambda key, run: run, key: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words."""
    spark = docs.sparkSession
    words = staged(word_counts(docs, edit, key, text), fresh_dir(spark, "spelling-words"))
    judged = words.join(near_words(words, tile), "word", "left")
    strong = F.col("form_n") >= RATIO * F.col("n")
    forms = judged.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("form")).alias("form"),
        F.when(strong, F.col("form_n")).alias("form_n"),
    )
    forms = staged(forms, fresh_dir(spark, "spelling-forms"))
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
