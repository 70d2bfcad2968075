"""Scores of texts under a subword lattice and a word model gathered from the corpus.

Every word (between white space) is a lattice of vocabulary pieces. The piece scores of an existing
vocabulary weight all segmentations, and a forward recursion in log space sums them up to the
marginal probability of the word. One more arc leads through the whole lattice: the word itself as
the training texts have it. With ``c`` of ``N`` training tokens and ``V`` distinct ones a word has
probability ``(c + V * lattice) / (N + V)``: common words by their counts, new ones by their pieces.
A text is the product over its words and one end token.

Vocabulary files at hand hold merge ranks as scores; piece number ``r`` of that order is given the
weight ``1 / (r + 1)``, normalised over all pieces. Single bytes come last, so every word has a path.

Word counts and lattice values are tables, one row per distinct word of the corpus. The ``hot_words``
most frequent words are sent to all tasks (a fixed bound, some megabytes); the rest of a text's
words are looked up by a shuffle join, whose keys are rare by construction.

Defined cases: a null or empty text is the end token alone. Without training rows N and V are 0, the
base is 0 for every token and the score is the lattice's own. Repeated rows count as often as they
occur. Rows with a null key train if ``may_learn`` says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.llm.arrays import LOWER, SPACE, Prefixes, slices, text_buffer, words
from weirstone.session import fresh_dir

HOT_WORDS = 300_000
COUNT_BYTES = 2 << 20  # words are counted over slices of this size before the first shuffle
BEGIN = "▁".encode()
LN10 = np.log(10.0)


class Pieces:
    """Natural-log weight of every piece, found by the hash of its bytes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(len(model)) if not model.is_control(i) and not model.is_unknown(i)]
        ids.sort(key=lambda i: (model.is_byte(i), -model.get_score(i), i))
        order = np.log(1.0 / (np.arange(len(ids) + 1) + 1.0))
        order -= np.logaddexp.reduce(order)
        self.end = float(order[len(ids)])
        content = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).encode() for i in ids]
        weights: dict[bytes, float] = {}
        for piece, weight in zip(content, order[:-1].tolist(), strict=True):
            weights[piece] = float(np.logaddexp(weights[piece], weight)) if piece in weights else weight
        self.weights = weights
        self.lengths = sorted({len(p) for p in weights})
        sizes = np.array([len(p) for p in weights])
        stops = np.cumsum(sizes)
        hashed = Prefixes(np.frombuffer(b"".join(weights), np.uint8)).windows(stops - sizes, stops)
        by_hash = np.argsort(hashed)
        self.hashes, self.values = hashed[by_hash], np.array(list(weights.values()))[by_hash]
        self.present = np.zeros(1 << 20, bool)
        self.present[self.hashes & np.uint64((1 << 20) - 1)] = True

    def marginals(self, listed: list[bytes]) -> np.ndarray:
        """log10 of the summed probability of all segmentations of each word."""
        sizes = np.array([len(w) + len(BEGIN) for w in listed], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        hashes = Prefixes(np.frombuffer(b"".join(BEGIN + w for w in listed), np.uint8))
        word = np.repeat(np.arange(len(listed)), sizes)
        place = np.arange(offsets[-1])
        ends, starts, weights = [], [], []
        for length in self.lengths:
            begin = place[place + length <= offsets[1:][word]]
            found = hashes.windows(begin, begin + length)
            maybe = self.present[found & np.uint64((1 << 20) - 1)]
            begin, found = begin[maybe], found[maybe]
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            hit = self.hashes[at] == found
            starts.append(begin[hit])
            ends.append(begin[hit] + length)
            weights.append(self.values[at[hit]])
        start, end, weight = np.concatenate(starts), np.concatenate(ends), np.concatenate(weights)
        # a node for each place between bytes; words lie behind one another with a node more each
        owner = word[start]
        step = end - offsets[owner]
        forward = np.full(offsets[-1] + len(listed), -np.inf)
        forward[offsets[:-1] + np.arange(len(listed))] = 0.0
        order = np.argsort(step, kind="stable")
        start, end, weight, step = start[order] + owner[order], end[order] + owner[order], weight[order], step[order]
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(step)) + 1, [len(step)]])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            np.logaddexp.at(forward, end[a:b], forward[start[a:b]] + weight[a:b])
        return forward[offsets[1:] + np.arange(len(listed))] / LN10


@cache
def load_pieces(path: str) -> Pieces:
    return Pieces(path)


def _words(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, stops, first = words(data, offsets, SPACE)
    return data.tobytes(), starts, stops, first, Prefixes(data).windows(starts, stops)


def word_counts(docs: DataFrame, may_learn: Column, text: str = "text") -> DataFrame:
    """Every distinct word and its number in training texts; the end token is the null word."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for first_row, last_row in slices(batch.column(0), COUNT_BYTES):
                raw, starts, stops, first, hashed = _words(batch.column(0).slice(first_row, last_row - first_row))
                learns = train[first_row:last_row].astype(np.int64)
                _, one, place = np.unique(hashed, return_index=True, return_inverse=True)
                counted = np.bincount(place, weights=np.repeat(learns, np.diff(first)), minlength=len(one)).astype(np.int64)
                found = [raw[a:b] for a, b in zip(starts[one].tolist(), stops[one].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([*found, None], pa.binary()), pa.array([*counted.tolist(), int(learns.sum())], pa.int64())], names=schema.names)

    return docs.select(F.col(text), F.coalesce(may_learn, F.lit(False)).alias("t")).mapInArrow(count, schema).groupBy("word").agg(F.sum("c").alias("c"))


def with_lattice(counts: DataFrame, pieces_path: str) -> DataFrame:
    """Hash, count and log10 lattice probability of every word."""
    schema = T.StructType([T.StructField("hash", T.LongType()), T.StructField("c", T.LongType()), T.StructField("lattice", T.DoubleType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(pieces_path)
        for batch in batches:
            column, c = batch.column(0), batch.column(1)
            listed = column.to_pylist()
            sizes = np.cumsum([len(w) for w in listed])
            first = 0
            while first < len(listed):
                last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + (1 << 17), side="right")))
                part = listed[first:last]
                data = np.frombuffer(b"".join(part), np.uint8)
                stops = np.cumsum([len(w) for w in part])
                hashed = Prefixes(data).windows(np.concatenate([[0], stops[:-1]]), stops)
                yield pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64)), c.slice(first, last - first), pa.array(pieces.marginals(part))], names=schema.names)
                first = last

    return counts.where(F.col("word").isNotNull()).select("word", "c").mapInArrow(weigh, schema)


def _log10(x: float) -> float:
    return float(np.log10(x)) if x else -np.inf


def score(docs: DataFrame, may_learn: Column, pieces_path: str, key: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per text: key, ``extra`` columns, n_tokens, n_known, train_tokens, base_score, score
    and lattice_score (log10 probability under the pieces alone)."""
    spark = docs.sparkSession
    counts_path, words_path, texts_path = (fresh_dir(spark, f"lm-{n}") for n in ("counts", "words", "texts"))
    word_counts(docs, may_learn, text).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    total, distinct, c_end = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum(F.when(F.col("word").isNull(), F.col("c")))).first()
    total, distinct, c_end = total or 0, distinct or 0, c_end or 0
    with_lattice(counts, pieces_path).write.parquet(words_path)
    vocabulary = spark.read.parquet(words_path)
    spread = float(distinct or 1)

    def base_of(c: Column) -> Column:
        return F.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))

    def mixed_of(c: Column, lattice: Column) -> Column:
        novel = F.log10(F.lit(spread)) + lattice
        seen = F.log10(c.cast("double"))  # null for a count of 0
        most = F.greatest(novel, seen)
        both = most + F.log10(F.pow(F.lit(10.0), novel - most) + F.pow(F.lit(10.0), seen - most))
        return F.coalesce(both, novel) - F.log10(F.lit(total + spread))

    values = vocabulary.select("hash", "c", (F.col("c") > 0).cast("long").alias("known"), base_of(F.col("c")).alias("base"), mixed_of(F.col("c"), F.col("lattice")).alias("mixed"), "lattice")
    top = values.orderBy(F.col("c").desc(), "hash").limit(hot_words).drop("c").toArrow()
    order = np.argsort(top["hash"].to_numpy())
    hot = spark.sparkContext.broadcast([top[n].to_numpy()[order] for n in ("hash", "known", "base", "mixed", "lattice")])

    extra = extra or {}
    chosen = docs.select(F.col(text).alias("t"), F.col(key).alias("k"), *(v.alias(f"x{i}") for i, v in enumerate(extra.values())))
    number, real = T.LongType(), T.DoubleType()
    schema = T.StructType(
        [*chosen.schema.fields[1:], T.StructField("rid", number), T.StructField("n_tokens", number), T.StructField("n_known", number)]
        + [T.StructField(n, real) for n in ("base", "mixed", "lattice")]
        + [T.StructField("tail", T.ArrayType(number)), T.StructField("times", T.ArrayType(number))]
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes, *columns = hot.value
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first_row, last_row in slices(batch.column(0)):
                n = last_row - first_row
                _, _, _, first, hashed = _words(batch.column(0).slice(first_row, n))
                hashed, sizes = hashed.view(np.int64), np.diff(first)
                row = np.repeat(np.arange(n), sizes)
                at = np.minimum(np.searchsorted(hashes, hashed), max(len(hashes) - 1, 0))
                hit = hashes[at] == hashed if len(hashes) else np.zeros(len(hashed), bool)
                sums = [np.bincount(row[hit], weights=c[at[hit]], minlength=n) for c in columns]
                rest_row, rest = row[~hit], hashed[~hit]
                order = np.lexsort((rest, rest_row))
                rest_row, rest = rest_row[order], rest[order]
                new = np.ones(len(rest), bool)
                new[1:] = (rest[1:] != rest[:-1]) | (rest_row[1:] != rest_row[:-1])
                begin = np.flatnonzero(new)
                times = np.diff(np.concatenate([begin, [len(rest)]]))
                edges = pa.array(np.searchsorted(rest_row[begin], np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(first_row, n) for i in range(1, batch.num_columns)), pa.array(rid + np.arange(n)), pa.array(sizes + 1), pa.array(sums[0].astype(np.int64))]
                    + [pa.array(s, pa.float64()) for s in sums[1:]]
                    + [pa.ListArray.from_arrays(edges, pa.array(v.astype(np.int64))) for v in (rest[begin], times)],
                    names=schema.names,
                )
                rid += n

    chosen.mapInArrow(look_up, schema).write.parquet(texts_path)
    texts = spark.read.parquet(texts_path)
    tail = texts.select("rid", F.explode(F.arrays_zip("tail", "times")).alias("w")).select("rid", F.col("w.tail").alias("hash"), F.col("w.times").alias("times"))
    rest = tail.join(values, "hash").groupBy("rid").agg(*(F.sum(F.col("times") * F.col(n)).alias(f"{n}_rest") for n in ("known", "base", "mixed", "lattice")))
    end_base = float(np.log10((c_end + 0.1) / (total + 0.1 * (distinct + 1))))
    end_lattice = load_pieces(pieces_path).end / LN10
    end_mixed = float(np.logaddexp(_log10(c_end) * LN10, np.log(spread) + end_lattice * LN10) / LN10 - np.log10(total + spread))
    full = texts.join(rest, "rid", "left")

    def whole(name: str, end: float) -> Column:
        return F.col(name) + F.coalesce(f"{name}_rest", F.lit(0.0)) + F.lit(end)

    return full.select(
        F.col("k").alias(key),
        *(F.col(f"x{i}").alias(name) for i, name in enumerate(extra)),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_rest", F.lit(0)) + F.lit(int(c_end > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        whole("base", end_base).alias("base_score"),
        whole("mixed", end_mixed).alias("score"),
        whole("lattice", end_lattice).alias("lattice_score"),
    )
