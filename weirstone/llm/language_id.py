"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (1 to 4 bytes, lower case, a blank
for every run of other ASCII), put through a linear softmax. Embeddings and softmax are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled rows; part of that
sample is kept back to fit a temperature and the rejection limits. Embedding and softmax are
linear, so their product is one small table of scores per hashed n-gram, and that is all that a
prediction needs.

A text is rejected if its best probability is lower, or the share of its n-grams that no training
text has is higher, than the held-back texts show at that length. For this they are cut at words
into pieces of all lengths from four bytes on; each class of lengths (a power of two of n-grams) gets
the quantile of its pieces, with ``margin`` since a quantile of few pieces is close to the most
extreme of them.

Defined cases: a null text or one without a letter is ``und``, score 0, rejected. Without a single
usable labelled row nothing is learned and every text is ``und``. A class of lengths with fewer than
``least_pieces`` pieces has the limits of the next shorter one; with none shorter, as with fewer than
eight labelled rows, there is no evidence to reject on and texts with a letter are kept. Ties go to the language that
sorts first. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from weirstone.llm.arrays import LOWER, release, slices, text_buffer

UNKNOWN = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

KNOWN = 1 << 22  # n-grams are told apart by so many hashes where it counts whether they were seen
CLASSES = 24  # powers of two of the number of n-grams

_FOLD = LOWER.copy()
_FOLD[:128][[not chr(i).isalpha() for i in range(128)]] = 32


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` labelled rows at most, spread evenly over the languages and at most
    ``rows_each`` of one, of each row at most ``sample_chars`` characters: the stated bound of what
    is fitted on. Up to 1000 of a language, Spark limits the ranking before the shuffle."""

    sample_rows: int = 4000
    rows_each: int = 1000
    sample_chars: int = 1000
    buckets: int = 1 << 16
    dimensions: int = 16
    snippet_bytes: int = 200
    epochs: int = 4
    batch: int = 64
    rate: float = 0.5
    rejected_share: float = 0.0005
    margin: float = 1.5
    least_pieces: int = 200
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    seen: np.ndarray  # one bit for each of KNOWN hashes
    least: np.ndarray  # by class of length: lowest probability, highest share of unseen n-grams
    most: np.ndarray


def ngrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of one to four bytes, and the row of each; none crosses rows."""
    folded = _FOLD[data]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    blank = folded == 32
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])  # one blank for a run
    folded, row = folded[keep].astype(np.uint64), row[keep]
    found, rows = [], []
    value = np.zeros(len(folded), np.uint64)
    for n in range(1, 5):
        if len(folded) < n:
            break
        value = value[: len(folded) - n + 1] * np.uint64(257) + folded[n - 1 :] + np.uint64(1)
        same = row[: len(value)] == row[n - 1 :]
        spread = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        found.append((spread[same] % np.uint64(buckets)).astype(np.int32))
        rows.append(row[: len(value)][same])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(rows)


def mean_scores(table: np.ndarray, seen: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean table row of each text, the share of its n-grams that were not seen, and its class of length."""
    wide, row = ngrams(data, offsets, KNOWN)
    bucket = wide % len(table)
    n = len(offsets) - 1
    counts = np.maximum(np.bincount(row, minlength=n), 1)
    new = (seen[wide >> 3] >> (7 - (wide & 7)) & 1) == 0
    scores = np.stack([np.bincount(row, weights=table[bucket, k], minlength=n) / counts for k in range(table.shape[1])], axis=1)
    return scores, np.bincount(row[new], minlength=n) / counts, np.minimum(np.log2(counts).astype(np.int64), CLASSES - 1)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _offsets(raw: list[bytes]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _seen(pieces: list[bytes]) -> np.ndarray:
    """Bits of the n-grams of all pieces."""
    present = np.zeros(KNOWN, bool)
    for at in range(0, len(pieces), 1000):
        raw = pieces[at : at + 1000]
        present[ngrams(np.frombuffer(b"".join(raw), np.uint8), _offsets(raw), KNOWN)[0]] = True
    return np.packbits(present)


def _cut(text: str) -> set[str]:
    """The text and its pieces at words, of all lengths in powers of two from four bytes on."""
    pieces = {text}
    words, size = text.split(" "), 4
    while size < len(text):
        piece, held = [], 0
        for word in words:
            piece.append(word)
            held += len(word.encode()) + 1
            if held > size:
                pieces.add(" ".join(piece))
                piece, held = [], 0
        size *= 2
    return {p for p in pieces if any(map(str.isalpha, p))}


def _limits(texts: list[str], judge: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], floor: float, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """By class of length: the lowest probability and the highest share of unseen n-grams that are kept."""
    best, unseen, group = (np.concatenate(x) for x in zip(*(judge(sorted(_cut(t))) for t in texts), strict=True))
    least, most = np.zeros(CLASSES), np.ones(CLASSES)
    for c in range(CLASSES):
        here = group == c
        if here.sum() >= settings.least_pieces:
            low = float(np.quantile(best[here], settings.rejected_share))
            least[c] = floor + (low - floor) / settings.margin
            most[c] = float(np.quantile(unseen[here], 1 - settings.rejected_share)) * settings.margin
        elif c:
            least[c], most[c] = least[c - 1], most[c - 1]
    return least, most


def train(texts: list[str], labels: list[str], settings: Settings = Settings()) -> Model | None:
    """Fit on texts in memory; ``None`` without any text."""
    if not texts:
        return None
    languages = tuple(sorted(set(labels)))
    random = np.random.default_rng(settings.seed)
    order = random.permutation(len(texts))
    held = order[: len(texts) // 8]
    pieces, target = [], []
    for i in order[len(texts) // 8 :]:
        raw = texts[i].encode()
        for at in range(0, len(raw), settings.snippet_bytes):
            pieces.append(raw[at : at + settings.snippet_bytes])
            target.append(languages.index(labels[i]))
    target = np.array(target)
    embedding = random.normal(0, 0.1, (settings.buckets, settings.dimensions))
    weight = random.normal(0, 0.1, (settings.dimensions, len(languages)))
    bias = np.zeros(len(languages))
    steps, done = settings.epochs * -(-len(pieces) // settings.batch), 0
    for _ in range(settings.epochs):
        shuffled = random.permutation(len(pieces))
        for at in range(0, len(pieces), settings.batch):
            rate = settings.rate * (1 - done / steps)
            done += 1
            chosen = shuffled[at : at + settings.batch]
            raw = [pieces[i] for i in chosen]
            index, member = ngrams(np.frombuffer(b"".join(raw), np.uint8), _offsets(raw), KNOWN)
            index %= settings.buckets
            share = 1.0 / np.maximum(np.bincount(member, minlength=len(chosen)), 1)
            used, place = np.unique(index, return_inverse=True)
            flat = np.bincount(member * len(used) + place, minlength=len(chosen) * len(used)).reshape(len(chosen), -1) * share[:, None]
            hidden = flat @ embedding[used]
            error = softmax(hidden @ weight + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error /= len(chosen)
            back = flat.T @ (error @ weight.T)
            weight -= rate * 10 * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            embedding[used] -= rate * 100 * back
    table = embedding @ weight
    seen = _seen(pieces)
    if not len(held):
        return Model(languages, table, bias, 1.0, seen, np.zeros(CLASSES), np.ones(CLASSES))

    def measure(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = [t.encode() for t in some]
        scores, unseen, group = mean_scores(table, seen, np.frombuffer(b"".join(raw), np.uint8), _offsets(raw))
        return scores + bias, unseen, group

    def judge(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores, unseen, group = measure(some)
        return softmax(scores / temperature).max(axis=1), unseen, group

    logits = measure([texts[i] for i in held])[0]
    truth = np.array([languages.index(labels[i]) for i in held])
    temperature = min(
        (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0),
        key=lambda t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean(),
    )
    least, most = _limits([texts[i] for i in held], judge, 1 / len(languages), settings)
    return Model(languages, table, bias, temperature, seen, least, most)


def labelled_sample(docs: DataFrame, may_learn: Column, settings: Settings = Settings(), text: str = "text", lang: str = "lang", key: str = "doc_id") -> tuple[list[str], list[str]]:
    """The bounded sample: evenly over languages, in hash order of the key within each."""
    usable = docs.where(may_learn & F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}"))
    known = usable.select(lang).distinct().count()
    if not known:
        return [], []
    each = min(settings.rows_each, max(1, settings.sample_rows // known))
    ranked = usable.select(
        F.col(lang).alias("label"),
        F.substring(text, 1, settings.sample_chars).alias("part"),
        F.row_number().over(Window.partitionBy(lang).orderBy(F.xxhash64(key), key)).alias("place"),
    )
    rows = ranked.where(F.col("place") <= each).orderBy("label", "place").limit(settings.sample_rows).collect()
    return [r.part for r in rows], [r.label for r in rows]


def predictor(model: Model | None) -> Callable[[Column], Column]:
    """Column function: text to a struct of language, calibrated score and rejection."""

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        names, scores, rejected = [], [], []
        for first, last in slices(texts):
            data, offsets = text_buffer(texts.slice(first, last - first))
            scored, unseen, group = mean_scores(model.table, model.seen, data, offsets)
            probability = softmax((scored + model.bias) / model.temperature)
            best = probability.argmax(axis=1)
            score = probability[np.arange(len(best)), best]
            names.extend(model.languages[k] for k in best)
            scores.extend(score.tolist())
            rejected.extend(((score < model.least[group]) | (unseen > model.most[group])).tolist())
        release()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["lang_pred", "score", "rejected"])

    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if model is None:
        return lambda text: nothing
    return lambda text: F.when(F.coalesce(text.rlike("\\p{L}"), F.lit(False)), judge(text)).otherwise(nothing)


def identify(docs: DataFrame, may_learn: Column, settings: Settings = Settings(), text: str = "text", lang: str = "lang", key: str = "doc_id", into: str = "language") -> tuple[DataFrame, Model | None]:
    """``docs`` with the column ``into`` (struct of ``lang_pred``, ``score``, ``rejected``)."""
    model = train(*labelled_sample(docs, may_learn, settings, text, lang, key), settings)
    return docs.withColumn(into, predictor(model)(F.col(text))), model
