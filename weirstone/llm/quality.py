"""Quality and toxicity by hierarchical empirical Bayes over documents, hosts and paths.

A document's own evidence is the log-odds of a linear classifier over the presence of hashed words
and of coarse shape marks (shares of capitals, marks and symbols). Features whose presence differs clearly between the classes are
found by counts over all labelled rows, ``FEATURES`` of them at most; a penalised logistic regression
over these alone is fitted on a sample of at most ``SAMPLE`` labelled rows, kept sparse.

Sites add what single documents cannot show. Labels where there are any, else the classifier's
probabilities, are added up per path and per host. The spread of the rates between groups, beyond
what their sizes explain, gives the strength of the priors: a host's rate is drawn towards the
global one, a path's rate towards its host's, the more so the fewer documents it has. The posterior
log-odds of the path against the global rate are added to the document's evidence.

Defined cases: null and empty texts have no feature and are judged by their site and the global
rate. A null host or path is a group of its own. Unlabelled corpora (or labels of one class only)
give the global rate to all. Repeated label rows count each time in the fit, their mean counts in
the groups; repeated documents are judged alike, and those with the same text are one in the fit. A
null label says nothing about its head and leaves the others as they are. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.llm.arrays import LOWER, NOT_WORD, Prefixes, slices, text_buffer, words
from weirstone.session import fresh_dir

SAMPLE = 16_000
BUCKETS = 1 << 18
MARKS = 8  # bins of each shape mark
CLEAR = 4.5  # standard errors between the classes that make a feature count
FEATURES = 2_000

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!?|"]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^_~<>=+\\/{}[]"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each row, and where each row's begin (n + 1 entries)."""
    raw, offsets = text_buffer(column)
    data = LOWER[raw]
    starts, stops, first = words(data, offsets, NOT_WORD)
    n = len(column)
    row = np.repeat(np.arange(n), np.diff(first))
    bucket = (Prefixes(data).windows(starts, stops) % np.uint64(BUCKETS)).astype(np.int64)
    byte_row = np.repeat(np.arange(n), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)
    letters = np.maximum(np.bincount(byte_row, weights=_LETTER[raw], minlength=n), 1)
    shapes = []
    for k, (kind, of) in enumerate(((_UPPER, letters), (_MARK, size), (_SYMBOL, size), (_DIGIT, size))):
        share = np.bincount(byte_row, weights=kind[raw], minlength=n) / of
        bin_ = np.minimum((np.sqrt(share) * MARKS).astype(np.int64), MARKS - 1)
        shapes.append(BUCKETS + k * MARKS + bin_)
    full = np.flatnonzero(np.diff(offsets))
    key = np.unique(np.concatenate([row * (2 * BUCKETS) + bucket, *(full * (2 * BUCKETS) + s[full] for s in shapes)]))
    row, number = np.divmod(key, 2 * BUCKETS)
    return number, np.searchsorted(row, np.arange(n + 1))


def _feature_lists(texts: pa.Array) -> pa.Array:
    chunks = []
    for first, last in slices(texts):
        number, begin = features(texts.slice(first, last - first))
        chunks.append(pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(number.astype(np.int32))))
    return pa.concat_arrays(chunks) if chunks else pa.array([], pa.list_(pa.int32()))


feature_numbers = F.arrow_udf(T.ArrayType(T.IntegerType()))(_feature_lists)

KEY_BITS = 1 << 27  # of the filter of labelled keys: 16 MB, whatever the number of labels


def labelled_keys(labels: DataFrame, key: str) -> np.ndarray:
    """A bit for the hash of every labelled key. The filter has a fixed size; where it fills up, it keeps more."""
    spot = F.pmod(F.xxhash64(key), F.lit(KEY_BITS)) + 1
    marked = labels.where(F.col(key).isNotNull()).select(F.bitmap_bucket_number(spot).alias("b"), F.bitmap_bit_position(spot).alias("p"))
    bits = np.zeros((KEY_BITS // 32_768, 4096), np.uint8)
    for row in marked.groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).toLocalIterator():
        bits[row.b - 1] = np.frombuffer(row.bits, np.uint8)
    return bits.ravel()


def features_of_labelled(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """(label_key, f) of the documents whose key may be labelled; of all others nothing is made or sent."""
    shared = docs.sparkSession.sparkContext.broadcast(labelled_keys(labels, key))

    @F.arrow_udf("boolean")
    def may_be(hashes: pa.Array) -> pa.Array:
        spot = np.mod(hashes.to_numpy(), KEY_BITS)
        return pa.array((shared.value[spot >> 3] >> (spot & 7) & 1).astype(bool))

    known = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("label_key"), F.col(text).alias("t"))
    return known.where(may_be(F.xxhash64("label_key"))).select("label_key", feature_numbers("t").alias("f"))


@dataclass(frozen=True)
class Head:
    """Weights by feature number, most of them 0; the bias; the rate in the sample."""

    weights: np.ndarray
    bias: float
    rate: float


def clear_features(seen: np.ndarray, here: np.ndarray, n: float, positive: float) -> np.ndarray:
    """Features that differ clearly between the classes, the clearest first, from the number of rows
    and of positive rows, in all and with each feature."""
    if positive in (0.0, float(n)):
        return np.zeros(0, np.int64)
    pooled = (seen + 1) / (n + 2)
    gap = here / positive - (seen - here) / (n - positive)
    clear = np.abs(gap) / np.sqrt(pooled * (1 - pooled) * (1 / positive + 1 / (n - positive)))
    clear[seen < 5] = 0
    chosen = np.argsort(-clear, kind="stable")[:FEATURES]
    return chosen[clear[chosen] > CLEAR]


def _solve(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Conjugate gradients for a positive definite matrix that is given by its products."""
    x, residual = np.zeros_like(right), right.copy()
    scaled = residual / diagonal
    along, size = scaled.copy(), float(residual @ scaled)
    enough = 1e-8 * size
    for _ in range(4 * len(right)):
        if size <= enough or size == 0.0:
            break
        product = times(along)
        length = size / float(along @ product)
        x += length * along
        residual -= length * product
        scaled = residual / diagonal
        size, last = float(residual @ scaled), size
        along = scaled + size / last * along
    return x


def fit(rows: list[np.ndarray], target: np.ndarray, chosen: np.ndarray, penalty: float = 2.0) -> Head:
    """Fit the weights of the chosen features by Newton steps; nothing dense is made of the rows."""
    known = np.flatnonzero(~np.isnan(target))
    if len(known) < len(rows):
        rows, target = [rows[k] for k in known], target[known]
    n, total = len(rows), BUCKETS + 4 * MARKS
    weights = np.zeros(total, np.float32)
    positive = float(target.sum())
    rate = (positive + 0.5) / (n + 1)
    if n == 0 or positive in (0.0, float(n)):
        return Head(weights, float(np.log(rate / (1 - rate))) if n else 0.0, rate if n else 0.5)
    place = np.full(total, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    spots = [place[r] for r in rows]
    spots = [x[x >= 0] for x in spots]
    column = np.concatenate([*spots, np.full(n, len(chosen), np.int32)])  # the bias is in every row
    owner = np.concatenate([np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in spots]), np.arange(n, dtype=np.int32)])
    ridge = np.full(len(chosen) + 1, penalty)
    ridge[-1] = 1e-6
    beta = np.zeros(len(chosen) + 1)
    beta[-1] = np.log(rate / (1 - rate))

    def by_row(v: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=v[column], minlength=n)

    def by_feature(v: np.ndarray) -> np.ndarray:
        return np.bincount(column, weights=v[owner], minlength=len(ridge))

    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(by_row(beta), -30, 30)))
        gradient = by_feature(p - target) + ridge * beta
        curve = np.maximum(p * (1 - p), 1e-6)
        step = _solve(lambda v: by_feature(curve * by_row(v)) + ridge * v, gradient, by_feature(curve) + ridge)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    weights[chosen] = beta[:-1]
    return Head(weights, float(beta[-1]), rate)


def counted(docs: DataFrame, labels: DataFrame, heads: tuple[str, ...], key: str, text: str) -> dict[str, np.ndarray]:
    """The clear features of each head, by counts over all labelled rows."""
    marked = labels.where(F.col(key).isNotNull()).select(F.col(key).alias("label_key"), *(F.col(h).cast("double").alias(f"is_{i}") for i, h in enumerate(heads)))
    known = features_of_labelled(docs, labels, key, text).join(marked, "label_key")
    # a row without a label of a head counts for the other heads only
    sums = [total for i in range(len(heads)) for total in (F.count(f"is_{i}").alias(f"n{i}"), F.coalesce(F.sum(f"is_{i}"), F.lit(0.0)).alias(f"s{i}"))]
    # one feature that every row has (-1) counts the rows themselves
    each = known.select(F.explode(F.concat(F.array(F.lit(-1)), F.col("f"))).alias("number"), *(f"is_{i}" for i in range(len(heads))))
    table = each.groupBy("number").agg(*sums).toArrow()  # a row per feature at most
    number = table["number"].to_numpy()
    total = BUCKETS + 4 * MARKS
    every = np.flatnonzero(number == -1)
    if not len(every):
        return {h: np.zeros(0, np.int64) for h in heads}
    columns = {}
    for name in (f"{kind}{i}" for kind in "ns" for i in range(len(heads))):
        columns[name] = np.zeros(total)
        columns[name][number[number >= 0]] = table[name].to_numpy()[number >= 0]
    rows = {name: float(table[name][int(every[0])].as_py()) for name in columns}
    return {h: clear_features(columns[f"n{i}"], columns[f"s{i}"], rows[f"n{i}"], rows[f"s{i}"]) for i, h in enumerate(heads)}


def labelled_rows(docs: DataFrame, labels: DataFrame, heads: tuple[str, ...], key: str, text: str, sample: int) -> tuple[list[np.ndarray], dict[str, np.ndarray]]:
    """Features of at most ``sample`` labelled documents, in hash order of the key; NaN where a head has no label.

    Documents with the same key and text are one.
    """
    some = labels.where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key, *heads).limit(sample).select(F.col(key).alias("label_key"), *(F.col(h).cast("double").alias(f"is_{i}") for i, h in enumerate(heads)))
    keys = some.select("label_key").distinct()
    known = docs.select(F.col(key).alias("label_key"), F.col(text).alias("t")).join(F.broadcast(keys), "label_key", "left_semi")
    once = known.select("label_key", F.xxhash64("t").alias("th"), feature_numbers("t").alias("f")).dropDuplicates(["label_key", "th"])
    marks = [f"is_{i}" for i in range(len(heads))]
    table = once.join(F.broadcast(some), "label_key").orderBy(F.xxhash64("label_key"), "label_key", "th", *marks).limit(sample).select("f", *marks).toArrow()
    lists = table["f"].combine_chunks()
    flat, begin = lists.flatten().to_numpy(), lists.offsets.to_numpy() if len(lists) else np.zeros(1, int)
    rows = [flat[a:b] for a, b in zip(begin[:-1] - begin[0], begin[1:] - begin[0], strict=True)]
    return rows, {h: table[f"is_{i}"].to_numpy().astype(float) for i, h in enumerate(heads)}


def evidence(heads: list[Head], spark) -> Callable[[Column], Column]:
    """Column function: text to the log-odds of each head."""
    shared = spark.sparkContext.broadcast(heads)  # one number per feature

    @F.arrow_udf("array<double>")
    def judge(texts: pa.Array) -> pa.Array:
        found = []
        for first, last in slices(texts):
            number, begin = features(texts.slice(first, last - first))
            row = np.repeat(np.arange(last - first), np.diff(begin))
            found.append(np.stack([np.bincount(row, weights=h.weights[number], minlength=last - first) + h.bias for h in shared.value], axis=1))
        flat = np.concatenate(found).ravel() if found else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(shared.value)), pa.array(flat))

    return judge


def strength(groups: DataFrame, n: str, s: str) -> tuple[float, float]:
    """Global rate and prior strength from counts and sums of groups, by the method of moments."""
    total, summed, squares, k = groups.agg(F.sum(n), F.sum(s), F.sum(F.col(n) * F.col(n)), F.count("*")).first()
    if not total:
        return 0.5, 1.0
    rate = min(max(summed / total, 1e-4), 1 - 1e-4)
    between = groups.agg(F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - rate, 2))).first()[0]
    room = total - squares / total - (k - 1)
    share = (between / (rate * (1 - rate)) - (k - 1)) / room if room > 0 else 0.0
    share = min(max(share, 1e-4), 0.5)  # how much of the spread lies between groups
    return rate, (1 - share) / share


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, heads: tuple[str, ...], host: Column, path: Column, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, learn_from: Column | None = None) -> DataFrame:
    """One row per document: key and, for each head, ``<head>_score``, ``<head>_evidence`` (own
    log-odds) and ``<head>_site`` (posterior rate of its path)."""
    spark = docs.sparkSession
    usable = labels if learn_from is None else labels.where(learn_from)
    rows, targets = labelled_rows(docs, usable, heads, key, text, sample)
    clear = counted(docs, usable, heads, key, text)
    fitted = [fit(rows, targets[h], clear[h]) for h in heads]
    at = fresh_dir(spark, "evidence")
    docs.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"), evidence(fitted, spark)(F.col(text)).alias("e")).write.parquet(at)
    judged = spark.read.parquet(at)
    known = usable.groupBy(F.col(key).alias("k")).agg(*(F.avg(h).alias(f"y{i}") for i, h in enumerate(heads)))
    sums = [F.sum(F.coalesce(f"y{i}", 1 / (1 + F.exp(-F.col("e")[i])))).alias(f"s{i}") for i in range(len(heads))]
    paths_at = fresh_dir(spark, "paths")
    judged.join(known, "k", "left").groupBy("host", "path").agg(F.count("*").alias("n"), *sums).write.parquet(paths_at)
    paths = spark.read.parquet(paths_at)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *(F.sum(f"s{i}").alias(f"host_s{i}") for i in range(len(heads))))
    sites, rates = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))), []
    posterior = []
    for i in range(len(heads)):
        rate, host_prior = strength(hosts, "host_n", f"host_s{i}")
        _, path_prior = strength(paths, "n", f"s{i}")
        host_rate = (F.col(f"host_s{i}") + host_prior * rate) / (F.col("host_n") + host_prior)
        posterior.append(((F.col(f"s{i}") + path_prior * host_rate) / (F.col("n") + path_prior)).alias(f"site{i}"))
        rates.append(rate)
    sites = sites.select(F.col("p.host").alias("site_host"), F.col("p.path").alias("site_path"), *posterior)
    full = judged.join(sites, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")))
    columns = []
    for i, h in enumerate(heads):
        odds = F.col("e")[i] + _odds(F.col(f"site{i}")) - _odds(F.lit(rates[i]))
        columns += [(1 / (1 + F.exp(-odds))).alias(f"{h}_score"), F.col("e")[i].alias(f"{h}_evidence"), F.col(f"site{i}").alias(f"{h}_site")]
    return full.select(F.col("k").alias(key), *columns)
