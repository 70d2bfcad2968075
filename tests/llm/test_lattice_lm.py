"""The base against a plain count, the lattice against all segmentations written out."""

import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from weirstone.llm import lattice_lm

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " \t\n", "The the a", "zz qq zz", "déjà vu\x0bThe", "a" * 3000, "the a the", "the a the", "\U0001f600x"]


def brute_lattice(word: bytes, weights) -> float:
    total = [0.0] * (len(word) + 1)
    total[0] = 1.0
    for end in range(1, len(word) + 1):
        for begin in range(end):
            if word[begin:end] in weights:
                total[end] += total[begin] * math.exp(weights[word[begin:end]])
    return math.log10(total[-1])


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_scores(spark, hot):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "the null key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit(1)).repartition(3)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    got = lattice_lm.score(docs, ~held, PIECES, extra={"held_out": held}, hot_words=hot).collect()
    assert len(got) == len(rows)
    out = [i for i, _ in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 10 == 0]
    table = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    split = [(i, [w for w in (t or "").translate(table).replace("\x0b", " ").split() if w]) for i, t in rows]
    c = Counter(w for i, ws in split if i not in out for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    weights = lattice_lm.load_pieces(PIECES).weights
    for r in got:
        ws = dict((k, x) for k, x in split)[r.doc_id]
        assert r.n_tokens == len(ws) + 1 and r.train_tokens == n and r.held_out == (r.doc_id in out)
        assert r.n_known == sum(c[w] > 0 for w in [*ws, None])
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*ws, None])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if r.doc_id != 6:
            lattice = [brute_lattice("▁".encode() + w.encode(), weights) for w in ws] + [lattice_lm.load_pieces(PIECES).end / lattice_lm.LN10]
            assert math.isclose(r.lattice_score, sum(lattice), rel_tol=1e-9)
            mixed = sum(math.log10((c[w] + v * 10**x) / (n + v)) for w, x in zip([*ws, None], lattice, strict=True))
            assert math.isclose(r.score, mixed, rel_tol=1e-9)
        assert math.isfinite(r.score) and math.isfinite(r.lattice_score)


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (row,) = lattice_lm.score(docs, F.lit(False), PIECES).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0 and math.isclose(row.score, row.lattice_score)
    assert lattice_lm.score(docs.limit(0), F.lit(True), PIECES).count() == 0
