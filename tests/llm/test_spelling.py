"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirstone.llm import queries, spelling


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def apart(a, b):
    """Whether one edit makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = counted(rows)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def odd_rows():
    rng = random.Random(5)
    base = ["banana" * 2, "Straßenbahn", "ÀÉÎÕÜß×÷ø", "abcdefg", "aaaaaaa", "zzzzzzzzzz", "garçonnière"]

    def changed(word):
        at = rng.randrange(len(word))
        return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcéß") + word[at:], word[:at] + rng.choice("abcéß") + word[at + 1 :]])

    rows = [(i, " ".join(rng.choice(base) if rng.random() < 0.8 else changed(rng.choice(base)) for _ in range(60))) for i in range(120)]
    rows += [(1000, "chained " * 4000 + "chaine " * 3 + "chainedx " * 300 + "chainedxy " * 20 + "chainedxyz " * 2)]
    rows += [(2000, None), (2001, ""), (None, "nobody1nobodyknows nobodyknows"), (2002, "q" * 30_000 + " " + "q" * 30_000 + " " + ("q" * 29_999 + " ") * 2)]
    return [*rows, (5, "repeated repeated"), (5, "repeated repeated")]


@pytest.mark.parametrize("tile", [3, 2048])
def test_equals_brute_force(spark, tile):
    docs = spark.createDataFrame(odd_rows(), "doc_id long, text string").repartition(4)
    assert found(spelling.variants(docs, spelling.slipped, tile=tile)) == brute(odd_rows())


def test_query_on_a_table_equals_brute_force(spark):
    root = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    assert found(queries.QUERIES["op13_spelling_variants"](spark, root)) == brute(rows)


def test_empty_table_clashing_names_and_small_tables_of_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty, spelling.slipped).count() == 0
    rows = odd_rows()[:30]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "k", "t", "block", "tile", "kind", "form", "root")})
    assert found(spelling.variants(docs, spelling.slipped)) == brute(rows)
    few = spelling.word_counts(docs, spelling.slipped, kept=2)
    assert {(r.word, r.n) for r in few.collect()} == set(counted(rows).items())


def test_products_keep_all_pairs_of_one_edit():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abé") for _ in range(7)) for _ in range(400)})
    longer = sorted({"".join(rng.choice("abé") for _ in range(8)) for _ in range(400)})
    a, b = (spelling.Words(w, np.ones(len(w), np.int64)) for w in (words, longer))
    assert set(zip(*map(list, spelling.near(a, b)), strict=True)) == {(i, j) for i, x in enumerate(words) for j, y in enumerate(longer) if apart(x, y)}
    assert set(zip(*map(list, spelling.near(a, a)), strict=True)) == {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if apart(x, y)}
