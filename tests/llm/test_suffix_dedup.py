"""Removed bytes against a count of all 200-byte strings."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from weirstone.llm import suffix_dedup
from weirstone.llm.arrays import powers
from weirstone.llm.suffix_dedup import deduplicate, without_repeats


def brute(rows, length=200):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(r[p : p + length] for _, r in raw for p in range(len(r) - length + 1))
    result = []
    for d, r in raw:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        result.append((d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result)


def corpus():
    rng = random.Random(12)

    def prose(n):
        return "".join(rng.choices("abcdefghij éß\n", k=n))

    shared = [prose(n) for n in (150, 199, 200, 201, 202, 230, 260, 330, 400, 700, 1500)]
    rows = [(1, None), (2, ""), (3, "x" * 199), (4, "y" * 200), (5, "z" * 201), (6, "ab" * 300), (7, prose(5000)), (8, "q" * 3000)]
    for i in range(150):
        parts = [prose(rng.randint(0, 250))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 3)
            parts += [s[a : len(s) - rng.randint(0, len(s) // 3)], prose(rng.randint(0, 120))]
        rows.append((100 + i, "".join(parts)))
    rows += [(1000 + i, rows[40][1]) for i in range(3)] + [(2000 + i, rows[50][1][i:] + "end") for i in range(4)]
    line = prose(230)
    rows += [(3000 + i, prose(100) + line + prose(100)) for i in range(60)]
    return rows


def test_removed_bytes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 th", "2 place", "3 zip", "4 ranges").repartition(4)
    assert sorted(map(tuple, deduplicate(docs).collect())) == brute(rows)


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 600)
    rows = corpus()[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, deduplicate(docs).collect())) == brute(rows)


def test_text_without_repeats(spark):
    rng = random.Random(1)
    passage = "".join(rng.choices("abcdef é", k=300))
    rows = [(1, "one " + passage + " two", 9), (2, "three" + passage, 9), (3, None, None), (4, "", 0), (5, passage, 300), (6, "short", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("rest", F.lit("r")).withColumn("r", F.lit(1))
    kept = without_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in kept.collect()) == [(1, "one  two", 8), (2, "three", 5), (3, None, None), (4, "", 0), (6, "short", 5)]
    assert deduplicate(docs.limit(0)).count() == 0 and without_repeats(docs.limit(0)).count() == 0


def test_a_task_that_cleans_texts_holds_one_worker(spark):
    """The letters that are left come from the function that removes bytes."""
    docs = spark.createDataFrame([(1, "é" * 150, 150), (2, "é" * 150 + "x", 151), (3, "y", 1), (4, None, None)], "doc_id long, text string, n_chars int")
    cleaned = without_repeats(docs)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2  # packed before the shuffle, cleaned after it
    assert sorted(map(str, cleaned.collect())) == ["Row(doc_id=2, text='x', n_chars=1)", "Row(doc_id=3, text='y', n_chars=1)", "Row(doc_id=4, text=None, n_chars=None)"]


def test_powers_are_kept_for_what_is_needed():
    """Each worker keeps them for good."""
    up, down = powers(100_000)
    assert len(up) == len(down) == 1 << 17
