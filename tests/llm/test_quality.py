"""Held-out accuracy, shrinkage of sparse sites, and odd rows."""

import math

from pyspark.sql import functions as F

from weirstone.llm import quality
from weirstone.llm.quality import classify

ROOT = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{ROOT}/documents.parquet"), spark.read.parquet(f"{ROOT}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    judged = classify(docs.withColumn("e", F.lit(1)), labels, ("quality", "toxic"), F.col("source"), F.col("lang"), learn_from=~held)
    assert judged.count() == docs.count()
    rows = judged.join(labels.where(held), "doc_id").collect()
    assert len(rows) > 60
    assert sum((r.quality_score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.93
    assert sum((r.toxic_score >= 0.5) == (r.toxic == 1) for r in rows) / len(rows) > 0.93
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(r.quality_score >= 0.5 and r.toxic_score < 0.5 for r in clean) / len(clean) > 0.97


def test_sites_are_shrunk(spark):
    """Texts say nothing; a site of many bad rows ends low, one bad row moves its site a little."""
    rows = [(i, "same words", "bad", "a") for i in range(200)] + [(1000 + i, "same words", "good", "a") for i in range(200)] + [(2000, "same words", "small", "a"), (2001, None, None, None), (2002, "", "new", "b")]
    labels = [(i, 0) for i in range(200)] + [(1000 + i, 1) for i in range(200)] + [(2000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").withColumn("n", F.lit(0)).repartition(3)
    got = {r.doc_id: r for r in classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"), ("quality",), F.col("host"), F.col("path")).collect()}
    assert len(got) == len(rows)
    assert got[0].quality_site < 0.05 < got[2000].quality_site < 0.5 and got[1000].quality_site > 0.95
    assert all(0 <= r.quality_score <= 1 and math.isfinite(r.quality_evidence) for r in got.values())


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "h", "p"), (None, None, None, None)], "doc_id long, text string, host string, path string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [round(r.quality_score, 3) for r in classify(docs, none, ("quality",), F.col("host"), F.col("path")).collect()] == [0.5, 0.5]
    assert classify(docs.limit(0), none, ("quality",), F.col("host"), F.col("path")).count() == 0


def test_features_are_counted_over_all_labelled_rows(spark):
    """Words beyond the clearest 800, and words that the fitted sample shows fewer than five times, have a weight."""
    n = 4000
    rows = [(i, f"w{i % 1000} common" if i % 2 else f"v{i % 1000} common") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
    bad = {h: len(v) for h, v in quality.counted(docs.unionAll(docs).unionAll(docs).unionAll(docs).unionAll(docs).unionAll(docs), labels, ("toxic",), "doc_id", "text").items()}
    assert 900 < bad["toxic"] <= 1001
    many = docs.unionByName(docs.selectExpr("doc_id + 10000 doc_id", "text")).unionByName(docs.selectExpr("doc_id + 20000 doc_id", "text"))
    labelled = labels.unionAll(labels.selectExpr("doc_id + 10000", "toxic")).unionAll(labels.selectExpr("doc_id + 20000", "toxic"))
    deep = many.unionByName(many.selectExpr("doc_id + 100000 doc_id", "text"))
    all_labels = labelled.unionAll(labelled.selectExpr("doc_id + 100000", "toxic"))
    judged = classify(deep, all_labels, ("toxic",), F.lit("h"), F.lit("p")).where("doc_id < 10000").select("doc_id", "toxic_evidence").collect()
    assert sum((r.toxic_evidence > 0) == (r.doc_id % 2 == 1) for r in judged) / n > 0.97


def test_a_null_label_is_none(spark):
    """Rows without a label of a head change nothing for it, and leave the other heads as they are."""
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "bad words", "h", "p") for i in range(60)], "doc_id long, text string, host string, path string")
    labels = [(i, i % 2, None if i % 3 else i % 2) for i in range(40)] + [(41, None, None), (None, 1, 0)]
    both = classify(docs, spark.createDataFrame(labels, "doc_id long, a int, b int"), ("a", "b"), F.col("host"), F.col("path"))
    alone = classify(docs, spark.createDataFrame([(i, b) for i, _, b in labels if b is not None], "doc_id long, b int"), ("b",), F.col("host"), F.col("path"))
    got, single = ({r.doc_id: r for r in df.collect()} for df in (both, alone))
    assert all(math.isfinite(r.a_score) and math.isfinite(r.b_score) for r in got.values())
    assert all(abs(got[i].b_evidence - single[i].b_evidence) < 1e-6 for i in got)
    assert all((r.a_score > 0.5) == (r.doc_id % 2 == 1) for r in got.values())


def test_repeated_documents_do_not_outgrow_the_sample(spark):
    rows = [(7, "copied text")] * 3000 + [(i, f"text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    found, targets = quality.labelled_rows(docs, labels, ("quality",), "doc_id", "text", 16)
    assert len(found) == len(targets["quality"]) == 16
    found, _ = quality.labelled_rows(docs, labels, ("quality",), "doc_id", "text", 1000)
    assert len(found) == 101  # document 7 has two texts


def test_every_labelled_document_passes_the_filter(spark):
    docs = spark.range(20_000).selectExpr("id - 10000 as doc_id", "'a b' as text")
    labels = docs.where("doc_id % 3 = 0").selectExpr("doc_id", "1 as quality")
    passed = {r.label_key for r in quality.features_of_labelled(docs, labels, "doc_id", "text").select("label_key").collect()}
    wanted = {r.doc_id for r in labels.collect()}
    assert wanted <= passed and len(passed) < len(wanted) + 20


def test_posteriors_equal_a_plain_computation(spark):
    """Rates of hosts and paths, drawn towards each other by strengths from the method of moments."""
    rows = [(i, None, f"h{i % 4}", f"p{i % 3}") for i in range(120)]
    truth = {i: int((i * 7919) % 5 < i % 4) for i in range(120)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, quality int")
    got = classify(docs, labels, ("quality",), F.col("host"), F.col("path")).collect()

    def moments(groups):
        n, s = [len(g) for g in groups], [sum(g) for g in groups]
        rate = min(max(sum(s) / sum(n), 1e-4), 1 - 1e-4)
        between = sum(k * (t / k - rate) ** 2 for k, t in zip(n, s, strict=True))
        room = sum(n) - sum(k * k for k in n) / sum(n) - (len(n) - 1)
        share = min(max((between / (rate * (1 - rate)) - (len(n) - 1)) / room if room > 0 else 0.0, 1e-4), 0.5)
        return rate, (1 - share) / share

    by_host, by_path = {}, {}
    for i, _, host, path in rows:
        by_host.setdefault(host, []).append(truth[i])
        by_path.setdefault((host, path), []).append(truth[i])
    rate, host_prior = moments(list(by_host.values()))
    _, path_prior = moments(list(by_path.values()))
    for r in got:
        _, _, host, path = rows[r.doc_id]
        own, mine = by_host[host], by_path[host, path]
        host_rate = (sum(own) + host_prior * rate) / (len(own) + host_prior)
        assert abs(r.quality_site - (sum(mine) + path_prior * host_rate) / (len(mine) + path_prior)) < 1e-9
