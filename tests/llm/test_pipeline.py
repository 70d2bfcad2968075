"""Every stage on its own input, with planted cases, and the whole over the sample tables."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from weirstone.llm import decontaminate, ngram_join, suffix_dedup

ROOT = "/root/testdata/sf0.001"


def test_stages_keep_what_is_clean_and_catch_what_is_planted(spark, tmp_path):
    rng = random.Random(6)
    given = spark.read.parquet(f"{ROOT}/documents.parquet")
    benchmark = spark.read.parquet(f"{ROOT}/benchmark.parquet").orderBy("item_id").first().text
    words = [w for r in given.limit(40).collect() for w in r.text.split()]
    fresh = " ".join(rng.choices(words, k=300))
    passage = " ".join(rng.choices(words, k=60))
    planted = [
        (90001, fresh, "en"),
        (90002, fresh, "en"),
        (90003, fresh.replace(" the ", " the the ", 1), "en"),
        (90004, "new words " + benchmark + " more words", "en"),
        (90005, " ".join(rng.choices(words, k=80)) + " " + passage, "en"),
        (90006, " ".join(rng.choices(words, k=80)) + " " + passage, "en"),
        (90007, None, None),
        (90008, "12345 67890", None),
    ]
    more = spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in planted], given.schema)
    docs = given.unionByName(more)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, ROOT).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "best_fit_packing":
            assert after.columns == given.columns
        kept[name] = docs, after
        docs = after
    ids = {name: {r.doc_id for r in after.select("doc_id").collect()} for name, (_, after) in kept.items()}
    assert {90007, 90008} & ids["language_id"] == set() and len(ids["language_id"]) >= given.count()
    before, after = kept["ngram_join"]
    components = ngram_join.near_duplicates(before).collect()
    assert ids["ngram_join"] == {r.component_id for r in components} and after.count() == len(ids["ngram_join"])
    assert {90001, 90002, 90003} & ids["ngram_join"] == {90001}
    before, after = kept["suffix_dedup"]
    texts = {r.doc_id: r.text for r in after.collect()}
    sizes = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.deduplicate(before).collect()}
    assert passage not in texts[90005] and passage not in texts[90006] and len(texts[90005]) > 300
    assert {d for d, n in sizes.items() if n} == set(texts) and all(len(t.encode()) <= sizes[d] for d, t in texts.items())
    before, after = kept["decontaminate"]
    dirty = {r.doc_id for r in decontaminate.contaminated(before, spark.read.parquet(f"{ROOT}/benchmark.parquet")).collect()}
    assert 90004 in dirty and ids["decontaminate"] == ids["suffix_dedup"] - dirty
    assert ids["best_fit_packing"] == ids["decontaminate"]


def test_columns_of_any_name_come_through(spark):
    given = spark.read.parquet(f"{ROOT}/documents.parquet").withColumn("language", F.col("doc_id") * 2).withColumn("rejected", F.lit(True))
    kept = corpus_pipeline.known_language(spark, given, ROOT)
    assert kept.schema == given.schema and kept.where("language = doc_id * 2").count() == kept.count() > 0


def test_of_rows_with_one_key_and_text_always_the_same_stays(spark):
    text = " ".join(f"word{n}" for n in range(40))
    rows = [(1, text, f"source {n}", None if n % 2 else n) for n in range(30)]
    chosen = set()
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string, n_chars int").repartition(5)
        chosen.add(tuple(ngram_join.one_of_each(docs).first()))
    assert len(chosen) == 1


def test_run(spark):
    packed = corpus_pipeline.run(spark, ROOT)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and packed.count() > 100
