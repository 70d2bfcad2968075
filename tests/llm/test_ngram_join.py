"""Components against all pairs of shingle sets."""

import random
import uuid
from pathlib import Path

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from weirstone.llm import graph, ngram_join
from weirstone.llm.ngram_join import near_duplicates, one_of_each


def sets(text):
    table = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    low = (text or "").translate(table)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    ws = [w for w in low.split(" ") if w]
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute(rows):
    found = [sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_token = {}
    for i, s in enumerate(found):
        for t in s:
            by_token.setdefault(t, []).append(i)
    pairs = {(a, b) for ids in by_token.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        if 100 * len(found[a] & found[b]) >= 80 * len(found[a] | found[b]):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(found[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    boiler = rng.choices(vocabulary, k=60)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO"), (6, "one two three four five"), (7, "É x"), (8, "é x"), (9, "a\xa0b")]
    for g in range(60):
        base = rng.choices(vocabulary, k=rng.choice([6, 20, 60, 150, 400]))
        for _ in range(rng.choice([1, 2, 3, 12])):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 30)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 2)] = rng.choices(vocabulary, k=rng.randint(0, 2))
            if rng.random() < 0.3:
                words = boiler + words
            rows.append((100 + len(rows), " ".join(words)))
    rows += [(5000 + i, rows[20][1]) for i in range(30)]
    chain = rng.choices(vocabulary, k=200)  # each like the next, the ends unlike
    for i in range(60):
        chain[i * 3 : i * 3 + 2] = rng.choices(vocabulary, k=2)
        rows.append((6000 + i, " ".join(chain)))
    return rows


@pytest.mark.parametrize("hot,chunk", [(24, 1024), (1, 4)])
def test_components_equal_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(ngram_join, "HOT_FROM", hot)
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 th", "2 n", "3 token").repartition(3)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == brute(rows)


def test_one_of_each(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (3, None), (3, None), (4, "x"), (4, "x"), (None, "y z"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone", F.lit(1))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text) == [("1", "a b c d e f"), ("4", "x"), ("None", "y z")]
    assert one_of_each(docs.limit(0)).count() == 0 and near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_with_ids_on_several_texts(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (2, "only here and nowhere else"), (4, "p q r s t u"), (5, "P q r s t u"), (5, "v w x y z"), (6, "V w x y z")]
    rows += [(7, "one two three"), (7, "One two three"), (None, "g h i j k"), (None, "g h i j k"), (None, "G h i j k"), (None, "l m n o"), (8, "L m n o"), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 th", "2 k").repartition(3)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in kept.collect())
    assert got == sorted([("1", "a b c d e f"), ("2", "only here and nowhere else"), ("4", "p q r s t u"), ("5", "v w x y z"), ("7", "one two three"), ("8", "l m n o"), ("None", "g h i j k"), ("None", ""), ("None", "")])


def test_only_texts_of_surviving_pairs_are_sent(spark, monkeypatch, tmp_path):
    """Documents that share one shingle and no more have no pair: their texts are not even packed."""
    rng = random.Random(3)
    rows = [(i, " ".join(["all", "of", "them", "say", "this"] + [f"v{rng.random()}" for _ in range(40)])) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(5)]
    folder = str(tmp_path)

    @F.arrow_udf("binary")
    def told(text: pa.Array) -> pa.Array:
        Path(folder, f"{uuid.uuid4()}-{len(text)}").touch()
        return pa.array([zstandard.compress(t.encode()) for t in text.to_pylist()], pa.binary())

    monkeypatch.setattr(ngram_join, "compressed", told)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == brute(rows)
    assert 10 <= sum(int(p.name.rpartition("-")[2]) for p in tmp_path.iterdir()) < 100


@pytest.mark.parametrize("bits", [1 << 25, 1 << 15])
def test_the_filter_loses_no_key(spark, monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "FILTER_BITS", bits)
    keys = spark.range(20_000).select(F.xxhash64("id").alias("th"), "id")
    passed = [r.id for r in keys.where(ngram_join.may_be_in(keys.where("id % 10 = 0").select("th"))).collect()]
    assert set(passed) >= set(range(0, 20_000, 10))
    assert (len(passed) < 2100) == (bits == 1 << 25)


def test_first_pairs_are_drawn_without_a_shuffle_by_token(spark):
    lists = spark.createDataFrame([(1, 2, 9, (1, 9), (3, 9)), (1, 1, 9, (1, 9), (3, 9)), (1, 3, 9, (1, 9), (3, 9)), (2, 4, 9, (4, 9), None), (2, 5, 9, (4, 9), None), (2, 6, 90, (4, 9), None)],
                                  "token long, th long, n long, lead struct<th long, n long>, drawn struct<th long, n long>")
    points = spark.range(1, 7).select(F.col("id").alias("th"), F.lit(bytes([9] * ngram_join.GROUPS)).alias("point"))
    pairs = ngram_join.first_stars(lists, points)
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 2), (1, 3), (3, 1), (3, 2), (4, 5)]
    assert "hashpartitioning(token" not in pairs._jdf.queryExecution().executedPlan().toString()


def jobs(spark, group, act):
    """What ``act`` returns, and the number of Spark jobs it took."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return act(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_the_filter_is_fetched_by_one_job_for_all_partitions(spark):
    wanted = spark.range(2000).select(F.xxhash64("id").alias("th"))
    few = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 40)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert jobs(spark, str(uuid.uuid4()), lambda: ngram_join.may_be_in(wanted))[1] < 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_star_is_found_in_one_round(spark, monkeypatch):
    made = []
    written = graph._written
    monkeypatch.setattr(graph, "_written", lambda df, label: made.append(label) or written(df, label))
    edges = spark.createDataFrame([(5, 2), (2, 7), (9, 2), (2, 9), (4, 4), (-3, 8)], "a long, b long")
    assert sorted(map(tuple, graph.star_forest(edges).collect())) == [(5, 2), (7, 2), (8, -3), (9, 2)]
    assert made == ["stars"]
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert sorted(map(tuple, graph.star_forest(chain).collect())) == [(i, 0) for i in range(1, 301)]


def test_no_pairs_are_made_that_no_turn_reads(spark, monkeypatch):
    """Star pairs are drawn between turns, not after the last one."""
    turns = []
    drawn = ngram_join.star_pairs
    monkeypatch.setattr(ngram_join, "star_pairs", lambda named, measured, turn: turns.append(turn) or drawn(named, measured, turn))
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(docs).collect())) == brute(rows)
    assert turns == list(range(1, ngram_join.ROUNDS))
