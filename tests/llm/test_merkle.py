"""The Merkle manifest against a brute-force tree."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirstone.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    fields = (row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + more, row.text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i : i + 2]) for i in range(0, len(row), 2)])
    return levels


def climb(levels, i, digest):
    """(siblings, root) from leaf ``i`` if it were ``digest``."""
    beside = []
    for row in levels[:-1]:
        run = list(range(i // 2 * 2, min(i // 2 * 2 + 2, len(row))))
        beside += [row[j] for j in run if j != i]
        digest = h(*(digest if j == i else row[j] for j in run))
        i //= 2
    return beside, digest


def brute(rows):
    by_lang = defaultdict(list)
    for row in rows:
        changed = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
        by_lang[row.lang].append((row.doc_id, leaf(row), leaf(row, 1) if changed else leaf(row)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {lang: tree([x[1] for x in by_lang[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (doc_id, own, claim) in enumerate(by_lang[lang]):
            beside, reached = climb(trees[lang], i, claim)
            above, folded = climb(top, k, reached)
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], h(*beside, *above), folded, folded == top[-1][0]))
    return Counter(out)


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in df.select(*names).collect())


def odd_rows():
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(77)]
    rows += [(i, "é" * i, "ß", None, None) for i in range(100, 109)]
    rows += [(7, "again", "en", "s", 5), (7, "again", "en", "s", 5), (7, "other", "en", "s", 5)]  # ties, and a repeated row
    rows += [(None, "no id", "en", "s", 1), (None, None, None, None, None), (200, "", "", "", 0), (201, None, None, "x", 3)]
    return [*rows, (300, "long " * 200_000, "alone", "s", 1_000_000)]


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_equals_brute_force(spark, height):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    assert found(merkle.document_manifest(docs, queries.fold(7, 0), height)) == brute(docs.collect())


def test_query_on_a_table_equals_brute_force(spark):
    root = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{root}/documents.parquet").collect()
    assert found(queries.QUERIES["op12_merkle_manifest"](spark, root)) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert merkle.document_manifest(spark.createDataFrame([], SCHEMA), queries.fold(7, 0)).count() == 0
    docs = spark.createDataFrame(odd_rows()[:20], SCHEMA)
    clash = {c: F.lit("x") for c in ("tree", "key", "leaf", "claim", "rank", "n", "part", "place", "block", "root", "nodes", "path")}
    assert found(merkle.document_manifest(docs.withColumns(clash), queries.fold(7, 0), 2)) == brute(docs.collect())


def test_a_hot_group_of_equal_rows_is_dealt_out(spark):
    docs = spark.createDataFrame([(1, "same", "en", "s", 4)] * 3000 + [(2, "x", "de", "s", 1)], SCHEMA).repartition(3)
    assert found(merkle.document_manifest(docs, queries.fold(7, 0), 4)) == brute(docs.collect())


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5, 9])
def test_places_are_those_of_the_recursive_layout(levels):
    def lay(depth, index, n):
        """Nodes (depth, index) of a subtree of n levels, in order."""
        if n == 1:
            return [(depth, index)]
        top = n // 2
        out = lay(depth, index, top)
        for k in range(1 << top):
            out += lay(depth + top, (index << top) + k, n - top)
        return out

    expected = {node: place for place, node in enumerate(lay(0, 0, levels))}
    for depth in range(levels):
        at = merkle.address(depth, np.arange(1 << depth), levels)
        assert at.tolist() == [expected[depth, i] for i in range(1 << depth)]


def test_stored_subtrees_hold_their_nodes(spark):
    docs = spark.createDataFrame(odd_rows()[:77], SCHEMA)
    below, _ = merkle.manifest(spark, merkle.document_leaves(docs, queries.fold(7, 0)), "claim", height=3)
    assert [t.count() for t in below] == [10, 2, 1]
    levels = tree([leaf(r) for r in docs.orderBy("doc_id").collect()])
    first = below[0].filter("block = 1").first()
    for depth in range(4):
        row = levels[3 - depth][(1 << depth) : (2 << depth)]
        places = merkle.address(depth, np.arange(len(row)), 4)
        assert [first.nodes[32 * p : 32 * p + 32].hex() for p in places] == row
