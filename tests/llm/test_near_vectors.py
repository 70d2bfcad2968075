"""Links, components and recall against all pairs."""

import random

import numpy as np

from weirstone.llm.graph import components
from weirstone.llm.near_vectors import near_duplicates


def brute(rows, threshold=0.95):
    usable = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(usable)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = [0] * len(usable)
    for x in range(len(usable)):
        for y in range(x):
            a, b = usable[x][1], usable[y][1]
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[x] += 1
                links[y] += 1
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(usable):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return sorted(((i, links[x], least.get(find(x))) for x, (i, _) in enumerate(usable)), key=str)


def test_near_duplicates(spark):
    random_ = np.random.default_rng(2)
    base = random_.normal(size=(60, 32))
    vectors = [(b + random_.normal(size=32) * s).astype(np.float32).tolist() for b in base for s in (0, 0.05, 0.1, 0.2, 0.24)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[7]) for i in range(40)] + [(None, vectors[9]), (7, vectors[7])]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 32), (2003, [float("nan")] * 32), (2004, [1.0, None]), (2005, [float("inf")] * 32), (2006, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, raw int").repartition(3)
    got = near_duplicates(frame).collect()
    assert len(got) == len(rows) + len(bad)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is None or r.vec_id < 2000), key=str) == brute(rows)
    for r in got:
        assert r.kept == (r.vec_id == r.component_id)
        if (r.vec_id or 0) >= 2000:
            assert (r.n_links, r.component_id) == (0, r.vec_id)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_recall_near_the_threshold(spark):
    """Copies of the sample vectors turned by just less than the threshold allows."""
    random_ = np.random.default_rng(4)
    given = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()], float)
    given /= np.linalg.norm(given, axis=1, keepdims=True)
    aside = random_.normal(size=given.shape)
    aside -= (aside * given).sum(axis=1, keepdims=True) * given
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = random_.uniform(0.951, 0.99, (len(given), 1))
    matrix = np.concatenate([given, cosine * given + np.sqrt(1 - cosine**2) * aside])
    links = (matrix @ matrix.T >= 0.95).sum(axis=1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_duplicates(table).collect()}
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert sum(got.values()) >= 0.97 * links.sum() and links.sum() >= 4000


def test_components(spark):
    random_ = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, 1), (5, 3), (3, 9), (9, 5)] + [(1000, i) for i in range(1001, 1300)] + [(random_.randrange(2000, 2200), random_.randrange(2000, 2200)) for _ in range(120)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
