import math
import os

import numpy as np
import pytest

from clickloom.llm import ann

ROOT = "/root/testdata/sf0.01"


def plain(rows, queries, k):
    """All inner products, exactly rounded; nearest first, ties to the smaller id."""
    out = []
    for own, q in queries:
        best = sorted(
            (-math.fsum(float(a) * float(b) for a, b in zip(q, v)), i) for i, v in rows if i != own
        )
        out += [(own, n + 1, i, -s) for n, (s, i) in enumerate(best[:k])]
    return out


def test_chi_square():
    # Published quantiles.
    for p, degrees, x in ((0.95, 2, 5.991), (0.99, 10, 23.209), (0.5, 16, 15.338)):
        assert abs(ann.chi_square_quantile(p, degrees) - x) < 1e-3


def test_kd_tree_holds_every_point():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(500, 4)), np.zeros((300, 4))])
    tree = ann.KdTree(points, 16)
    assert sorted(tree.rows.tolist()) == list(range(800))
    q = rng.normal(size=4)
    outer = tree.squared_distances(q)
    for leaf, end in enumerate(tree.ends):
        start = tree.ends[leaf - 1] if leaf else 0
        inside = ((points[tree.rows[start:end]] - q) ** 2).sum(1)
        assert outer[leaf] <= inside.min() + 1e-12


def test_clustered_search_ends_early_and_finds():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(200, 32)) * 3
    vectors = centres[rng.integers(0, 200, 8000)] + rng.normal(size=(8000, 32)) * 0.05
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = np.arange(8000)
    index = ann.Index(ids, vectors, float(np.linalg.norm(vectors, axis=1).max()), 16)
    quantile, hits, looked = ann.chi_square_quantile(0.99, 16), 0, []
    whole = index.vectors

    class Counting(np.ndarray):
        def __getitem__(self, rows):
            if isinstance(rows, np.ndarray) and rows.ndim == 1:
                looked.append(len(rows))
            return super().__getitem__(rows)

    index.vectors = whole.view(Counting)
    for own in range(0, 8000, 400):
        got, _ = index.search(own, np.asarray(vectors[own]), 10, quantile)
        score = vectors @ vectors[own]
        score[own] = -np.inf
        hits += len(set(got.tolist()) & set(np.argsort(-score)[:10].tolist()))
    assert hits >= 0.95 * 200
    assert sum(looked) < 0.5 * 20 * 8000


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
def test_recall_on_the_table(spark):
    vectors = spark.read.parquet(f"{ROOT}/embeddings.parquet")
    got = ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20, block_rows=200, query_rows=10)
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = plain(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = {(r["query_id"], r["vec_id"]): r for r in got.collect()}
    assert len(found) == len(want)
    score = {(q, i): s for q, _, i, s in plain(rows, [r for r in rows if r[0] % 20 == 0], len(rows))}
    assert all(r["score"] == score[key] for key, r in found.items())
    assert sum((q, i) in found for q, _, i, _ in want) >= 0.9 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)]  # many equal vectors
    rows += [(100, [0.0, 0.0, 0.0]), (101, None), (102, [1.0, None, 0.0]), (103, [nan, 1.0, 1.0])]
    rows += [(104, [inf, 0.0, 0.0]), (105, [1.0, 2.0]), (106, []), (None, [1.0, 1.0, 1.0])]
    rows += [(200, [-1.0, 0.5, 9.0]), (201, [5.0, 5.0, 5.0]), (201, [5.0, 5.0, 5.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, block string, rank int")
    usable = [r for r in rows if r[0] is not None and r[0] < 100] + rows[-3:]
    got = ann.nearest(df, df, 20, block_rows=7, query_rows=9, confidence=0.999999)
    queries = {i: v for i, v in usable}.items()
    want = plain(usable, queries, 20)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    few = ann.nearest(df.where("vec_id in (1, 2, 201)"), df.where("vec_id = 1"), 20)
    assert [tuple(r)[:3] for r in few.orderBy("rank").collect()] == [(1, 1, 201), (1, 2, 201), (1, 3, 2)]
    assert ann.nearest(df.limit(0), df, 20).count() == 0
    assert ann.nearest(df, df.limit(0), 20).count() == 0


def test_very_short_query():
    import numpy as np

    from clickloom.llm import ann

    vectors = np.random.default_rng(0).normal(size=(50, 8))
    index = ann.Index(np.arange(50), vectors, float(np.linalg.norm(vectors, axis=1).max()), 6)
    query = vectors[0] * 1e-200
    found = np.asarray(index.search(-1, query, 50, 1e9)[0]).tolist()
    assert sorted(found) == list(range(50))
