from __future__ import annotations

import numpy as np
import pytest
from larder.llm import vptree


def brute(rows, asked, k=10):
    out = {}
    for q, v in asked:
        found = sorted((float(np.sqrt(np.square(np.subtract(v, w)).sum())), i) for i, w in rows if i != q)
        out[q] = found[:k]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    return {q: [found[i] for i in sorted(found)] for q, found in out.items()}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(900)]
    rows += [(1000 + i, [1.0] * 8) for i in range(500)]  # one vector many times
    rows += [(2000 + i, rows[i][1]) for i in range(30)]  # ties of pairs
    return rows


def test_factor_one_is_exact_with_ties(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    asked = [r for r in vectors if r[0] % 50 == 0]
    got = answers(vptree.nearest(df, df.where("vec_id % 50 = 0"), factor=1.0, shard=300, block=10))
    want = brute(vectors, asked)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], rtol=0, atol=1e-15)


def recall_of(got, want):
    return np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("kind", ["gaussian", "clustered"])
def test_fitted_factor_reaches_the_recall_on_other_vectors(spark, kind):
    rng = np.random.default_rng(4)
    if kind == "gaussian":
        points = rng.normal(size=(6000, 8))
    else:
        points = 3 * rng.normal(size=(60, 32))[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 32))
    rows = list(enumerate(points))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = answers(vptree.nearest(df, df.where("vec_id % 20 = 0"), shard=3000, block=200))
    assert recall_of(got, brute(rows, rows[::20])) >= 0.95


def test_the_factor_depends_on_the_vectors(spark):
    rng = np.random.default_rng(5)
    line = np.outer(rng.normal(size=4000), rng.normal(size=6))  # neighbours along one direction
    ball = rng.normal(size=(4000, 12))
    fitted = []
    for points in (line, ball):
        df = spark.createDataFrame([(i, v.tolist(), len(v)) for i, v in enumerate(points)], "id long, v array<double>, dim int")
        fitted.append(vptree.fitted_factor(df, df.where("id % 40 = 0"), 100))
    assert 0 < fitted[0] <= 1 and fitted[1] < 1
    assert vptree.fitted_factor(df.limit(0), df.limit(0), 0) == 1.0
    assert vptree.fitted_factor(df, df.where("id % 40 = 0"), 100, recall=1.01) == 1.0
    # The same by hand: recall of one shard against brute force.
    tree = vptree.Tree(ball, np.arange(4000))
    d, ids = tree.search(ball[::40], np.arange(0, 4000, 40), 10, fitted[1])
    want = brute(list(enumerate(ball)), list(enumerate(ball))[::40])
    got = {40 * q: list(zip(d[q], ids[q])) for q in range(100)}
    assert recall_of(got, want) >= 0.95


def test_default_factor_reaches_the_recall(spark, folder):
    df = spark.read.parquet(f"{folder.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in df.collect()]
    asked = [r for r in rows if r[0] % 100 == 0]
    got = answers(vptree.nearest(df, df.where("vec_id % 100 = 0"), shard=600))
    want = brute(rows, asked)
    hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.95
    assert all([tuple(p) for p in got[q]] == sorted(map(tuple, got[q])) for q in got)


def test_smaller_factors_compare_fewer_points():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(4000, 6))
    tree = vptree.Tree(points, np.arange(4000), leaf=32)
    seen = []
    offer = vptree.Best.offer

    def counted(self, active, some, squares, ids):
        seen[-1] += len(active) * len(ids)
        offer(self, active, some, squares, ids)

    vptree.Best.offer = counted
    try:
        for factor in (1.0, 0.5, 0.2):
            seen.append(0)
            tree.search(points[:50], np.arange(50), 10, factor)
    finally:
        vptree.Best.offer = offer
    assert seen[0] > seen[1] > seen[2]


def test_vectors_that_take_no_part_few_candidates_and_clashes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [1.0, None]), (6, []),
            (None, [1.0, 1.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0, 3.0]), (7, [1.0, 2.0]), (100, [3.0, 4.0])]
    df = spark.createDataFrame([(*r, 1, "v") for r in rows], "vec_id long, embedding array<double>, id int, v string")
    got = answers(vptree.nearest(df, df.where("vec_id % 100 = 0")))
    assert got == {0: [(2.0, 7), (2.0, 7), (20 ** 0.5, 100)], 100: [(8 ** 0.5, 7), (8 ** 0.5, 7), (20 ** 0.5, 0)]}
    assert vptree.nearest(df.limit(0), df.limit(0)).collect() == []
    assert vptree.nearest(df, df.limit(0)).collect() == []
