import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import topk_tree as T


def brute(rows, k, every):
    v = {i: [math.floor(256 * float(np.float32(x))) for x in e] for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = set()
    for q in v:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q and len(v[c]) == len(v[q]))
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best[:k])}
    return out


def searched(spark, rows, k=5, every=50):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS block", "'x' AS v")
    got = T.top_k(spark, df, F.col("id") % every == 0, k=k).collect()
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got}, len(got)


@pytest.mark.parametrize("dim,n", [(3, 400), (16, 300)])
def test_equals_brute_force(spark, monkeypatch, dim, n):
    monkeypatch.setattr(T, "BLOCK", 64)
    rng = np.random.default_rng(dim)
    centers = rng.normal(size=(5, dim))
    rows = [(i, [float(x) for x in centers[i % 5] + rng.normal(scale=0.2, size=dim)]) for i in range(n)]
    got, count = searched(spark, rows, every=7)
    assert got == brute(rows, 5, 7) and count == len(got)


def test_ties_repeats_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 16)
    same = [(i, [0.5, 0.25]) for i in range(120)]  # most rows alike
    odd = [(200, None), (201, [None, 1.0]), (202, [float("nan"), 1.0]), (203, [float("inf"), 0.0]), (None, [1.0, 1.0]), (204, []), (250, [1.0, 2.0, 3.0]), (300, [-1.0, -0.001])]
    rows = same + odd
    got, _ = searched(spark, rows)
    assert got == brute(rows, 5, 50)


def test_fewer_candidates_than_asked_and_empty_table(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-3.0])]
    assert searched(spark, rows)[0] == brute(rows, 5, 50)
    assert searched(spark, [])[0] == set()


def test_tree_invariants():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-50, 50, (300, 4)), np.full((80, 4), 7)])
    tree = T.CoverTree(points, np.arange(len(points)))
    seen = []

    def under(k):
        kids = tree.children[k]
        rows = np.concatenate([under(c) for c in kids]) if kids else tree.members[k]
        d = np.sqrt(((points[rows] - points[tree.center[k]]) ** 2).sum(axis=1))
        assert d.max() <= tree.radius[k] + 1e-9 and tree.least[k] == rows.min()
        for i, a in enumerate(kids):
            for b in kids[:i]:
                assert np.linalg.norm(points[tree.center[a]] - points[tree.center[b]]) > tree.radius[k] / 2
        return rows

    seen = under(0)
    assert sorted(seen) == list(range(len(points)))


def test_pruning_skips_far_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    data = T.CoverTree(np.concatenate([rng.integers(900, 1000, (500, 2)), rng.integers(-1000, -900, (500, 2))]), np.arange(1000))
    queries = T.CoverTree(rng.integers(90, 100, (40, 2)), np.arange(5000, 5040))
    done = []
    real = T._products
    monkeypatch.setattr(T, "_products", lambda a, b: done.append(len(a) * len(b)) or real(a, b))
    best = T.dual_search(queries, data, 3, np.full(40, np.iinfo(np.int64).min))
    exact = queries.points @ data.points.T
    assert (best.score == -np.sort(-exact, axis=1)[:, :3]).all()
    assert sum(done) < exact.size / 2
