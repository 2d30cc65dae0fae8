import math

import numpy as np
import pytest

from claimlake.llm import whitening as W


def plain(rows):
    """Whole rows by dense algebra: (id, component) -> [n, deviation, whitened, explained]."""
    lists = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in lists]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    away = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    cov = away.T @ away / n
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    white = away @ axes[:, :8] / np.sqrt(e[:8])
    out = {}
    for r, (i, _) in enumerate(lists):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x[r], sums))
        for k in range(min(8, len(e))):
            out[i, k + 1] = (n, deviation, white[r, k], e[k] / np.trace(cov))
    return out


def same(got, want):
    assert len(got) == len(want) and {(r["vec_id"], r["component"]) for r in got} == set(want)
    for k in {r["component"] for r in got}:
        mine = np.array([r["whitened"] for r in got if r["component"] == k])
        theirs = np.array([want[r["vec_id"], k][2] for r in got if r["component"] == k])
        assert np.allclose(mine, theirs * np.sign(mine @ theirs), atol=1e-7)
    for r in got:
        n, deviation, _, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["explained"] / explained - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-8


def test_query_equals_dense_algebra(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = W.op13_whitening(spark, "/root/testdata/sf0.001")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(got.collect(), plain(rows))


@pytest.fixture
def written(spark, tmp_path):
    def make(rows, name="t"):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS id", "7 AS index", "1 AS part", "'y' AS whitened", "2 AS n")
        df.repartition(5).write.parquet(str(tmp_path / name / "embeddings.parquet"))
        return str(tmp_path / name)

    return make


def random_rows(n, d, seed=1):
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(d, d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(n, d)) @ spread / d)]


def test_many_blocks_and_splits(spark, written, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ROWS", 16)
    monkeypatch.setattr(W, "SPLIT_BLOCKS", 2)
    rows = random_rows(333, 12)
    same(W.op13_whitening(spark, written(rows)).collect(), plain(rows))


def test_odd_rows(spark, written):
    rows = random_rows(60, 5)
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [math.nan] * 5), (104, [math.inf, 0.0, 0.0, 0.0, 0.0]), (105, [1e30, 0.0, 0.0, 0.0, 0.0]), (106, [1.0, 2.0])]
    got = W.op13_whitening(spark, written(rows + odd)).collect()
    same(got, plain(rows))


def test_null_and_repeated_ids_are_rows(spark, written):
    rows = random_rows(40, 4)
    rows = [(None if i < 3 else i // 2, v) for i, v in rows] + [rows[5], rows[5]]
    got = W.op13_whitening(spark, written(rows)).collect()
    assert len(got) == 42 * 4 and all(r["n"] == 42 for r in got)
    assert sum(r["vec_id"] is None for r in got) == 3 * 4


def test_fewer_directions_than_dimensions(spark, written):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 1.0]) for i in range(30)]
    got = W.op13_whitening(spark, written(rows)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 30
    assert all(abs(r["explained"] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]])
def test_no_variance_gives_no_rows(spark, written, rows):
    got = W.op13_whitening(spark, written(rows))
    assert got.count() == 0 and "identity_error" in got.columns


def test_large_entries_stay_exact(spark, written):
    rows = [(i, [float(np.float32(1e7 * math.sin(i))), float(np.float32(1e9 * math.cos(3 * i)))]) for i in range(50)]
    want = plain(rows)
    fit, found = W.whiten(spark, spark.read.parquet(written(rows) + "/embeddings.parquet"))
    assert fit.n == 50 and {r["id"]: int(r["deviation"]) for r in found.collect()} == {i: want[i, 1][1] for i, _ in rows}
