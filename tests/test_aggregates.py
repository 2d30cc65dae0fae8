"""Aggregated role reports: no small cell can be worked out from what is shown."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.operators import aggregates as A

K = 5


def report(spark, lines, least=K):
    df = spark.createDataFrame(lines, "g string, c string, claimant_id long, charge long")
    return A.suppressed(df, F.col("g"), F.col("c"), {"claims": F.count(F.lit(1)), "charges": F.sum("charge")}, least).collect()


def patients(lines, **where):
    return {p for g, c, p, _ in lines if where.get("g", g) == g and where.get("c", c) == c}


def check(rows, lines):
    """Shown figures are the true ones, and no sum over fewer than K patients' lines, cell or group,
    is a combination of shown sums."""
    cells = sorted({(g, c) for g, c, _, _ in lines})
    unit = {x: np.eye(len(cells))[i] for i, x in enumerate(cells)}
    known = []
    for r in rows:
        members = [x for x in cells if (r["level"] == "all" or x[0] == r["group"]) and (r["level"] != "cell" or x[1] == r["cell"])]
        if r["shown"]:
            known.append(sum(unit[x] for x in members))
            assert r["charges"] == sum(v for g, c, _, v in lines if (g, c) in members) and r["patients"] >= K
        else:
            assert r["charges"] is r["claims"] is r["patients"] is None
    rank = lambda m: np.linalg.matrix_rank(np.array(m)) if m else 0
    secret = [unit[x] for x in cells if len(patients(lines, g=x[0], c=x[1])) < K]
    secret += [sum(unit[x] for x in cells if x[0] == g) for g in {g for g, _ in cells} if len(patients(lines, g=g)) < K]
    for s in secret:
        assert rank([*known, s]) == rank(known) + 1


@pytest.mark.parametrize("seed", range(10))
def test_no_small_cell_can_be_computed(spark, seed):
    rng = random.Random(seed)
    size = {(g, c): rng.choice([0, 1, 2, 4, 5, 6, 20]) for g in "abcd" for c in "xyz"}
    lines = [(g, c, rng.randrange(60), rng.randrange(1, 1000)) for (g, c), n in size.items() for _ in range(n)]
    check(report(spark, lines), lines)


def test_one_small_cell_takes_the_smallest_other_with_it(spark):
    lines = [("a", c, 100 * i + p, 10) for i, (c, n) in enumerate({"x": 2, "y": 9, "z": 7}.items()) for p in range(n)]
    shown = {(r["level"], r["cell"]): r["shown"] for r in report(spark, lines)}
    assert shown == {("all", None): True, ("group", None): True, ("cell", "x"): False, ("cell", "y"): True, ("cell", "z"): False}


def test_a_small_group_hides_another_with_all_its_cells(spark):
    lines = [(g, "x", 100 * i + p, 10) for i, (g, n) in enumerate({"a": 2, "b": 9, "c": 7}.items()) for p in range(n)]
    shown = {(r["level"], r["group"]): r["shown"] for r in report(spark, lines)}
    assert shown[("group", "b")] and shown[("cell", "b")] and not any(shown[(level, g)] for level in ("group", "cell") for g in "ac")


def test_null_names_and_no_lines(spark):
    lines = [(None, None, p, 1) for p in range(8)] + [(None, "x", p, 1) for p in range(6)] + [("a", None, p, 1) for p in range(9)]
    assert all(r["shown"] for r in report(spark, lines))
    assert [r["shown"] for r in report(spark, [])] == [False]


def test_roles(spark):
    with pytest.raises(ValueError):
        A.role_report(spark.range(1), "analyst")
