"""keep_first for wide rows of few repeated keys: the same rows, and rows of single keys are not gathered."""

import random

import pytest

from claimlake import registry
from claimlake.operators import dedup as D
from claimlake.plans.pipeline import silver_from_tables
from conftest import SF_SMALL


@pytest.mark.parametrize("bits", [64, 1 << 27])  # nearly every bit is shared, or none
def test_same_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(D, "REPEAT_BITS", bits)
    r = random.Random(7)
    rows = [(r.choice([None, *range(300)]), r.choice([None, "a"]), r.choice([None, 1, 2]), r.choice([None, "x", "y"])) for _ in range(600)]
    rows += [(7, "hot", i % 50, "z") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, c string, claim_item_id int, v string")
    for keys in (["k", "c"], ["k"], ["c"]):
        got, want = D.keep_first(df, keys, sparse=True), D.keep_first(df, keys)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert D.keep_first(df.limit(0), ["k"], sparse=True).count() == 0


def test_only_rows_of_repeated_keys_are_gathered(spark):
    lines = silver_from_tables(spark, SF_SMALL)
    gathered = D._may_repeat(lines, D.DUPLICATE_KEY).where("_repeat").count()
    assert gathered == D.quarantine(lines).count() < lines.count() / 4


@pytest.mark.parametrize("name", ["silver_claims_doc", "fact_claims_doc"])
def test_whole_lines_are_marked_before_they_are_shuffled(spark, name):
    plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "Union" in plan
    window = plan[plan.index("Window ["):]
    assert "_bits" in window[:window.index("Join ")]
