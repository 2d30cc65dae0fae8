"""keep_first with the columns that are returned: the same rows, and the others are not moved."""

import random

from claimlake import registry
from claimlake.operators.dedup import keep_first
from conftest import SF_SMALL


def test_same_rows_as_cut_afterwards(spark):
    r = random.Random(3)
    rows = [(r.choice("ab"), r.choice([None, 1, 2]), *(r.choice([None, "x", "y"]) for _ in range(4))) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, claim_item_id int, c1 string, c2 string, c3 string, c4 string")
    for keys, columns in ((["k"], ["claim_item_id", "c2", "k"]), (["k", "c3"], ["c3", "claim_item_id"]), (["k"], ["c4", "c1"]), (["k"], ["k"])):
        want = keep_first(df, keys).select(*columns)
        got = keep_first(df, keys, columns=columns)
        assert got.columns == columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_columns_that_break_no_tie_are_not_moved(spark):
    plan = registry.queries()["dedup_keep_first"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.splitlines() if " Window [" in line)
    assert "allowed_amt" in window and "diag_code_1" not in window and "proc_desc" not in window
