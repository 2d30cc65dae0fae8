"""First deliveries: rows of keys that stand once are not gathered by key, with the same result."""

import os
import random
import uuid

from pyspark.sql import functions as F

from claimlake.session import checkpoint_dir
from claimlake.streaming import register as R


def _register(spark):
    return R.KeyRegister(spark, os.path.join(checkpoint_dir(spark), f"register-{uuid.uuid4().hex}"), buckets=4)


def test_one_row_per_new_key(spark, monkeypatch):
    r = random.Random(5)
    for sent in (R.MOST_SENT, 0):  # repeated keys sent to every task, or joined by a shuffle
        monkeypatch.setattr(R, "MOST_SENT", sent)
        register, before = _register(spark), set()
        for i in range(3):
            rows = [(r.choice([None, *range(60)]), r.choice([None, "x", "y", "z"])) for _ in range(50)]
            df = spark.createDataFrame(rows, "id int, v string")
            got = sorted(map(tuple, register.first_deliveries(df, "id", R.batch_name(i)).collect()), key=str)
            new = {k for k, _ in rows} - before - {None}
            key = lambda v: "" if v is None else v
            want = {k: min(key(v) for j, v in rows if j == k) for k in new}
            assert {k: key(v) for k, v in got if k is not None} == want
            assert len(got) == len(new) + sum(k is None for k, _ in rows)
            register.add(df, "id", R.batch_name(i))
            before |= {k for k, _ in rows}


def test_rows_of_single_keys_are_not_moved(spark):
    rows = spark.range(100).select(F.col("id"), F.concat(F.lit("line"), "id").alias("v"))
    plan = _register(spark).first_deliveries(rows, "id", R.batch_name(0))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
