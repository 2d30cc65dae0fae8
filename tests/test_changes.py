"""Change tables kept as runs: order of delivery, repeats, and what a batch writes."""

import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from claimlake.session import checkpoint_dir
from claimlake.streaming.changes import ChangeTable

ROW = "k long, v string"
FEED = ROW + ", op string, seq long"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path + "/**/*.parquet", recursive=True)}


@pytest.fixture
def table(spark):
    def make(buckets=4):
        return ChangeTable(spark, os.path.join(checkpoint_dir(spark), f"ch-{uuid.uuid4().hex}"), spark.createDataFrame([], ROW).schema, "k", buckets)

    return make


def rows(t):
    return sorted(tuple(r) for r in t.current().collect())


def test_any_order_and_repeats_give_the_result_in_order(spark, table):
    rng = random.Random(5)
    start = [(k, "start") for k in range(12)]
    feed = [(rng.randrange(16), f"v{seq}", rng.choice("IUUD"), seq) for seq in range(60)]
    want = dict(start)
    for k, v, op, _ in feed:
        want.pop(k, None)
        if op != "D":
            want[k] = v
    for order in (feed, feed[::-1], rng.sample(feed, 60) + feed[::2]):
        t = table()
        t.load(spark.createDataFrame(start, ROW))
        for i in range(0, len(order), 25):
            t.apply(spark.createDataFrame(order[i : i + 25], FEED), compact_from=2)
        assert rows(t) == sorted(want.items())


def test_deletes_before_inserts_and_equal_numbers(spark, table):
    for order in (1, -1):
        t = table()
        for c in [(1, "a", "I", 1), (1, None, "D", 2), (2, "x", "U", 5), (2, "y", "U", 5)][::order]:
            t.apply(spark.createDataFrame([c], FEED))
        assert rows(t) == [(2, "y")]


def test_rows_without_a_key_are_known_by_content(spark, table):
    t = table()
    batch = spark.createDataFrame([(None, "a", "I", 1), (None, "b", "I", 1), (None, "a", "I", 1)], FEED)
    t.apply(batch)
    t.apply(batch)
    assert sorted(r[1] for r in t.current().collect()) == ["a", "b"]


def test_a_batch_rewrites_no_file_and_compaction_only_full_buckets(spark, table):
    t = table(buckets=16)
    t.load(spark.range(2000).select(F.col("id").alias("k"), F.lit("s").alias("v")))
    before = files(t.runs.path)
    one = spark.createDataFrame([(7, "new", "U", 1)], FEED)
    assert t.apply(one, compact_from=3) == []
    after = files(t.runs.path)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    (bucket,) = t.runs.touched(t._keyed(one, F.col("seq"), F.lit(False)))
    for seq in (2, 3):
        compacted = t.apply(spark.createDataFrame([(7, f"new{seq}", "U", seq)], FEED), compact_from=3)
    assert compacted == [bucket] and len(t.runs.layout()[bucket]) == 1
    gone = set(before) - set(files(t.runs.path))
    assert gone and all(f"bucket={bucket}/" in f for f in gone)
    assert dict(rows(t))[7] == "new3" and len(rows(t)) == 2000


def test_clean_buckets_are_read_without_a_shuffle(spark, table):
    t = table()
    t.load(spark.range(100).select(F.col("id").alias("k"), F.lit("s").alias("v")))
    assert "Exchange" not in t.current()._jdf.queryExecution().executedPlan().toString()


def test_empty_table_and_empty_batch(spark, table):
    t = table()
    assert rows(t) == []
    t.apply(spark.createDataFrame([], FEED))
    assert rows(t) == []


def test_rows_of_a_key_of_its_own_are_not_gathered(spark, table):
    """Only hashes and the rows of repeated keys are shuffled, whatever the table's width."""
    t = table(buckets=2)
    wide = F.concat(F.lit("s"), *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(4)]).alias("v")
    t.load(spark.range(3000).select(F.col("id").alias("k"), wide))
    t.apply(spark.createDataFrame([(k, "new", "U", 1) for k in (1, 2, 3, 3)] + [(5000, "new", "I", 1), (4, None, "D", 2)], FEED))
    plan = t.current()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = dict(rows(t))
    assert len(got) == 3000 and [got[k] for k in (1, 2, 3, 5000)] == ["new"] * 4 and 4 not in got and got[5].startswith("s")


def test_many_repeated_keys_are_joined_by_a_shuffle(spark, table, monkeypatch):
    monkeypatch.setattr("claimlake.streaming.runs.MOST_SENT", 10)
    t = table()
    for seq, n in ((1, 100), (2, 50)):
        t.apply(spark.range(n).selectExpr("id AS k", f"'v{seq}' AS v", "'U' AS op", f"{seq}L AS seq").unionByName(spark.range(n).selectExpr("id AS k", "'a' AS v", "'U' AS op", f"{seq}L AS seq")))
    assert rows(t) == [(k, "v2" if k < 50 else "v1") for k in range(100)]


def test_a_run_sent_again_replaces_itself(spark, table):
    t = table()
    runs = t.runs
    for v in ("old", "new"):
        runs.append(t._keyed(spark.createDataFrame([(k, v) for k in range(20)], ROW), F.lit(1), F.lit(False)), "r")
    assert rows(t) == [(k, "new") for k in range(20)] and {tuple(r) for r in runs.layout().values()} == {("r",)}
    assert not glob.glob(runs.path + "/_new/*")
