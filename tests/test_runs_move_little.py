"""Change tables: a load is not shuffled, of a batch only files with a repeated key are written again."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from claimlake import registry
from claimlake.session import checkpoint_dir
from claimlake.streaming import runs as R
from claimlake.streaming.changes import ChangeTable
from conftest import SF_SMALL

ROW = "k long, v string"


@pytest.fixture
def table(spark):
    path = os.path.join(checkpoint_dir(spark).removeprefix("file:"), f"ch-{uuid.uuid4().hex}")
    return ChangeTable(spark, path, spark.createDataFrame([], ROW).schema, "k", 2)


def test_a_load_is_written_where_it_is_and_files_of_single_keys_stay(spark, table, monkeypatch):
    again, delete = [], R.X._delete
    monkeypatch.setattr(R.X, "_delete", lambda s, path, files: again.extend(files) or delete(s, path, files))
    # key 7 stands twice, in the last of four parts
    rows = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") == 3999, 7 + 3000).otherwise(F.col("id")).alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    table.load(rows)
    assert 1 <= len(again) <= 2  # of eight files: two buckets, four parts
    files = glob.glob(table.runs.path + "/bucket=*/run=*/*.parquet")
    assert len(files) >= 8 and all(f.endswith(".zstd.parquet") for f in files)
    got = dict(map(tuple, table.current().collect()))
    assert len(got) == 3999 == table.current().count() and got[3007] == "v3999" and got[5] == "v5"


@pytest.mark.parametrize("sent", [R.MOST_SENT, 0])
def test_many_repeats_without_moving_the_others(spark, table, monkeypatch, sent):
    monkeypatch.setattr(R, "MOST_SENT", sent)  # 0: bits of the hashes are sent
    table.load(spark.range(3000).select(F.col("id").alias("k"), F.lit("s").alias("v")))
    changes = spark.range(0, 3300, 3).selectExpr("id AS k", "concat('c', id) AS v", "if(id % 2 = 0, 'U', 'D') AS op", "id AS seq")
    table.apply(changes.unionByName(changes.where("id % 5 = 0".replace("id", "k")).withColumn("v", F.lit("x")).withColumn("seq", F.col("seq") - 1)))
    want = {k: "s" for k in range(3000)} | {k: f"c{k}" for k in range(0, 3300, 3)}
    want = {k: v for k, v in want.items() if k % 3 or k % 2 == 0}
    now = table.current()
    assert dict(map(tuple, now.collect())) == want and now.count() == len(want)
    assert "SortMergeJoin" not in now._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["stream_cdc_claims", "stream_cdc_out_of_order"])
def test_change_feeds_are_packed(spark, name):
    work = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(work + "/cdc*"))
    registry.queries()[name](spark, SF_SMALL)
    (made,) = set(glob.glob(work + "/cdc*")) - before
    files = glob.glob(made + "/feed/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)
