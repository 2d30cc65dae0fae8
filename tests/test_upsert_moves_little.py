"""Merging batches: what is written, kept and moved, with the same result."""

import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from claimlake import registry
from claimlake.plans.mart_deltas import MartStore, _SCHEMA
from claimlake.registry import streaming as J
from claimlake.session import checkpoint_dir
from claimlake.sources import writers as W
from claimlake.streaming import incremental as I, runs as R
from claimlake.streaming.file_index import FileIndex
from conftest import SF_SMALL

COLS = "claim_item_id long, amount int, service_month string"


def folder(spark):
    return os.path.join(checkpoint_dir(spark).removeprefix("file:"), f"up-{uuid.uuid4().hex}")


def test_no_copy_of_a_batch_is_left(spark):
    path, before = folder(spark), set(glob.glob(checkpoint_dir(spark) + "/upsert-*"))
    for _ in range(2):
        I.upsert(spark, path, spark.createDataFrame([(1, 5, "2021-01"), (1, 6, "2021-02"), (2, 6, None)], COLS))
    assert set(glob.glob(checkpoint_dir(spark) + "/upsert-*")) == before and not glob.glob(path + "/_index/new-*")
    files = [f for f in glob.glob(path + "/service_month=*/*.parquet")]
    assert len(files) == 2 and all(f.endswith(".zstd.parquet") for f in files)


def test_files_of_a_batch_alone_are_told_from_mixed_ones(spark):
    path = folder(spark)
    I.upsert(spark, path, spark.range(20).selectExpr("id AS claim_item_id", "1 AS amount", "'2021-01' AS service_month"))
    I.upsert(spark, path, spark.range(20, 40).selectExpr("id AS claim_item_id", "1 AS amount", "'2021-02' AS service_month"))
    keyed = lambda df: df.withColumn("_k", F.concat(F.lit("k"), F.col("claim_item_id").cast("string")))
    index = FileIndex(spark, path)
    here = index.update(keyed)
    ask = lambda a, b: [[f.split("/")[0] for f in files] for files in index.touched(keyed(spark.range(a, b).toDF("claim_item_id")), here, keyed)]
    assert ask(0, 39) == [["service_month=2021-01"], ["service_month=2021-02"]]
    assert ask(19, 50) == [["service_month=2021-02"], ["service_month=2021-01"]]
    assert ask(50, 90) == [[], []]


@pytest.mark.parametrize("sent, small", [(R.MOST_SENT, W.MAX_RECORDS_PER_FILE), (0, 0)])
def test_any_batches_equal_a_dict(spark, monkeypatch, sent, small):
    monkeypatch.setattr(R, "MOST_SENT", sent)  # 0: bits of hashes are sent
    monkeypatch.setattr(W, "MAX_RECORDS_PER_FILE", small)  # 0: rows that stay are written apart
    rng, path, want = random.Random(3), folder(spark), {}
    for n in (60, 40, 40, 5):
        batch = [(rng.randrange(80), rng.randrange(-3, 20), f"2021-0{rng.randrange(1, 5)}") for _ in range(n)]
        done = I.merge_batch(spark, path, spark.createDataFrame(batch, COLS), deleted=F.col("amount") < 0, images=f"{path}-{n}-{len(want)}")
        last, before = {k: max(r for r in batch if r[0] == k) for k, *_ in batch}, dict(want)
        for k, r in last.items():
            want.pop(k, None)
            if r[1] >= 0:
                want[k] = r
        assert sorted(map(tuple, spark.read.schema(COLS).parquet(path).collect())) == sorted(want.values())
        images = [(*before[k], -1) for k in last if k in before] + [(*r, 1) for r in last.values() if r[1] >= 0]
        assert sorted(map(tuple, done.changes.collect())) == sorted(images)


def test_the_last_by_a_helper_column(spark):
    path = folder(spark)
    rows = spark.createDataFrame([(1, 5, "2021-01", 2), (1, 9, "2021-02", 1), (2, 1, "2021-02", 1)], COLS + ", seq int")
    I.upsert(spark, path, rows, order_col="seq", helper_cols=("seq",))
    assert sorted(map(tuple, spark.read.schema(COLS).parquet(path).collect())) == [(1, 5, "2021-01"), (2, 1, "2021-02")]
    assert "seq" not in spark.read.parquet(path).columns and "_order" not in spark.read.parquet(path).columns


def test_of_changed_lines_marts_keep_the_partials_alone(spark):
    for name in ("mart_monthly_costs_by_delta", "mart_provider_kpis_by_delta"):
        made = []
        with pytest.MonkeyPatch.context() as m:
            m.setattr(J, "MartStore", lambda s, path: made.append(path) or MartStore(s, path))
            assert registry.queries()[name](spark, SF_SMALL).count()
        for batch in os.listdir(os.path.join(made[0].removeprefix("file:"), "images")):
            held = spark.read.parquet(os.path.join(made[0], "images", batch, "rows"))
            assert held.columns == _SCHEMA.names


@pytest.mark.parametrize("name", ["incremental_fact_claims", "incremental_moved_month"])
def test_lines_are_derived_once_and_packed(spark, name):
    before = set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/lines-*"))
    registry.queries()[name](spark, SF_SMALL)
    made = set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/lines-*")) - before
    assert len(made) == 1 and all(f.endswith(".zstd.parquet") for d in made for f in glob.glob(d + "/*.parquet"))
