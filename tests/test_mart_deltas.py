"""Marts kept up by deltas against marts built anew."""

import os
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from claimlake.operators import star as G
from claimlake.plans import views as V
from claimlake.plans.mart_deltas import MartStore
from claimlake.plans.pipeline import silver_from_tables
from claimlake.session import checkpoint_dir
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def base(spark):
    work = os.path.join(checkpoint_dir(spark), f"md-{uuid.uuid4().hex}")
    silver = silver_from_tables(spark, SF_SMALL)
    for name, df in (("fact", G.fact_claims(silver).drop("_loaded_at").dropDuplicates(["claim_item_id"])), ("dim", G.dim_provider(silver))):
        df.write.parquet(f"{work}/{name}")
    return spark.read.parquet(f"{work}/fact"), spark.read.parquet(f"{work}/dim")


@pytest.fixture
def store(spark):
    work = os.path.join(checkpoint_dir(spark), f"ms-{uuid.uuid4().hex}")
    return MartStore(spark, work + "/marts"), work + "/fact_claims"


def same(spark, marts, path, dim, schema):
    star = SimpleNamespace(fact_claims=spark.read.schema(schema).parquet(path), dim_provider=dim)
    for got, want in ((marts.monthly_costs(), V.monthly_costs(star)), (marts.provider_kpis(), V.provider_kpis(star))):
        got, want = sorted(map(tuple, got.select(*want.columns).collect()), key=str), sorted(map(tuple, want.collect()), key=str)
        assert got == want


def test_three_batches_equal_a_rebuild(spark, base, store):
    fact, dim = base
    marts, path = store
    early = F.coalesce(F.col("service_month") < "2021-06", F.lit(True))
    assert marts.follow(path, fact.where(early), dim, "0")
    same(spark, marts, path, dim, fact.schema)
    # a month is emptied, another gains its lines, amounts change, and new lines come
    moved = fact.where((F.col("service_month") == "2020-05") | ~early).withColumns({
        "received_date": F.when(F.col("service_month") == "2020-05", F.lit("2020-07-09").cast("date")).otherwise(F.col("received_date")),
        "charge_amt": (F.col("charge_amt") + 3).cast("decimal(18,2)"), "service_month": F.when(F.col("service_month") == "2020-05", F.lit("2020-07")).otherwise(F.col("service_month"))})
    months = marts.follow(path, moved, dim, "1")
    assert {"2020-05", "2020-07"} <= set(months) and "2020-01" not in months
    same(spark, marts, path, dim, fact.schema)
    gone = fact.where("claim_code = '99213'")
    marts.follow(path, gone, dim, "2", deleted=F.lit(True))
    same(spark, marts, path, dim, fact.schema)
    marts.refresh(dim)
    same(spark, marts, path, dim, fact.schema)


def test_only_touched_months_are_written(spark, base, store):
    fact, dim = base
    marts, path = store
    marts.follow(path, fact, dim, "0")
    folder = marts._table("monthly_costs")
    stamp = lambda: {m: {f: os.stat(os.path.join(folder, m, f)).st_mtime_ns for f in os.listdir(os.path.join(folder, m))} for m in os.listdir(folder) if "=" in m}
    before = stamp()
    assert marts.follow(path, fact.where("service_month = '2021-02'").limit(3).withColumn("allowed_amt", F.lit(1).cast("decimal(18,2)")), dim, "1") == ["2021-02"]
    after = stamp()
    assert {m for m in before if before[m] != after.get(m)} == {"service_month=2021-02"}


def test_a_batch_sent_again_changes_nothing(spark, base, store, monkeypatch):
    fact, dim = base
    marts, path = store
    marts.follow(path, fact, dim, "0")
    batch = fact.where("service_month = '2021-03'").withColumn("charge_amt", F.lit(7).cast("decimal(18,2)"))
    # the batch is merged into the fact, but the job ends before the marts take it in
    monkeypatch.setattr(MartStore, "apply", lambda *a, **k: [])
    marts.follow(path, batch, dim, "1")
    monkeypatch.undo()
    for _ in range(2):
        marts.follow(path, batch, dim, "1")
        same(spark, marts, path, dim, fact.schema)
