"""Readers and writers: text ingest, runs, partitioned and routed sinks."""

import os
import uuid

from pyspark.sql import functions as F

from claimlake.operators import quality as Q
from claimlake.plans.pipeline import silver_from_tables
from claimlake.session import checkpoint_dir
from claimlake.sources import readers as R, writers as W
from claimlake.sources.fixture import raw_claims
from conftest import SF_SMALL


def _tmp(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def test_ingest_csv_and_json_as_text(spark):
    raw = raw_claims(spark, SF_SMALL)
    d = _tmp(spark, "ingest")
    raw.toDF(*[c.upper() for c in raw.columns]).write.option("header", True).csv(d + "/csv")
    raw.write.json(d + "/json")
    for fmt in ("csv", "json"):
        got = R.ingest_raw(spark, f"{d}/{fmt}", fmt=fmt)
        assert set(got.columns) == set(raw.columns)          # names normalised
        assert all(t == "string" for _, t in got.dtypes)     # nothing inferred
        assert got.count() == raw.count()


def test_bronze_runs_and_latest(spark):
    raw = raw_claims(spark, SF_SMALL)
    path = _tmp(spark, "bronze")
    W.write_bronze(raw, path, "20240101")
    W.write_bronze(raw.where(F.col("type") == "Medicare"), path, "20240102")
    W.write_bronze(raw.where(F.col("type") == "Medicare"), path, "20240102")  # re-run replaces its run
    assert R.latest_run(spark, path) == "20240102"
    latest = R.read_latest(spark, path)
    assert latest.count() == raw.where(F.col("type") == "Medicare").count()
    assert R.read_run(spark, path, "20240101").count() == raw.count()


def test_read_latest_empty(spark):
    from claimlake.schema import RAW_SCHEMA
    assert R.read_latest(spark, _tmp(spark, "none"), schema=RAW_SCHEMA).count() == 0


def test_silver_partitioned_and_quarantine(spark):
    silver = silver_from_tables(spark, SF_SMALL)
    d = _tmp(spark, "silver")
    W.write_silver(silver.drop("_cleaned_at"), d + "/silver")
    back = spark.read.parquet(d + "/silver")
    assert back.count() == silver.count()
    assert back.where((F.col("year") == 2021) & (F.col("month") == 1)).count() == \
        silver.where((F.col("year") == 2021) & (F.col("month") == 1)).count()
    W.write_quarantine(silver, d + "/audit")
    from claimlake.operators.dedup import quarantine
    assert spark.read.parquet(d + "/audit").count() == quarantine(silver).count() > 0


def test_routed_write_splits_all_rows(spark):
    silver = silver_from_tables(spark, SF_SMALL)
    d = _tmp(spark, "routed")
    W.write_routed(silver, Q.SILVER_RULES, d)
    routed = spark.read.parquet(d)
    counts = {r.dq_route: r["count"] for r in routed.groupBy("dq_route").count().collect()}
    assert sum(counts.values()) == silver.count() and set(counts) <= {"pass", "quarantine"}


def test_stage_and_conform(spark):
    silver = silver_from_tables(spark, SF_SMALL)
    staged = W.stage(silver)
    assert [f.name for f in staged.schema.fields] == [f.name for f in W.STAGING_SCHEMA.fields]
    assert dict(staged.dtypes)["charge_amt"] == "double" and dict(staged.dtypes)["received_date"] == "string"
    out = _tmp(spark, "insert")
    W.insert_into(silver, W.STAGING_SCHEMA, out)
    assert spark.read.parquet(out).count() == silver.count()


def test_command_line_run_and_view(spark, capsys):
    from claimlake.__main__ import main
    d = _tmp(spark, "cli")
    raw = raw_claims(spark, SF_SMALL)
    raw.toDF(*[c.upper() for c in raw.columns]).write.option("header", True).csv(d + "/raw")
    assert main(["run", "--raw", d + "/raw", "--format", "csv", "--out", d + "/lake",
                 "--batch-id", "20240101_000000"]) == 0
    assert main(["view", "--out", d + "/lake", "--name", "vw_network_impact"]) == 0
    assert "avg_discount_rate" in capsys.readouterr().out
    assert main(["view", "--out", d + "/lake", "--name", "nope"]) == 2


def test_schema_on_read_resolves_by_name(spark):
    from pyspark.sql import types as T
    silver = silver_from_tables(spark, SF_SMALL)
    d = _tmp(spark, "sor")
    W.stage(silver).write.parquet(d)
    declared = T.StructType([T.StructField("claim_code", T.StringType()),
                             T.StructField("claim_item_id", T.LongType()),
                             T.StructField("not_written", T.StringType())])
    got = R.read_layer(spark, d, declared)
    assert got.columns == ["claim_code", "claim_item_id", "not_written"]
    assert got.where(F.col("not_written").isNotNull()).count() == 0
    assert got.count() == silver.count()


def test_marts_materialised(spark):
    from claimlake.plans.pipeline import run
    d = _tmp(spark, "marts")
    status = {r.table: r for r in run(spark, raw_claims(spark, SF_SMALL), d, batch_id="20240101_000000",
                                      marts=True).collect()}
    assert status["mart_monthly_costs"].status == "SUCCESS" and status["mart_monthly_costs"].rows > 0
    assert spark.read.parquet(os.path.join(d, "marts", "mart_provider_kpis")).count() == status["mart_provider_kpis"].rows


def test_newest_file_rows(spark):
    import time
    d = _tmp(spark, "newest")
    spark.range(5).coalesce(1).write.parquet(d)
    time.sleep(1.2)
    spark.range(100, 103).coalesce(1).write.mode("append").parquet(d)
    got = sorted(r.id for r in R.newest_file_rows(spark.read.parquet(d)).collect())
    assert got == [100, 101, 102]


def test_strict_run_raises_when_a_table_fails(spark, monkeypatch):
    import pytest
    from claimlake.plans import pipeline as P
    raw = raw_claims(spark, SF_SMALL).limit(50)
    real = W.write_table

    def fails(df, path, *a, **k):
        if path.endswith("dim_payer"):
            raise OSError("disk full")
        return real(df, path, *a, **k)

    monkeypatch.setattr(P.W, "write_table", fails)
    status = {r.table: r.status for r in P.run(spark, raw, _tmp(spark, "strict"), batch_id="1").collect()}
    assert status["dim_payer"].startswith("ERROR") and status["fact_claims"] == "SUCCESS"
    with pytest.raises(RuntimeError, match="dim_payer: ERROR: disk full"):
        P.run(spark, raw, _tmp(spark, "strict"), batch_id="1", strict=True)
