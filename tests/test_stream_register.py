"""Streamed Silver with its keys in a register: no stream state, no line moved that is the only one of its key."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from claimlake.schema import RAW_COLUMNS
from claimlake.streaming import register as R, stream as S
from conftest import raw_frame


def claim(i, **more):
    return {"claim_item_id": i, "claimant_id": "5", "received_date": "2021-03-04", "charge_amt": "10.00", "allowed_amt": "4.00", "claim_code": "99213", "units": "1", **more}


def test_available_now_keeps_no_stream_state(spark, tmp_path):
    src = str(tmp_path / "in")
    raw_frame(spark, [claim("1"), claim("2"), claim(None), claim(None)]).write.json(src + "/a")
    raw_frame(spark, [claim("2"), claim("3", received_date="x")]).write.json(src + "/b")
    for again in (0, 1):
        if again:  # the next day
            raw_frame(spark, [claim("1", charge_amt="99.00"), claim("4")]).write.json(src + "/c")
        silver = S.run_available_now(spark, src + "/*", str(tmp_path / "work"))
        got = sorted((str(r["claim_item_id"]), str(r["charge_amt"])) for r in spark.read.parquet(silver).collect())
        assert got == sorted([(i, "10.00") for i in ("1", "2", "3", "None", "None", "4")[: 5 + again]])
    assert not glob.glob(str(tmp_path / "work" / "_ckpt_silver" / "state") + "/*")
    assert {"dq_score", "is_valid"} & set(spark.read.parquet(silver).columns)


@pytest.mark.parametrize("most", [R.MOST_SENT, 0])
def test_single_keys_are_not_moved_however_many_repeat(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(R, "MOST_SENT", most)
    rows = spark.range(400).select(*[F.concat(F.lit(c), F.col("id") % 300).alias(c) for c in RAW_COLUMNS]).withColumn("_ingested_at", F.current_timestamp())
    register = R.KeyRegister(spark, str(tmp_path / "reg"), 4)
    first = S.dedup_stream(rows, ["claim_item_id"], "_ingested_at", "1 hour", register, R.batch_name(0))
    assert "SortMergeJoin" not in first._jdf.queryExecution().executedPlan().toString()
    got = [r[0] for r in first.select("claim_item_id").collect()]
    assert len(got) == 300 == len(set(got))


def test_stream_state_is_there_still(spark, tmp_path):
    raw_frame(spark, [claim("1"), claim("1"), claim("2")]).withColumn("_ingested_at", F.current_timestamp()).write.parquet(str(tmp_path / "bronze"))
    S.bronze_to_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 2
    assert os.listdir(str(tmp_path / "ck" / "state"))
