"""The key register: uniqueness over batches and late deliveries."""

import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from claimlake.operators.quality import uniqueness
from claimlake.session import checkpoint_dir
from claimlake.streaming.register import KeyRegister, batch_name, read_silver, silver_once
from conftest import raw_frame


@pytest.fixture
def register(spark):
    return KeyRegister(spark, os.path.join(checkpoint_dir(spark), f"reg-{uuid.uuid4().hex}"), 8)


def keys(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "k long")


def test_equals_the_full_count_after_each_batch(spark, register):
    batches, seen = [[1, 2, 3, None], [4, 5, 5, 1], [], [None, 6, 7, 1, 1]], []
    for i, ids in enumerate(batches):
        seen += ids
        register.add(keys(spark, ids), "k", batch_name(i), most=1)
        assert register.report().first() == uniqueness(keys(spark, seen), "k").first()


def test_new_duplicates_come_from_the_merge(spark, register):
    register.add(keys(spark, [1, 2, 2, None]), "k", batch_name(0))
    batch = keys(spark, [2, 3, 3, 4, None])
    want = [(None, 1, 1), ("2", 1, 2), ("3", 2, 0)]
    assert sorted(map(tuple, register.new_duplicates(batch, "k", batch_name(1)).collect()), key=str) == sorted(want, key=str)
    register.add(batch, "k", batch_name(1))
    # the batch itself, sent again, is not its own predecessor
    assert sorted(map(tuple, register.new_duplicates(batch, "k", batch_name(1)).collect()), key=str) == sorted(want, key=str)


def test_a_batch_sent_again_counts_once(spark, register):
    register.add(keys(spark, [1, 2]), "k", batch_name(0), most=1)
    for _ in range(2):
        register.add(keys(spark, [2, 3]), "k", batch_name(1), most=1)
    assert tuple(register.report().first()) == (False, 1)


def test_only_the_buckets_of_a_batch_are_read(spark, register):
    register.add(spark.range(500).withColumnRenamed("id", "k"), "k", batch_name(0))
    register.add(keys(spark, [3, 9]), "k", batch_name(1))
    batch = keys(spark, [3])
    (bucket,) = register.runs.touched(batch.select(F.col("k").cast("string").alias("_key")))
    read = register.known(batch, "k", batch_name(2)).inputFiles()
    assert read and {re.search(r"bucket=(\d+)", f).group(1) for f in read} == {bucket}


def test_one_key_of_most_rows(spark, register):
    hot = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    for i in range(2):
        register.add(hot, "k", batch_name(i))
    assert register.report().first()["duplicate_count"] == 40_000 - hot.distinct().count()


def claim(i, **more):
    return {"claim_item_id": i, "claimant_id": "5", "received_date": "2021-03-04", "charge_amt": "10.00", "allowed_amt": "4.00", "claim_code": "99213", "units": "1", **more}


def test_a_line_sent_again_hours_later_does_not_double(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    batches = [[claim("1"), claim("2"), claim("2"), claim(None)], [claim("1"), claim("3")], [claim("2"), claim("1"), claim(None)], [claim("3", charge_amt="99.00")]]
    for rows in batches:
        raw_frame(spark, rows).write.mode("append").parquet(bronze)
        silver_once(spark, bronze, silver, str(tmp_path / "reg"), str(tmp_path / "ck"), "1 minute", available_now=True, buckets=4).awaitTermination()
    got = sorted((str(r["claim_item_id"]), str(r["charge_amt"])) for r in read_silver(spark, silver).collect())
    assert got == [("1", "10.00"), ("2", "10.00"), ("3", "10.00"), ("None", "10.00"), ("None", "10.00")]
