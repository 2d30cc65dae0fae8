"""Streaming, incremental and change-feed properties."""

import os
import uuid

from pyspark.sql import functions as F

from claimlake.operators import star as G
from claimlake.plans.pipeline import silver_from_tables
from claimlake.session import checkpoint_dir
from claimlake.sources.fixture import raw_claims
from claimlake.streaming import incremental as I, stream as S
from conftest import SF_SMALL


def _tmp(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def test_stream_equals_batch_keyed(spark):
    """availableNow over JSON files (one batch delivered twice) = batch Silver
    with one row per claim_item_id."""
    work = _tmp(spark, "stream")
    raw = raw_claims(spark, SF_SMALL)
    raw.write.json(os.path.join(work, "in", "a"))
    raw.where(F.col("type") == "Medicare").write.json(os.path.join(work, "in", "b"))
    silver = spark.read.parquet(S.run_available_now(spark, os.path.join(work, "in", "*"), work))
    batch = silver_from_tables(spark, SF_SMALL)
    assert silver.count() == batch.select("claim_item_id").distinct().count()
    assert silver.select("claim_item_id").distinct().count() == silver.count()
    cols = ["claim_item_id", "charge_amt", "provider_npi", "is_valid"]
    assert silver.select(*cols).exceptAll(batch.select(*cols)).count() == 0


def test_incremental_twice_equals_full(spark):
    fact = G.fact_claims(silver_from_tables(spark, SF_SMALL)).drop("_loaded_at")
    path = _tmp(spark, "fact")
    I.upsert(spark, path, fact.where(F.col("service_month") < "2021-01"))
    I.upsert(spark, path, fact)
    I.upsert(spark, path, fact)  # a re-run changes nothing
    got = spark.read.schema(fact.schema).parquet(path)
    assert got.count() == fact.count()
    assert got.exceptAll(fact).count() == 0 and fact.exceptAll(got).count() == 0


def test_upsert_moves_changed_month(spark):
    schema = "claim_item_id long, received_date date, service_month string, v int"
    import datetime as dt
    path = _tmp(spark, "mv")
    I.upsert(spark, path, spark.createDataFrame([(1, dt.date(2021, 1, 5), "2021-01", 1),
                                                 (2, dt.date(2021, 1, 6), "2021-01", 1)], schema))
    I.upsert(spark, path, spark.createDataFrame([(1, dt.date(2021, 2, 5), "2021-02", 2)], schema))
    got = spark.read.schema(schema).parquet(path).select("claim_item_id", "received_date", "service_month", "v")
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == [(1, dt.date(2021, 2, 5), "2021-02", 2), (2, dt.date(2021, 1, 6), "2021-01", 1)]


def test_literal_incremental_skips_older_rows(spark):
    import datetime as dt
    schema = "claim_item_id long, received_date date, service_month string, v int"
    path = _tmp(spark, "lit")
    I.upsert(spark, path, spark.createDataFrame([(1, dt.date(2021, 3, 1), "2021-03", 1)], schema))
    new = spark.createDataFrame([(2, dt.date(2021, 2, 1), "2021-02", 1), (3, dt.date(2021, 4, 1), "2021-04", 1)], schema)
    I.upsert(spark, path, new, mode="literal")
    assert sorted(r[0] for r in spark.read.schema(schema).parquet(path).collect()) == [1, 3]


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    changes = spark.createDataFrame([(2, "b2", "U", 1), (3, None, "D", 1), (4, "d", "I", 1), (4, "d2", "U", 2)],
                                    "k long, v string, op string, seq int")
    got = sorted(tuple(r) for r in I.apply_changes(target, changes, "k").collect())
    assert got == [(1, "a"), (2, "b2"), (4, "d2")]


def test_json_payload(spark):
    df = spark.createDataFrame([('{"claim_item_id": "7", "charge_amt": "1.50"}',)], "value string")
    r = S.json_payload(df).first()
    assert r.claim_item_id == "7" and r.charge_amt == "1.50" and r.type is None


def test_stream_silver_to_fact_upsert(spark):
    """foreachBatch upsert from streaming Silver equals the batch fact."""
    work = _tmp(spark, "s2f")
    silver = silver_from_tables(spark, SF_SMALL)
    silver.write.parquet(os.path.join(work, "silver"))
    q = S.silver_to_fact(spark, os.path.join(work, "silver"), os.path.join(work, "fact"),
                         os.path.join(work, "_ckpt"), available_now=True)
    q.awaitTermination()
    fact = G.fact_claims(silver).drop("_loaded_at")
    got = spark.read.schema(fact.schema).parquet(os.path.join(work, "fact")).select(*fact.columns)
    assert got.count() == fact.count()
    assert got.exceptAll(fact).count() == 0 and fact.exceptAll(got).count() == 0


def test_event_stream_keyed_dedup(spark):
    """Keyed dedup on event time over the driver's events table, each event
    delivered twice (two files), JSON properties parsed on the stream."""
    src = "/root/testdata/sf0.001/events.parquet"
    work = _tmp(spark, "events")
    events = spark.read.parquet(src)
    events.write.parquet(os.path.join(work, "in", "a"))
    events.write.parquet(os.path.join(work, "in", "b"))
    stream = spark.readStream.schema(events.schema).parquet(os.path.join(work, "in", "*"))
    parsed = stream.withColumn("props_map", F.from_json("props", "map<string,string>"))
    q = (S.dedup_stream(parsed, ["event_id"], "ts", "30 days")
         .writeStream.format("parquet").option("checkpointLocation", os.path.join(work, "_ckpt"))
         .trigger(availableNow=True).start(os.path.join(work, "out")))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(work, "out"))
    assert out.count() == events.select("event_id").distinct().count()
