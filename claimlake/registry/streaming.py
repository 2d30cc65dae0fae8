"""Incremental, change-feed and streaming jobs (T1-T6): Spark builders and
DuckDB oracles. Each job runs end to end over data derived from the driver
tables, writes under the shared checkpoint folder and returns what it wrote.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from claimlake import oracle as O
from claimlake.operators import star as G
from claimlake.operators.cleaning import select_available
from claimlake.plans.mart_deltas import MartStore
from claimlake.plans.pipeline import run, silver_from_tables
from claimlake.registry import register, select_typed, written_once
from claimlake.registry.gold import SILVER_COLS
from claimlake.registry.views import VIEW_ORACLES
from claimlake.schema import RAW_COLUMNS, RAW_SCHEMA
from claimlake.session import checkpoint_dir, give_up_shuffles
from claimlake.sources import writers as W
from claimlake.sources.fixture import raw_claims
from claimlake.sources.readers import read_latest, read_layer
from claimlake.streaming import incremental as I, stream as S
from claimlake.streaming.changes import ChangeTable
from claimlake.streaming.register import KeyRegister, batch_name, read_silver, silver_once

FACT_SPEC = ("claim_item_id, claimant_id, provider_npi, payer_name, claim_code, service_date_key, charge_amt:D, "
             "allowed_amt:D, discount_amt:D, units, in_network, received_date, claim_status, service_month")


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _written(spark, df: DataFrame, path: str) -> DataFrame:
    """``df``, written once and read back: batches cut from it do not derive it anew."""
    df.write.option("compression", "zstd").parquet(path)
    give_up_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


@register("incremental_fact_claims", O.query(select_typed("fact_claims", FACT_SPEC), ["fact_claims"]))
def _incremental(spark, sf_dir):
    """T4 / T5: first half of the months, then every line (overlapping keys
    replace, touched months rewritten); the result must equal a full build."""
    fact = _written(spark, G.fact_claims(silver_from_tables(spark, sf_dir)), _scratch(spark, "lines"))
    path = _scratch(spark, "fact_claims")
    I.upsert(spark, path, fact.where(F.col("service_month") < "2021-07"))
    I.upsert(spark, path, fact)
    return spark.read.schema(fact.schema).parquet(path).drop("_loaded_at")


O.cte("moved_claims", """
SELECT * REPLACE (CASE WHEN service_month = '2020-03' THEN CAST(received_date + INTERVAL 1 MONTH AS DATE) ELSE received_date END AS received_date,
                  CASE WHEN service_month = '2020-03' THEN '2020-04' ELSE service_month END AS service_month,
                  CASE WHEN service_month = '2020-03' THEN CAST(strftime(received_date + INTERVAL 1 MONTH, '%Y%m%d') AS INT)
                       ELSE service_date_key END AS service_date_key)
FROM fact_claims""", ["fact_claims"])


@register("incremental_moved_month", O.query(select_typed("moved_claims", FACT_SPEC), ["moved_claims"]))
def _moved(spark, sf_dir):
    """T5: a batch that dates every claim of a month to the next one, sent twice: the old
    month's partition goes, no claim stands twice."""
    fact = _written(spark, G.fact_claims(silver_from_tables(spark, sf_dir)).drop("_loaded_at"), _scratch(spark, "lines"))
    path = _scratch(spark, "fact_claims")
    I.upsert(spark, path, fact)
    later = F.add_months("received_date", 1)
    moved = fact.where(F.col("service_month") == "2020-03").withColumns(
        {"received_date": later, "service_month": F.lit("2020-04"), "service_date_key": F.date_format(later, "yyyyMMdd").cast("int")})
    I.upsert(spark, path, moved)
    I.upsert(spark, path, moved)
    return spark.read.schema(fact.schema).parquet(path)


O.cte("batch_counts", """
SELECT 'bronze' AS layer, (SELECT COUNT(*) FROM raw) + (SELECT COUNT(*) FROM raw WHERE type = 'Medicare') AS row_count
UNION ALL SELECT 'silver', COUNT(*) FROM silver UNION ALL SELECT 'fact_claims', COUNT(*) FROM fact_claims
UNION ALL SELECT 'fact_remittance', COUNT(*) FROM fact_remittance UNION ALL SELECT 'dim_member', COUNT(*) FROM dim_member
UNION ALL SELECT 'dim_provider', COUNT(*) FROM dim_provider""",
      ["raw", "silver", "fact_claims", "fact_remittance", "dim_member", "dim_provider"])


@register("pipeline_two_batches", O.query(select_typed("batch_counts", "layer, row_count:B"), ["batch_counts"]))
def _two_batches(spark, sf_dir):
    """All lines at noon, the Medicare lines in the evening of the
    same day, then the noon batch again: Bronze keeps both batches, Silver and
    Gold hold the last one only."""
    out = _scratch(spark, "batches")
    raw = written_once(raw_claims(spark, sf_dir), "raw")
    give_up_shuffles(spark)
    for lines, batch in ((raw, "20240101_120000"), (raw.where(F.col("type") == "Medicare"), "20240101_200000"), (raw, "20240101_120000")):
        run(spark, lines, out, batch_id=batch, silver_passes=4)
    tables = {"bronze": "bronze", "silver": "silver"} | {n: f"gold/{n}" for n in ("fact_claims", "fact_remittance", "dim_member", "dim_provider")}
    counts = [spark.read.parquet(os.path.join(out, p)).agg(F.lit(n).alias("layer"), F.count(F.lit(1)).alias("row_count")) for n, p in tables.items()]
    return reduce(DataFrame.unionByName, counts)


#: Deliveries are packed; a packed file is read by one task.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


# ------------------------------------------------------------ change feed
def _changes(raw):
    """A change feed derived from the claims: Medicare lines re-sent with
    nothing allowed (seq 2); lines with unparseable units deleted (seq 3);
    Group lines without a network flag updated (seq 2) and then deleted (seq 3)."""
    upd = (raw.where((F.col("type") == "Medicare")
                     | ((F.col("type") == "Group") & F.col("oi_in_network").isNull()))
              .withColumns({"allowed_amt": F.lit("0.00"), "op": F.lit("U"), "seq": F.lit(2)}))
    dele = (raw.where((F.col("units") == "x")
                      | ((F.col("type") == "Group") & F.col("oi_in_network").isNull()))
               .withColumns({"op": F.lit("D"), "seq": F.lit(3)}))
    return upd.unionByName(dele)


_RAW = ", ".join(RAW_COLUMNS)
_RAW_UPD = _RAW.replace("allowed_amt", "'0.00' AS allowed_amt")
O.cte("cdc_changes", f"""
SELECT {_RAW_UPD}, 'U' AS op, 2 AS seq FROM raw
  WHERE type = 'Medicare' OR (type = 'Group' AND oi_in_network IS NULL)
UNION ALL SELECT {_RAW}, 'D', 3 FROM raw WHERE units = 'x' OR (type = 'Group' AND oi_in_network IS NULL)""", ["raw"])
O.cte("cdc_last", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY claim_item_id ORDER BY seq DESC) AS rn FROM cdc_changes)
WHERE rn = 1""", ["cdc_changes"])
O.cte("cdc_applied", f"""
SELECT {_RAW} FROM raw WHERE claim_item_id NOT IN (SELECT claim_item_id FROM cdc_last)
UNION ALL
SELECT {_RAW} FROM cdc_last WHERE op <> 'D'""", ["raw", "cdc_last"])


@register("cdc_apply_claims", O.query(select_typed("cdc_applied", _RAW), ["cdc_applied"]))
def _cdc(spark, sf_dir):
    """Apply the change feed to the loaded claims."""
    raw = raw_claims(spark, sf_dir)
    return I.apply_changes(raw, _changes(raw), "claim_item_id").select(*RAW_COLUMNS)


@register("stream_cdc_claims", O.query(select_typed("cdc_applied", _RAW), ["cdc_applied"]))
def _stream_cdc(spark, sf_dir):
    """The change feed streamed as JSON files into the loaded claims, each file once."""
    work = _scratch(spark, "cdc")
    raw = raw_claims(spark, sf_dir)
    feed = os.path.join(work, "feed")
    table = ChangeTable(spark, os.path.join(work, "claims"), RAW_SCHEMA, "claim_item_id", buckets=8)
    table.load(raw)
    _changes(raw).write.options(**PACKED).json(feed)
    S.change_feed(spark, feed, table, os.path.join(work, "_ckpt"), available_now=True).awaitTermination()
    return table.current().select(*RAW_COLUMNS)


@register("stream_cdc_out_of_order", O.query(select_typed("cdc_applied", _RAW), ["cdc_applied"]))
def _stream_cdc_reversed(spark, sf_dir):
    """The same feed with the last changes delivered first, in micro-batches of their own, then
    all of it once more, and the loaded claims last of all."""
    work = _scratch(spark, "cdc_reversed")
    raw = raw_claims(spark, sf_dir)
    changes = _changes(raw)
    feed = os.path.join(work, "feed")
    table = ChangeTable(spark, os.path.join(work, "claims"), RAW_SCHEMA, "claim_item_id", buckets=8)
    for delivery, part in enumerate((changes.where("seq = 3"), changes.where("seq = 2"), changes)):
        part.write.options(**PACKED).json(os.path.join(feed, str(delivery)))
        S.change_feed(spark, os.path.join(feed, "*"), table, os.path.join(work, "_ckpt"), available_now=True).awaitTermination()
    table.load(raw)
    return table.current().select(*RAW_COLUMNS)


# -------------------------------------------------------------- streaming
@register("stream_silver_claims", O.query(select_typed(
    "silver_out", ", ".join(c + (":D" if c in ("charge_amt", "allowed_amt", "discount_amt") else "")
                            for c in SILVER_COLS)), ["silver_out"]))
def _stream(spark, sf_dir):
    """Claims delivered as JSON files (Medicare lines delivered twice),
    streamed to Bronze and on to Silver with keyed dedup; equals batch Silver."""
    work = _scratch(spark, "stream")
    src = os.path.join(work, "incoming")
    raw = raw_claims(spark, sf_dir)
    raw.write.mode("overwrite").options(**PACKED).json(os.path.join(src, "batch1"))
    raw.where(F.col("type") == "Medicare").write.mode("overwrite").options(**PACKED).json(os.path.join(src, "batch1_resent"))
    silver_dir = S.run_available_now(spark, os.path.join(src, "*"), work)
    return spark.read.parquet(silver_dir).select(*SILVER_COLS)


O.cte("raw_first", f"""
SELECT {_RAW} FROM raw
QUALIFY claim_item_id IS NULL OR row_number() OVER (PARTITION BY claim_item_id ORDER BY concat_ws(chr(31), {', '.join(f"COALESCE({c}, '')" for c in RAW_COLUMNS)})) = 1""", ["raw"])
O.cte("silver_first_lines", O.SILVER_LAMBDA.replace("FROM raw", "FROM raw_first"), ["raw_first"])
O.cte("silver_first", "SELECT *, CASE WHEN is_valid THEN 'PASS' ELSE 'FAIL' END AS _validation_status FROM silver_first_lines", ["silver_first_lines"])


@register("stream_silver_late", O.query(select_typed(
    "silver_first", ", ".join(c + (":D" if c in ("charge_amt", "allowed_amt", "discount_amt") else "")
                              for c in SILVER_COLS)), ["silver_first"]))
def _stream_late(spark, sf_dir):
    """All lines, then, in deliveries of their own and long after any watermark, the Medicare and
    the Group lines again: each line stands once in Silver."""
    work = _scratch(spark, "late")
    bronze, silver = os.path.join(work, "bronze"), os.path.join(work, "silver")
    raw = raw_claims(spark, sf_dir)
    for part in (raw, raw.where(F.col("type") == "Medicare"), raw.where(F.col("type") == "Group")):
        part.write.mode("append").option("compression", "zstd").parquet(bronze)
        silver_once(spark, bronze, silver, os.path.join(work, "register"), os.path.join(work, "_ckpt"), S.SILVER_INTERVAL, available_now=True, buckets=8).awaitTermination()
    return read_silver(spark, silver).select(*SILVER_COLS)


# ---------------------------------------------------------- key register
_DELIVERIES = """
SELECT claim_item_id, CASE WHEN claim_code LIKE 'U%' THEN 1 WHEN claim_code LIKE 'G%' THEN 2 ELSE 3 END AS batch FROM fact_claims
UNION ALL SELECT claim_item_id, 3 FROM fact_claims WHERE payer_name = 'Medicare'"""
O.cte("deliveries", _DELIVERIES, ["fact_claims"])
O.cte("uniqueness_by_batch", """
SELECT b.batch, COUNT(*) - COUNT(DISTINCT COALESCE(CAST(d.claim_item_id AS VARCHAR), '')) = 0 AS is_unique,
       COUNT(*) - COUNT(DISTINCT COALESCE(CAST(d.claim_item_id AS VARCHAR), '')) AS duplicate_count
FROM (SELECT DISTINCT batch FROM deliveries) b JOIN deliveries d ON d.batch <= b.batch GROUP BY b.batch""", ["deliveries"])


def deliveries(fact: DataFrame) -> list[DataFrame]:
    """Three batches of the fact's lines; the last one brings the Medicare lines once more."""
    code = F.col("claim_code")
    kind = F.when(code.startswith("U"), 1).when(code.startswith("G"), 2).otherwise(3)
    parts = [fact.where(kind == i) for i in (1, 2, 3)]
    return [*parts[:2], parts[2].unionByName(fact.where(F.col("payer_name") == "Medicare"))]


@register("dq_uniqueness_by_batch", O.query(select_typed("uniqueness_by_batch", "batch:I, is_unique, duplicate_count:B"), ["uniqueness_by_batch"]))
def _unique_by_batch(spark, sf_dir):
    """Uniqueness of the claim id after each of three batches, from the key register alone."""
    fact = G.fact_claims(silver_from_tables(spark, sf_dir)).select("claim_item_id", "claim_code", "payer_name")
    fact = written_once(fact, "lines")
    keys = KeyRegister(spark, _scratch(spark, "register"), buckets=8)
    reports = []
    for i, part in enumerate(deliveries(fact), 1):
        keys.add(part, "claim_item_id", batch_name(i), most=1)
        found = keys.report().first()
        reports.append((i, found["is_unique"], found["duplicate_count"]))
    return spark.createDataFrame(reports, "batch int, is_unique boolean, duplicate_count long")


# ------------------------------------------------------------- mart deltas
O.cte("changed_facts", """
SELECT fc.*, CAST(date_trunc('month', received_date) AS DATE) AS month, discount_amt / NULLIF(charge_amt, 0) AS ratio,
       CAST(COALESCE(in_network, false) AS INT) AS inside
FROM moved_claims fc WHERE payer_name IS DISTINCT FROM 'Medicare'""", ["moved_claims"])
for _view in ("vw_monthly_costs", "vw_provider_kpis"):
    _, (_body, _uses), _ = VIEW_ORACLES[_view]
    O.cte(f"{_view}_changed", _body.replace("line_facts l", "changed_facts l"), ["changed_facts" if u == "line_facts" else u for u in _uses])


def _marts_by_delta(spark, sf_dir) -> MartStore:
    """Three batches: the lines before 2021, all lines with those of March 2020 dated a month later,
    and the deletion of the Medicare lines."""
    silver = silver_from_tables(spark, sf_dir)
    work = _scratch(spark, "marts")
    fact = _written(spark, G.fact_claims(silver).drop("_loaded_at"), os.path.join(work, "lines"))
    providers = _written(spark, G.dim_provider(silver), os.path.join(work, "dim_provider"))
    marts, path = MartStore(spark, os.path.join(work, "marts")), os.path.join(work, "fact_claims")
    month, later = F.col("service_month") == "2020-03", F.add_months("received_date", 1)
    moved = fact.withColumns({"received_date": F.when(month, later).otherwise(F.col("received_date")),
                              "service_date_key": F.when(month, F.date_format(later, "yyyyMMdd").cast("int")).otherwise(F.col("service_date_key")),
                              "service_month": F.when(month, F.lit("2020-04")).otherwise(F.col("service_month"))})
    medicare = F.col("payer_name") == "Medicare"
    for i, (rows, gone) in enumerate(((fact.where(F.col("service_month") < "2021-01"), None), (moved, None), (moved.where(medicare), medicare))):
        marts.follow(path, rows, providers, batch_name(i), deleted=gone)
    return marts


@register("mart_monthly_costs_by_delta", O.query(select_typed("vw_monthly_costs_changed", VIEW_ORACLES["vw_monthly_costs"][2]), ["vw_monthly_costs_changed"]))
def _costs_by_delta(spark, sf_dir):
    """The monthly mart kept up by the changes of three batches."""
    return _marts_by_delta(spark, sf_dir).monthly_costs()


@register("mart_provider_kpis_by_delta", O.query(select_typed("vw_provider_kpis_changed", VIEW_ORACLES["vw_provider_kpis"][2]), ["vw_provider_kpis_changed"]))
def _kpis_by_delta(spark, sf_dir):
    """The provider mart kept up by the changes of three batches."""
    return _marts_by_delta(spark, sf_dir).provider_kpis()


# ------------------------------------------------------------ written layers
@register("layer_latest_run", O.query(f"SELECT {_RAW} FROM raw WHERE type = 'Group'", ["raw"]))
def _latest_run(spark, sf_dir):
    """Two runs in Bronze, the later one of the Group lines: the newest run is read."""
    path = _scratch(spark, "bronze")
    raw = raw_claims(spark, sf_dir)
    W.write_bronze(raw, path, "20240101_080000")
    W.write_bronze(raw.where(F.col("type") == "Group"), path, "20240101_200000")
    return read_latest(spark, path, schema=RAW_SCHEMA).select(*RAW_COLUMNS)


_STAGED = ("claim_item_id, claimant_id, claim_code, provider_npi, service_provider, city, state, type, charge_amt, allowed_amt, units, received_date, "
           "oi_in_network, proc_desc, claim_code_modifier, claim_code_modifier_2")


O.cte("declared", "SELECT *, CAST(NULL AS VARCHAR) AS note FROM staging_claims_q", ["staging_claims_q"])


@register("layer_declared_schema", O.query(select_typed("declared", _STAGED + ", note"), ["declared"]))
def _declared(spark, sf_dir):
    """The staged claims read with a declared schema, whose last column no file has."""
    path = W.write_table(W.stage(silver_from_tables(spark, sf_dir)), _scratch(spark, "staging"))
    return read_layer(spark, path, T.StructType([*W.STAGING_SCHEMA.fields, T.StructField("note", T.StringType())]))


@register("layer_insert_select", O.query(select_typed("staging_claims_q", _STAGED), ["staging_claims_q"]))
def _insert_select(spark, sf_dir):
    """A table of a declared schema, filled by two insert-selects of columns in another order."""
    path = _scratch(spark, "inserted")
    silver = silver_from_tables(spark, sf_dir)
    staged = W.stage(silver).select(*reversed(W.STAGING_SCHEMA.names))
    medicare = F.coalesce(F.col("type") == "Medicare", F.lit(False))
    W.insert_into(staged.where(medicare), W.STAGING_SCHEMA, path, mode="overwrite")
    W.insert_into(staged.where(~medicare), W.STAGING_SCHEMA, path)
    return read_layer(spark, path, W.STAGING_SCHEMA)


O.cte("literal_claims", """
SELECT * FROM fact_claims WHERE received_date < DATE '2021-03-05'
   OR received_date > (SELECT MAX(received_date) FROM fact_claims WHERE received_date < DATE '2021-03-05')""", ["fact_claims"])


@register("incremental_literal", O.query(select_typed("literal_claims", FACT_SPEC), ["literal_claims"]))
def _literal(spark, sf_dir):
    """As documented, a second load takes only lines received after the newest one there."""
    fact = _written(spark, G.fact_claims(silver_from_tables(spark, sf_dir)).drop("_loaded_at"), _scratch(spark, "lines"))
    path = _scratch(spark, "fact_claims")
    I.upsert(spark, path, fact.where(F.col("received_date") < "2021-03-05"))
    I.upsert(spark, path, fact, mode="literal")
    return spark.read.schema(fact.schema).parquet(path)


@register("json_payload_claims", O.query(f"SELECT {', '.join(RAW_COLUMNS[:8])} FROM raw", ["raw"]))
def _payload(spark, sf_dir):
    """Claims as JSON message values, parsed, and the columns of a list that are there."""
    raw = raw_claims(spark, sf_dir)
    parsed = S.json_payload(raw.select(F.to_json(F.struct(*RAW_COLUMNS)).alias("value")))
    return select_available(parsed, [*RAW_COLUMNS[:8], "no_such_column"])
