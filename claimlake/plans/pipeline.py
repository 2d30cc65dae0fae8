"""End-to-end medallion pipeline: raw -> Bronze -> Silver -> Gold.

``run`` is the batch job: each layer is written once (Parquet) and read back
by the next, so lineage is cut at every layer boundary and a lost executor
only recomputes from the last written layer. Gold tables are independent
writes over the written Silver; ``fact_claims`` is partitioned by
``service_month`` so month filters prune files.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from claimlake import functions as X
from claimlake.operators.cleaning import clean_claims, normalize_columns, require_columns
from claimlake.operators.star import Star, build_star
from claimlake.sources import writers as W
from claimlake.sources.fixture import raw_claims
from claimlake.session import give_up_shuffles
from claimlake.sources.readers import read_run

GOLD_PARTITIONS = {"fact_claims": ["service_month"]}


def silver_from_tables(spark: SparkSession, sf_dir: str, profile: str = "lambda",
                       batch_id: str | None = "fixture") -> DataFrame:
    """Silver built lazily from the driver tables through the claims fixture."""
    return clean_claims(raw_claims(spark, sf_dir), profile=profile, batch_id=batch_id)


def star_from_tables(spark: SparkSession, sf_dir: str, profile: str = "lambda") -> Star:
    """The Gold star as lazy DataFrames over the driver tables."""
    return build_star(silver_from_tables(spark, sf_dir, profile))


# Claim-keyed facts that can be co-located by claim id (bucketed layout).
CLAIM_KEYED = {"fact_claims": "claim_item_id", "fact_remittance": "claim_id"}


def read_star(spark: SparkSession, gold_dir: str, silver_path: str | None = None,
              table_prefix: str | None = None) -> Star:
    """Read a written Gold star back (partition pruning applies to fact_claims).
    With ``table_prefix``, the claim-keyed facts are read as the bucketed
    catalog tables written by ``run(bucket_claims=…)``."""
    def r(n):
        if table_prefix and n in CLAIM_KEYED:
            return spark.table(table_prefix + n)
        return spark.read.parquet(os.path.join(gold_dir, n))
    return Star(fact_claims=r("fact_claims"), fact_remittance=r("fact_remittance"),
                dim_member=r("dim_member"), dim_provider=r("dim_provider"),
                dim_payer=r("dim_payer"), dim_procedure=r("dim_procedure"),
                dim_date=r("dim_date"),
                silver=spark.read.parquet(silver_path) if silver_path else None)


def _observed(df: DataFrame, name: str):
    """Attach a row-count Observation: the count is collected while the
    write runs (no second pass over the data)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run(spark: SparkSession, raw: DataFrame, out_dir: str, profile: str = "lambda",
        batch_id: str | None = None, marts: bool = False, bucket_claims: int | None = None,
        table_prefix: str = "gold_", strict: bool = False, silver_passes: int = 1) -> DataFrame:
    """Bronze -> Silver -> Gold under ``out_dir``; returns a status table
    (table, status, rows) -- a failed table does not stop the others. Row
    counts come from Observations on the writes themselves (M6).

    Every batch keeps a Bronze partition of its own, named by the whole batch
    id; re-running a batch replaces it. Silver and Gold are rebuilt from the
    batch by static overwrites, dimensions before facts, so no table mixes runs.

    ``strict``: after all tables were tried, raise if one failed, instead of leaving it to the
    reader of the status.

    ``silver_passes``: Silver is written in so many passes over the batch, some months each, so that disks hold
    only their part of the shuffled lines at a time.

    ``bucket_claims=n`` also registers ``fact_claims`` and
    ``fact_remittance`` as catalog tables (``table_prefix`` + name) bucketed
    by claim id into ``n`` buckets, so their claim-id joins and per-claim
    rollups run without a shuffle."""
    batch_id = batch_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    bronze_path = os.path.join(out_dir, "bronze")
    silver_path = os.path.join(out_dir, "silver")
    gold_dir = os.path.join(out_dir, "gold")
    W.write_bronze(raw, bronze_path, batch_id)
    give_up_shuffles(spark)
    lines = require_columns(normalize_columns(read_run(spark, bronze_path, batch_id)))
    day = X.to_date_lenient(F.col("received_date"))
    lines = lines.withColumns({"year": F.year(day), "month": F.month(day)})
    rows, number = 0, F.coalesce(12 * F.col("year") + F.col("month"), F.lit(0))
    for i in range(silver_passes):
        part = lines.where(F.pmod(number, F.lit(silver_passes)) == i) if silver_passes > 1 else lines
        # dealt out by month as text, before cleaning adds columns
        part = clean_claims(W.clustered(part, ["year", "month"]), profile=profile, batch_id=batch_id)
        silver, silver_obs = _observed(part, f"silver {i}")
        W.write_silver(silver, silver_path, replace_all=i == 0, cluster=False)  # later passes write other months
        rows += silver_obs.get["rows"]
        give_up_shuffles(spark)
    status = [("silver", "SUCCESS", rows)]
    star = build_star(spark.read.parquet(silver_path))
    for name, df in star.tables().items():
        try:
            observed, obs = _observed(df, name)
            if bucket_claims and name in CLAIM_KEYED:
                W.write_bucketed(observed, table_prefix + name, CLAIM_KEYED[name], bucket_claims,
                                 os.path.join(gold_dir, name), GOLD_PARTITIONS.get(name))
            else:
                # Silver's files are of one month each
                W.write_table(observed, os.path.join(gold_dir, name), GOLD_PARTITIONS.get(name), cluster=False)
            status.append((name, "SUCCESS", obs.get["rows"]))
        except Exception as e:  # status per table, as the orchestrator reports
            status.append((name, f"ERROR: {e}", None))
    if marts:  # S19: materialised marts over the written Gold tables
        from claimlake.plans import views as V
        gold = read_star(spark, gold_dir)
        for name, fn in {"mart_monthly_costs": V.monthly_costs, "mart_provider_kpis": V.provider_kpis}.items():
            try:
                observed, obs = _observed(fn(gold), name)
                W.write_table(observed, os.path.join(out_dir, "marts", name))
                status.append((name, "SUCCESS", obs.get["rows"]))
            except Exception as e:
                status.append((name, f"ERROR: {e}", None))
    failed = [f"{name}: {said}" for name, said, _ in status if said != "SUCCESS"]
    if strict and failed:
        raise RuntimeError("tables failed: " + "; ".join(failed))
    return spark.createDataFrame(status, "table string, status string, rows long")
