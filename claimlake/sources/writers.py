"""Sinks: Bronze, Silver, quarantine, routed and Gold writes (S2, S6, S7,
S11-S16, S19).

All layer writes are idempotent per batch: a run-partitioned layer is
written with dynamic partition overwrite, so re-running a batch replaces its
own partition instead of duplicating it (a fresh timestamped file per run
would make the folder-wide readers count every claim twice).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F, types as T

from claimlake.operators import quality as Q
from claimlake.operators.dedup import quarantine


# Bound on rows per output file, so one huge partition value becomes many
# files written by many tasks instead of one giant file.
MAX_RECORDS_PER_FILE = 5_000_000
#: Of the files of all layers.
PACKING = "zstd"


def _dynamic(df: DataFrame):
    return (df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression=PACKING)
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE))


def _static(df: DataFrame):
    return df.write.mode("overwrite").options(partitionOverwriteMode="static", compression=PACKING)


def clustered(df: DataFrame, cols) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned write.

    A ``rebalance`` hint (not ``repartition``): rows of one partition value
    go to few tasks so each task opens few files, and AQE splits a value
    that is skewed (a month holding a third of the data) across many tasks
    instead of sending it all to one writer."""
    return df.hint("rebalance", *cols) if cols else df


def write_bronze(raw: DataFrame, path: str, run_date: str) -> str:
    """Raw rows unchanged (text) under ``run_date=<run>``, the whole batch id: a later
    batch of the same day stands beside it."""
    (_dynamic(raw.select([F.col(c).cast("string") for c in raw.columns])
              .withColumn("run_date", F.lit(run_date)))
     .partitionBy("run_date").parquet(path))
    return path


def write_silver(silver: DataFrame, path: str, partition_by=("year", "month"), replace_all: bool = False, cluster: bool = True) -> str:
    """Silver as Parquet, partitioned. By default only the
    partitions present in this batch are replaced (incremental batches);
    ``replace_all`` rewrites the whole table (a full rebuild). Rows are
    clustered by the partition columns first so each task writes few files;
    ``cluster=False``: they are already."""
    cols = list(partition_by or [])
    out = clustered(silver, cols) if cluster else silver
    w = _dynamic(out)
    if replace_all:
        w = w.option("partitionOverwriteMode", "static")
    (w.partitionBy(*cols) if cols else w).parquet(path)
    return path


def write_quarantine(df: DataFrame, path: str, keys=None) -> str:
    """Every member of a duplicated key to the audit folder."""
    q = quarantine(df, keys) if keys else quarantine(df)
    _static(q).parquet(path)
    return path


def write_routed(df: DataFrame, rules, path: str) -> str:
    """Pass and fail rows in one pass, as ``dq_route=pass`` and
    ``dq_route=quarantine`` partitions (no cache, no second scan)."""
    _static(Q.score_records(df, rules)).partitionBy("dq_route").parquet(path)
    return path


def write_table(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite", cluster: bool = True) -> str:
    """A Gold table, optionally partitioned. An overwrite replaces all of
    it, whatever the session's partition overwrite mode: no partition of an earlier
    run stays behind. ``cluster=False``: the rows come in the order of the partitions already, as
    from files that hold one of them each, and need no shuffle to get there."""
    cols = list(partition_by or [])
    out = clustered(df, cols) if cluster else df
    w = (out.write.mode(mode).options(partitionOverwriteMode="static", compression=PACKING)
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE))
    (w.partitionBy(*cols) if cols else w).parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str,
                   partition_by=None) -> str:
    """Write ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Two tables bucketed on their join key with the same bucket count are
    joined bucket-by-bucket: neither side is shuffled, and a per-key
    aggregate over a bucketed table needs no shuffle either. Data files go
    to ``path``; the table definition lives in the session catalog."""
    w = _static(df).option("path", path).bucketBy(buckets, key).sortBy(key)
    cols = list(partition_by or [])
    (w.partitionBy(*cols) if cols else w).saveAsTable(table)
    return table


def write_marts(views: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Materialise named marts (e.g. monthly costs, provider KPIs)."""
    return {name: write_table(df, os.path.join(out_dir, name)) for name, df in views.items()}


# The 16-column staging layout the Gold build reads.
STAGING_SCHEMA = T.StructType([
    T.StructField("claim_item_id", T.DecimalType(38, 0)), T.StructField("claimant_id", T.LongType()),
    T.StructField("claim_code", T.StringType()), T.StructField("provider_npi", T.StringType()),
    T.StructField("service_provider", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("charge_amt", T.DoubleType()), T.StructField("allowed_amt", T.DoubleType()),
    T.StructField("units", T.IntegerType()), T.StructField("received_date", T.StringType()),
    T.StructField("oi_in_network", T.StringType()), T.StructField("proc_desc", T.StringType()),
    T.StructField("claim_code_modifier", T.StringType()), T.StructField("claim_code_modifier_2", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema (by name, with casts);
    declared columns the input lacks become typed NULL."""
    cols = set(df.columns)
    return df.select([(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in schema.fields])


def stage(silver: DataFrame) -> DataFrame:
    """The staging projection (money as DOUBLE, date as 'yyyy-MM-dd' text)
    that gives a schema-on-read table a predictable layout."""
    return conform(silver.withColumn("received_date", F.date_format("received_date", "yyyy-MM-dd")),
                   STAGING_SCHEMA)


def insert_into(df: DataFrame, schema: T.StructType, path: str, partition_by=None, mode: str = "append") -> str:
    """Define-then-insert: conform to the declared schema, then write."""
    return write_table(conform(df, schema), path, partition_by, mode)
