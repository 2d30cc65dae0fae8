"""Marts that follow their fact by deltas (S19; V1 and V2).

The marts' measures are counts and exact sums, so a changed line is corrected by taking its old image
away and adding its new one. Partial measures are kept per (service month, provider, network flag) as
runs in a bucket for each month (``streaming.runs``): a batch adds its signed partials to the months it
touches, the monthly mart is written anew for these months only, and the provider mart, which
spans all months, from the partials. No line of the fact beyond the batch's images is read.

Provider attributes are joined when a mart is written; if a provider's attributes change, ``refresh`` writes
all months from the partials.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimlake import functions as X
from claimlake.plans import views as V
from claimlake.sources import writers as W
from claimlake.sources.readers import _folder, partition_folders
from claimlake.streaming.incremental import merge_batch
from claimlake.streaming.runs import MOST_RUNS, Runs

KEY = ["service_month", "provider_npi", "in_network"]
#: measure -> the count of lines that have it: without such lines the sum is NULL, not 0
SUMS = {"_charge": "_n_charge", "_allowed": "_n_allowed", "_discount": "_n_discount", "_ratio": "_n_ratio"}
COUNTS = ["_n", "_n_id", *SUMS.values(), "_n_in"]
#: The bucket of lines without a date.
NO_MONTH = "none"


def _signed(c: Column) -> Column:
    return F.when(F.col("_sign") < 0, -c).otherwise(c)


def partials(changes: DataFrame) -> DataFrame:
    """Signed partial measures of changed fact lines; lines without a provider are in no mart."""
    lines = changes.where(F.col("provider_npi").isNotNull())
    values = {"_charge": F.col("charge_amt"), "_allowed": F.col("allowed_amt"), "_discount": F.col("discount_amt"), "_ratio": X.safe_ratio(F.col("discount_amt"), F.col("charge_amt"))}
    one = lambda held: F.sum(F.when(held, F.col("_sign")).otherwise(0)).cast("long")
    counts = {"_n": one(F.lit(True)), "_n_id": one(F.col("claim_item_id").isNotNull()), "_n_in": one(F.coalesce(F.col("in_network"), F.lit(False)))}
    counts |= {SUMS[k]: one(v.isNotNull()) for k, v in values.items()}
    sums = {k: F.coalesce(F.sum(_signed(v)), F.lit(0).cast("decimal(38,2)")) for k, v in values.items()}
    sums["_ratio"] = F.coalesce(F.sum(_signed(values["_ratio"])), F.lit(0)).cast("decimal(38,18)")
    sums |= {k: sums[k].cast("decimal(38,2)") for k in ("_charge", "_allowed", "_discount")}
    return lines.groupBy(*KEY).agg(*[c.alias(k) for k, c in (counts | sums).items()])


def _delta(changes: DataFrame) -> DataFrame:
    return partials(changes).select(*_SCHEMA.names)


_TYPES = {k: T.LongType() for k in COUNTS} | {k: T.DecimalType(38, 2) for k in SUMS} | {"_ratio": T.DecimalType(38, 18)}
_SCHEMA = T.StructType([T.StructField("service_month", T.StringType()), T.StructField("provider_npi", T.StringType()), T.StructField("in_network", T.BooleanType()),
                        *[T.StructField(c, t) for c, t in _TYPES.items()]])


class MartStore:
    """``monthly_costs`` (V1, partitioned by service month) and ``provider_kpis`` (V2) under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        merge = lambda: [F.sum(c).cast(t).alias(c) for c, t in _TYPES.items()]
        self.runs = Runs(spark, os.path.join(path, "partials"), _SCHEMA, KEY, merge, bucket=F.coalesce(F.col("service_month"), F.lit(NO_MONTH)))

    def _table(self, name: str) -> str:
        return os.path.join(self.path, name)

    def _joined(self, dim_provider: DataFrame, months: list[str] | None = None) -> DataFrame:
        rows = self.runs.read(months).where(F.col("_n") > 0)
        rows = rows.withColumns({k: F.when(F.col(n) > 0, F.col(k)) for k, n in SUMS.items()})
        rows = rows.withColumn("month", F.to_date(F.concat("service_month", F.lit("-01"))))
        return rows.join(dim_provider.drop("_loaded_at"), "provider_npi")

    def _write(self, dim_provider: DataFrame, months: list[str] | None) -> None:
        costs = V.monthly_costs_of(self._joined(dim_provider, months)).withColumn("service_month", F.coalesce(X.service_month(F.col("month")), F.lit(NO_MONTH)))
        path = self._table("monthly_costs")
        (costs.hint("rebalance", "service_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if months is not None else "static")
         .partitionBy("service_month").parquet(path))
        if months:
            held = self.runs.read(months).where(F.col("_n") > 0)
            left = {r[0] or NO_MONTH for r in held.select("service_month").distinct().collect()}  # of the touched months
            for month, folder in partition_folders(self.spark, path, "service_month").items():
                if month in set(months) - left:  # the batch took its last line
                    fs, p = _folder(self.spark, folder)
                    fs.delete(p, True)
        W.write_table(V.provider_kpis_of(self._joined(dim_provider)), self._table("provider_kpis"))

    def apply(self, changes: DataFrame, dim_provider: DataFrame, batch: str, most: int = MOST_RUNS) -> list[str]:
        """Takes in a batch's changed lines, or the partials of these as ``follow`` wrote them; returns the
        months written. Batches are named in the order they come; one sent again replaces its own partials."""
        delta = changes
        if changes.columns != _SCHEMA.names:
            delta = self.spark.read.schema(_SCHEMA).parquet(W.write_table(_delta(changes), os.path.join(self.path, "deltas", batch)))
        months = self.runs.touched(delta)
        if months:
            self.runs.append(delta, batch)
            self._write(dim_provider, months)
            self.runs.compact(most, before=batch)
        return sorted(months)

    def refresh(self, dim_provider: DataFrame) -> None:
        """Writes all months anew from the partials."""
        self._write(dim_provider, None)

    def follow(self, fact_path: str, batch_rows: DataFrame, dim_provider: DataFrame, batch: str, **merge) -> list[str]:
        """Merges a batch into the fact at ``fact_path`` and its changes into the marts; of the changed
        lines only the partials are kept. A batch that ended on the way may be sent again under its name."""
        done = merge_batch(self.spark, fact_path, batch_rows, images=os.path.join(self.path, "images", batch), image_of=_delta, **merge)
        return self.apply(done.changes, dim_provider, batch)

    def monthly_costs(self) -> DataFrame:
        return self.spark.read.parquet(self._table("monthly_costs")).drop("service_month")

    def provider_kpis(self) -> DataFrame:
        return self.spark.read.parquet(self._table("provider_kpis"))
