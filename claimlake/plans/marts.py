"""Notebook marts and metrics (M1-M7) over the ``notebook``-profile Silver.

pandas semantics that differ from SQL are made explicit: NULL group keys are
dropped (pandas ``groupby``), sums over no values are 0, and means of
two-place percentages are computed exactly and rounded to two places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimlake import functions as X
from claimlake.operators import quality as Q, star as G
from claimlake.operators.quantiles import quantiles
from claimlake.schema import DIAG_COLUMNS

# Fixed value: number of equal-width bins of the discount histogram.
HISTOGRAM_BINS = 30


def _zero_sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("decimal(22,2)"))


def _mean_pct(c: str) -> Column:
    """Mean of a two-place percentage, exact, rounded to two places."""
    return X.round2(X.exact_avg(F.col(c).cast("decimal(10,2)")))


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def monthly_summary(items: DataFrame) -> DataFrame:
    """M1: (year_month, claim_type) -> claims, patients, money, mean discount %, in-network %."""
    keyed = items.withColumn("year_month", year_month(F.col("received_date")))
    keyed = keyed.where(F.col("year_month").isNotNull() & F.col("claim_type").isNotNull())
    return (keyed.groupBy("year_month", "claim_type")
                 .agg(F.count("claim_item_id").alias("total_claims"),
                      F.count_distinct("claimant_id").alias("unique_patients"),
                      _zero_sum("charge_amt").alias("total_charged"),
                      _zero_sum("allowed_amt").alias("total_allowed"),
                      _zero_sum("discount_amt").alias("total_discount"),
                      _mean_pct("discount_pct").alias("avg_discount_pct"),
                      X.pct_of(F.sum(F.col("in_network_flag").cast("int")), F.count(F.lit(1)))
                      .alias("in_network_percentage")))


def provider_summary(items: DataFrame) -> DataFrame:
    """M2: per NPI (NULL dropped) -> claims, patients, money, mean discount %."""
    return (items.where(F.col("provider_npi").isNotNull())
                 .groupBy("provider_npi")
                 .agg(F.count("claim_item_id").alias("total_claims"),
                      F.count_distinct("claimant_id").alias("unique_patients"),
                      _zero_sum("charge_amt").alias("total_charged"),
                      _zero_sum("allowed_amt").alias("total_allowed"),
                      _mean_pct("discount_pct").alias("avg_discount_pct")))


def diagnosis_summary(silver_nb: DataFrame, k: int = 20) -> DataFrame:
    """M3: most frequent (code, rank) pairs of the diagnosis bridge."""
    b = G.bridge_diagnosis(silver_nb)
    freq = b.groupBy("icd10_code", "diag_rank").agg(F.count(F.lit(1)).alias("frequency"))
    return freq.orderBy(F.col("frequency").desc(), "icd10_code", "diag_rank").limit(k)


def key_metrics(items: DataFrame) -> DataFrame:
    """M4: six headline metrics in long form (metric, value)."""
    one = items.agg(
        _zero_sum("allowed_amt").alias("total_allowed"),
        F.count(F.lit(1)).alias("total_claims"),
        F.count_distinct("claimant_id").alias("unique_patients"),
        F.count_distinct("claim_type").alias("unique_claim_types"),
        F.sum(F.col("in_network_flag").cast("int")).alias("_n_in"))
    wide = one.select(
        F.col("total_allowed").cast("double").alias("total_allowed_amount"),
        F.col("total_claims").cast("double").alias("total_claims_processed"),
        X.round2(X.money_avg(F.col("total_allowed"), F.col("total_claims"))).alias("average_claim_value"),
        X.round2(F.try_divide(F.col("_n_in") * F.lit(100.0).cast("decimal(4,1)"), F.col("total_claims")))
        .alias("in_network_rate"),
        F.col("unique_patients").cast("double").alias("unique_patients"),
        F.col("unique_claim_types").cast("double").alias("unique_claim_types"))
    names = wide.columns
    return wide.unpivot([], names, "metric", "value")


def monthly_type_pivot(items: DataFrame, claim_types: list[str]) -> DataFrame:
    """year_month x claim type of total allowed (chart data): a column for each type
    asked for and ``allowed_other`` for all types that are not, so that none is lost.
    The columns are the caller's, not the data's: no pass to find them, no limit."""
    m = monthly_summary(items).where(F.col("claim_type").isNotNull())
    shown = F.when(F.col("claim_type").isin(claim_types), F.col("claim_type"))
    sums = [F.sum(F.when(shown == t, F.col("total_allowed"))).alias(f"allowed_{t.lower()}") for t in claim_types]
    return m.groupBy("year_month").agg(*sums, F.sum(F.when(shown.isNull(), F.col("total_allowed"))).alias("allowed_other"))


def top_providers_by_allowed(items: DataFrame, k: int = 10) -> DataFrame:
    """``nlargest(k)`` providers by allowed amount."""
    return provider_summary(items).orderBy(F.col("total_allowed").desc(), "provider_npi").limit(k)


def discount_histogram(items: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of positive discount %.

    Bounds come from a scalar subquery (one global min/max), then one
    grouped count: no per-row Python, no collect."""
    pos = items.where(F.col("discount_pct") > 0).select("discount_pct")
    bounds = pos.agg(F.min("discount_pct").alias("lo"), F.max("discount_pct").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    raw_bin = F.floor((F.col("discount_pct") - lo) * F.lit(float(bins)) / (hi - lo))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw_bin, F.lit(bins - 1))).cast("int")
    return (pos.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("frequency"))
               .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                       (lo + (F.col("bin") + 1) * width).alias("bin_end"), "frequency"))


def discount_stats(items: DataFrame) -> DataFrame:
    """Mean and median of positive discount % (chart reference lines)."""
    pos = items.where(F.col("discount_pct") > 0)
    return pos.agg(_mean_pct("discount_pct").alias("mean_discount_pct"),
                   F.round(F.percentile("discount_pct", 0.5), 2).alias("median_discount_pct"),
                   F.count(F.lit(1)).alias("positive_discount_lines"))


# The shares reported for amounts.
AMOUNT_SHARES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}


def amount_quantiles(items: DataFrame, columns: tuple[str, ...] = ("charge_amt", "allowed_amt", "discount_amt")) -> DataFrame:
    """Exact quartiles and upper percentiles of amounts, by histogram refinement: an amount has
    about as many values as there are lines, too many for one ``percentile`` buffer."""
    rows = [(c, *quantiles(items, c, list(AMOUNT_SHARES.values()))) for c in columns]
    return items.sparkSession.createDataFrame(rows, "column_name string, " + ", ".join(f"{n} double" for n in AMOUNT_SHARES))


def discount_quantiles(items: DataFrame) -> DataFrame:
    """The same for positive discount %, which has two places."""
    pos = items.where(F.col("discount_pct") > 0)
    row = ("discount_pct", *quantiles(pos, "discount_pct", list(AMOUNT_SHARES.values()), scale=2))
    return items.sparkSession.createDataFrame([row], "column_name string, " + ", ".join(f"{n} double" for n in AMOUNT_SHARES))


def claim_type_share(items: DataFrame) -> DataFrame:
    """M5d / A11: ``value_counts`` of claim type with its share of lines."""
    counts = items.where(F.col("claim_type").isNotNull()).groupBy("claim_type").agg(
        F.count(F.lit(1)).alias("claims"))
    total = items.where(F.col("claim_type").isNotNull()).select(F.count(F.lit(1))).scalar()
    return counts.withColumn("share_pct", X.round2(F.col("claims") * F.lit(100.0).cast("decimal(4,1)") / total))


def pipeline_summary(raw: DataFrame, silver_nb: DataFrame) -> DataFrame:
    """M6: row counts per layer and table. The lines are read twice: raw, for raw and Bronze, and Silver for all
    that is made of it. Tables of distinct keys have as many rows as the lines have keys, taken as
    grouping sets of one aggregation; lines and diagnoses add up over the same keys."""
    items = G.fact_claim_items(silver_nb)
    empty = items.limit(0)
    provider = ["provider_npi", "service_provider", "provider_street", "city", "state"]
    month = year_month(F.col("received_date"))
    codes = reduce(lambda a, b: a + b, [F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in DIAG_COLUMNS])
    lines = silver_nb.select(*provider, month.alias("_month"), "claim_type", codes.alias("_codes"))
    sets = [provider, ["_month", "claim_type"], ["provider_npi"]]
    keys = lines.groupingSets(sets, *provider, "_month", "claim_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_codes").alias("_codes"), F.grouping("_month").alias("_no_month"), F.grouping("city").alias("_no_city"))
    of_month, of_provider = F.col("_no_month") == 0, F.col("_no_city") == 0
    of_npi = ~of_month & ~of_provider
    has_npi = F.col("provider_npi").isNotNull()
    known = {"silver": {"fact_claim_items": F.sum(F.when(of_month, F.col("n"))), "dim_provider": F.count(F.when(of_provider & has_npi, 1)),
                        "bridge_diagnosis": F.sum(F.when(of_month, F.col("_codes")))},
             "gold": {"monthly_summary": F.count(F.when(of_month & F.col("_month").isNotNull() & F.col("claim_type").isNotNull(), 1)),
                      "provider_summary": F.count(F.when(of_npi & has_npi, 1))}}
    widths = {"fact_claim_items": len(items.columns), "dim_provider": len(provider), "bridge_diagnosis": len(G.bridge_diagnosis(silver_nb).columns),
              "monthly_summary": len(monthly_summary(empty).columns), "provider_summary": len(provider_summary(empty).columns)}
    one = keys.agg(*[F.coalesce(c, F.lit(0)).alias(t) for tables in known.values() for t, c in tables.items()])
    line = lambda layer, table, value, width: F.struct(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), value.cast("long").alias("rows"), F.lit(width).alias("columns"))
    made = Q._long(one, [line(layer, t, F.col(t), widths[t]) for layer, tables in known.items() for t in tables])
    return Q._long(raw.agg(F.count(F.lit(1)).alias("n")), [line(x, "claims", F.col("n"), len(raw.columns)) for x in ("raw", "bronze")]).unionByName(made)


def payer_mix(fact: DataFrame, remittance_long: DataFrame | None = None) -> DataFrame:
    """M7: payer mix (share of lines and charges) and net reimbursement
    (charges - contractual adjustments) per payer; adjustment-code rows are
    rolled up per claim before the join so charges never fan out."""
    f = fact
    if remittance_long is not None:
        per_claim = (remittance_long.groupBy("claim_id")
                     .agg(F.count(F.lit(1)).alias("adjustment_codes"))
                     .withColumnRenamed("claim_id", "claim_item_id"))
        f = f.join(per_claim, "claim_item_id", "left")
    else:
        f = f.withColumn("adjustment_codes", F.lit(None).cast("bigint"))
    totals = fact.agg(F.count(F.lit(1)).alias("n"), F.sum("charge_amt").alias("c"))
    n_all, c_all = totals.select("n").scalar(), totals.select("c").scalar()
    g = (f.groupBy("payer_name")
          .agg(F.count(F.lit(1)).alias("total_claims"),
               F.sum("charge_amt").alias("total_charges"),
               F.sum("discount_amt").alias("total_adjustments"),
               F.coalesce(F.sum("adjustment_codes"), F.lit(0)).alias("adjustment_codes")))
    return g.select(
        "payer_name", "total_claims",
        X.round2(F.col("total_claims") * F.lit(100.0).cast("decimal(4,1)") / n_all).alias("claim_share_pct"),
        "total_charges",
        X.round2(X.money_ratio(F.col("total_charges"), c_all) * 100).alias("charge_share_pct"),
        "total_adjustments",
        (F.col("total_charges") - F.col("total_adjustments")).alias("net_reimbursement"),
        "adjustment_codes")
