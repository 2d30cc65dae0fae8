"""Analyst queries Q1-Q18 over the reporting views.

Every window here runs over an already-aggregated view (one row per month,
state, procedure or lab), never over claim lines. Top-k queries sort with
unique tie-breakers (the view's group keys) so ``LIMIT`` is deterministic;
Spark plans ``orderBy().limit()`` as a per-partition top-k
(``TakeOrderedAndProject``), not a full sort. The share-of-total uses a
scalar subquery (computed once, no cross join and no single-partition
window over the detail rows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlake import functions as X
from claimlake.operators.star import Star
from claimlake.plans import views as V


def _asc(*cols) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _dec(c: str) -> Column:
    """A reported (2-place DOUBLE) value back to an exact DECIMAL."""
    return F.col(c).cast("decimal(20,2)")


# ---------------------------------------------------------------------- Q1
COUNTED_VIEWS = ["vw_financial_summary", "vw_monthly_costs", "vw_provider_kpis", "vw_covid19_tests",
                 "vw_network_impact", "vw_top_procedures", "vw_patient_activity",
                 "vw_geo_cost_variation"]


def view_row_counts(star: Star) -> DataFrame:
    """Q1: row count per key view, all from one pass over the fact.

    A view has as many rows as its lines have keys. The lines' keys are taken as three
    grouping sets of one aggregation (provider and month and network, code and month, patient), each
    with its number of lines; joined with the dimensions, every such key is spread to the views it
    is a row of, and counted once in each."""
    month = X.month_start(F.col("received_date"))
    lines = star.fact_claims.select("provider_npi", month.alias("month"), "in_network", "claim_code", "claimant_id")
    keys = lines.groupingSets([("provider_npi", "month", "in_network"), ("claim_code", "month"), ("claimant_id",)],
                              "provider_npi", "month", "in_network", "claim_code", "claimant_id").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("provider_npi").alias("_no_npi"), F.grouping("claim_code").alias("_no_code"))
    of_provider, of_code = F.col("_no_npi") == 0, F.col("_no_code") == 0
    # keys of the other sets have no provider (or code): spread, so that they do not meet in one task
    nowhere = F.concat(F.lit("\0"), F.pmod(F.xxhash64("claim_code", "claimant_id", "month"), F.lit(4096)).cast("string"))
    keys = keys.withColumns({"_npi": F.coalesce("provider_npi", nowhere), "_code": F.coalesce(F.when(of_code, F.col("claim_code")), nowhere)})
    provider = star.dim_provider.select(F.col("provider_npi").alias("_npi"), "provider_name", "city", "state", F.lit(True).alias("_npi_known"))
    procedure = star.dim_procedure.select(F.col("claim_code").alias("_code"), "procedure_desc", F.lit(True).alias("_code_known"))
    keys = keys.join(provider, "_npi", "left").join(procedure, "_code", "left")
    known, coded = of_provider & F.col("_npi_known").isNotNull(), of_code & F.col("_code_known").isNotNull()
    text = lambda *cols: [F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(cols)] + [F.lit(None).cast("string").alias(f"k{i}") for i in range(len(cols), 3)]
    row = lambda view, when, *cols: F.when(when, F.struct(F.lit(view).alias("view_name"), *text(*cols)))
    spread = F.array(
        row("vw_financial_summary", of_provider, "month"), row("vw_network_impact", of_provider, "in_network"),
        row("vw_monthly_costs", known, "month", "in_network", "state"), row("vw_provider_kpis", known, "provider_name", "city", "state"),
        row("vw_geo_cost_variation", known, "state"), row("vw_top_procedures", coded, "claim_code", "procedure_desc"),
        row("vw_covid19_tests", coded & F.col("claim_code").isin(V.COVID_CODES), "month", "claim_code", "procedure_desc"),
        row("vw_patient_activity", ~of_provider & ~of_code, "claimant_id"))
    rows = keys.select("n", F.explode(spread).alias("r")).where(F.col("r").isNotNull()).select("n", "r.*")
    per_key = rows.groupBy("view_name", "k0", "k1", "k2").agg(F.sum("n").alias("n"))
    least = F.when(F.col("view_name") == "vw_patient_activity", 2).when(F.col("view_name") == "vw_geo_cost_variation", V.LEAST_STATE_LINES + 1).otherwise(1)
    counts = per_key.where(F.col("n") >= least).groupBy("view_name").agg(F.count(F.lit(1)).alias("row_count"))
    names = star.fact_claims.sparkSession.createDataFrame([(n,) for n in COUNTED_VIEWS], "view_name string")
    return names.join(counts, "view_name", "left").select("view_name", F.coalesce("row_count", F.lit(0)).alias("row_count"))


# ------------------------------------------------------------------ Q2, Q3
def _by_month() -> Window:
    return Window.orderBy(F.col("month").asc_nulls_last())


def mom_growth(star: Star) -> DataFrame:
    """Q2: month-over-month revenue growth (LAG over the monthly view)."""
    fs = V.financial_summary(star)
    prev = F.lag("gross_revenue").over(_by_month())
    return fs.select("month", "gross_revenue", "net_revenue", "unique_patients",
                     prev.alias("previous_month_revenue"),
                     X.round2(X.money_ratio(F.col("gross_revenue") - prev, prev) * 100).alias("mom_growth_pct"))


def yearly_summary(star: Star) -> DataFrame:
    """Q3: sums by year over the monthly view (patients: sum of monthly distincts)."""
    fs = V.financial_summary(star)
    return (fs.groupBy(F.year("month").alias("year"))
              .agg(F.sum("gross_revenue").alias("ytd_gross_revenue"),
                   F.sum("net_revenue").alias("ytd_net_revenue"),
                   F.sum("unique_patients").alias("ytd_unique_patients"),
                   X.round2(X.exact_avg(_dec("discount_rate_pct"))).alias("avg_discount_rate")))


# ------------------------------------------------------------------ Q4, Q5
def covid_test_detail(star: Star) -> DataFrame:
    """Q4: COVID tests with the average charge per test."""
    t = V.covid19_tests(star)
    return t.select("month", "claim_code", "test_count", "total_charge", "total_allowed",
                    "avg_discount_per_test",
                    X.round2(X.money_avg(F.col("total_charge"), F.col("test_count"))).alias("avg_charge_per_test"))


def lab_market_share(star: Star, k: int = 20) -> DataFrame:
    """Q5: top labs by tests with their share of all COVID charges."""
    p = V.covid19_providers(star)
    total = p.select(F.sum("total_charged")).scalar()
    share = X.round2(X.money_ratio(F.col("total_charged"), total) * 100)
    top = p.orderBy(F.col("tests_performed").desc(), *_asc("provider_name", "state", "in_network",
                                                          "claim_code")).limit(k)
    return top.select("provider_name", "state", "in_network", "tests_performed", "total_charged",
                      share.alias("market_share_pct"))


# ------------------------------------------------------------------ Q6, Q7
def top_providers(star: Star, k: int = 20, min_claims: int = 10) -> DataFrame:
    """Q6: providers with at least ``min_claims`` lines, top by charges."""
    p = V.provider_kpis(star).where(F.col("total_claims") >= min_claims)
    top = p.orderBy(F.col("total_charged").desc(), *_asc("provider_name", "city", "state")).limit(k)
    return top.select("provider_name", "state", "total_claims", "total_charged", "avg_charge",
                      "in_network_pct",
                      X.round2(X.money_avg(F.col("total_charged"), F.col("total_claims"))).alias("revenue_per_claim"))


def states_by_providers(star: Star) -> DataFrame:
    """Q7: providers, claims and revenue per state."""
    p = V.provider_kpis(star)
    return (p.groupBy("state")
             .agg(F.count_distinct("provider_name").alias("provider_count"),
                  F.sum("total_claims").alias("total_claims"),
                  F.sum("total_charged").alias("total_revenue"),
                  F.round(F.avg("in_network_pct"), 2).alias("avg_in_network_pct")))


# ---------------------------------------------------------------------- Q8
def costly_rare_procedures(star: Star, k: int = 20) -> DataFrame:
    """Q8: 5..100 lines and an average charge above 500."""
    t = V.top_procedures(star)
    avg_c = X.money_avg(F.col("total_charges"), F.col("times_billed"))
    sel = t.where(F.col("times_billed").between(5, 100) & F.coalesce(avg_c > 500, F.lit(False)))
    out = sel.select("claim_code", "procedure_desc", "times_billed", "total_charges",
                     X.round2(avg_c).alias("avg_charge_per_claim"))
    return (out.orderBy(F.col("avg_charge_per_claim").desc(), *_asc("claim_code", "procedure_desc"))
               .limit(k).drop("claim_code"))


# ----------------------------------------------------------------- Q9, Q10
def state_comparison(star: Star, min_claims: int = 10) -> DataFrame:
    """Q9: states with a cost rank (window over one row per state)."""
    g = V.geo_cost_variation(star).where(F.col("claim_count") >= min_claims)
    ac, aa = _dec("avg_charge"), _dec("avg_allowed")
    return g.select("state", "claim_count", "avg_charge", "avg_allowed", "avg_discount",
                    X.round2(X.safe_ratio(ac - aa, ac) * 100).alias("discount_rate_pct"),
                    F.rank().over(Window.orderBy(F.col("avg_charge").desc())).cast("bigint").alias("cost_rank"))


# State -> region groups.
REGIONS = {
    "Northeast": ["NY", "NJ", "CT", "MA", "PA", "MD", "DC"],
    "West": ["CA", "WA", "OR", "NV", "AZ", "CO", "UT"],
    "South": ["TX", "FL", "GA", "NC", "SC", "VA", "TN"],
    "Midwest": ["IL", "OH", "MI", "IN", "WI", "MN", "MO"],
}


def region_of(state: Column) -> Column:
    expr = None
    for name, states in REGIONS.items():
        expr = (F.when(state.isin(states), F.lit(name)) if expr is None
                else expr.when(state.isin(states), F.lit(name)))
    return expr.otherwise(F.lit("Other"))


def region_summary(star: Star) -> DataFrame:
    """Q10: states grouped into regions."""
    g = V.geo_cost_variation(star)
    return (g.groupBy(region_of(F.col("state")).alias("region"))
             .agg(F.count_distinct("state").alias("state_count"),
                  F.sum("claim_count").alias("total_claims"),
                  X.round2(X.exact_avg(_dec("avg_charge"))).alias("avg_charge"),
                  X.round2(X.exact_avg(_dec("avg_discount"))).alias("avg_discount")))


# ------------------------------------------------------------ Q11, Q12, Q13
def extreme_discounts(star: Star, k: int = 50, threshold: float = 70) -> DataFrame:
    """Q11: discounts above ``threshold`` %, largest first."""
    h = V.high_discount_alerts(star).where(F.col("discount_pct") > threshold)
    cols = ["procedure_desc", "charge_amt", "allowed_amt", "discount_amt", "discount_pct",
            "provider_name", "received_date"]
    return (h.orderBy(F.col("discount_pct").desc(), *_asc("claim_item_id", *cols)).limit(k)
             .select(*cols))


def zero_allowed_list(star: Star, k: int = 50) -> DataFrame:
    """Q12: largest zero-allowed lines."""
    z = V.zero_allowed_audit(star)
    cols = ["procedure_desc", "charge_amt", "allowed_amt", "provider_name", "received_date", "in_network"]
    return (z.orderBy(F.col("charge_amt").desc(), *_asc("claim_item_id", *cols)).limit(k)
             .select(*cols))


def duplicate_list(star: Star, k: int = 100) -> DataFrame:
    """Q13: most repeated 4-column keys."""
    d = V.duplicate_suspicions(star).where(F.col("duplicate_count") > 1)
    return (d.orderBy(F.col("duplicate_count").desc(), F.col("charge_amt").desc(),
                      *_asc("claimant_id", "received_date", "claim_code")).limit(k)
             .select("claimant_id", "received_date", "claim_code", "charge_amt", "duplicate_count"))


# ----------------------------------------------------------------- Q14, Q15
def rolling_revenue(star: Star) -> DataFrame:
    """Q14: 3-month rolling mean and deviation from it."""
    fs = V.financial_summary(star)
    roll = F.avg("gross_revenue").over(_by_month().rowsBetween(-2, 0))
    return (fs.select("month", "gross_revenue", roll.alias("_roll"))
              .select("month", "gross_revenue", X.round2(F.col("_roll")).alias("rolling_3m_avg"),
                      X.round2(F.col("gross_revenue") - F.col("_roll")).alias("deviation_from_avg")))


def same_month_by_year_literal(star: Star, years=(2020, 2021, 2022)) -> DataFrame:
    """Q15 as written: grouped by month, year and revenue itself, so one row
    per month and year with the other years' columns NULL."""
    fs = V.financial_summary(star)
    g = fs.select(F.month("month").alias("month_num"), F.year("month").alias("_y"),
                  "gross_revenue").distinct()
    return g.select("month_num", *[F.when(F.col("_y") == y, F.col("gross_revenue")).alias(f"revenue_{y}")
                                   for y in years])


def same_month_by_year_pivot(star: Star, years=(2020, 2021, 2022)) -> DataFrame:
    """Q15 as intended: one row per month number, one column per year."""
    fs = V.financial_summary(star).where(F.col("month").isNotNull())
    return (fs.withColumn("_y", F.year("month"))
              .groupBy(F.month("month").alias("month_num"))
              .pivot("_y", list(years)).agg(F.sum("gross_revenue"))
              .select("month_num", *[F.col(str(y)).alias(f"revenue_{y}") for y in years]))


# ----------------------------------------------------------------- Q16, Q17
def patient_distribution(star: Star, approx: bool = False) -> DataFrame:
    """Q16: percentiles of lines per patient, mean and deviation of spend.

    ``percentile`` keeps a count per distinct value, so its buffer grows
    with the number of distinct line counts, not with patients;
    ``approx=True`` uses ``percentile_approx`` (a fixed-size sketch)."""
    p = V.patient_activity(star)
    pct = ((lambda c, q: F.percentile_approx(c, q).cast("double")) if approx
           else (lambda c, q: F.percentile(c, q)))
    return p.agg(*[pct("total_claims", q).alias(n) for q, n in
                   [(0.25, "p25_claims"), (0.5, "median_claims"), (0.75, "p75_claims"),
                    (0.9, "p90_claims")]],
                 X.round2(X.exact_avg(F.col("total_patient_charges"))).alias("avg_spending"),
                 F.round(F.stddev("total_patient_charges"), 2).alias("stddev_spending"))


def patient_cohorts(star: Star) -> DataFrame:
    """Q17: new patients and mean lifetime value by first month."""
    p = V.patient_activity(star)
    return (p.groupBy(X.month_start(F.col("first_service_date")).alias("cohort_month"))
             .agg(F.count(F.lit(1)).alias("new_patients"),
                  X.round2(X.exact_avg(F.col("total_patient_charges"))).alias("avg_lifetime_value")))


# ---------------------------------------------------------------------- Q18
def sample_view(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """First ``n`` rows of a view in its defined order."""
    return df.orderBy(*order).limit(n)


def sample_financial_summary(star: Star, n: int = 5) -> DataFrame:
    return sample_view(V.financial_summary(star), [F.col("month").desc_nulls_last()], n)


def sample_monthly_costs(star: Star, n: int = 5) -> DataFrame:
    return sample_view(V.monthly_costs(star), [F.col("month").desc_nulls_last(), *_asc("state", "in_network")], n)


def sample_provider_kpis(star: Star, n: int = 5) -> DataFrame:
    return sample_view(V.provider_kpis(star), [F.col("total_claims").desc(), *_asc("provider_name", "city", "state")], n)


def sample_top_procedures(star: Star, n: int = 5) -> DataFrame:
    return sample_view(V.top_procedures(star),
                       [F.col("times_billed").desc(), F.col("claim_code").asc_nulls_last(),
                        F.col("procedure_desc").asc_nulls_last()], n)
