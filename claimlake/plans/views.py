"""Reporting views V1-V19 over the Gold star.

Plan shape, chosen for a fact table far larger than any dimension:

* Views keyed by provider attributes first aggregate the fact by
  ``provider_npi`` (plus the fact's own keys) with partial + final hash
  aggregation, then join the provider dimension and re-aggregate. The big
  fact never shuffles for the join; only one row per (NPI, key) does, and a
  hot NPI is combined map-side. All measures are additive (counts and sums;
  averages are sum / count), so the result equals the join-then-aggregate
  form of the SQL, including the fan-out of an NPI with several dimension
  rows.
* No dimension gets a forced ``broadcast()`` unless its size is fixed
  (``dim_date``: one row per day of an 11-year spine). The others are
  distinct sets that grow with the data; AQE broadcasts them at runtime when
  their measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
  and keeps a shuffle join otherwise.
* Ratios and averages are computed in DECIMAL and rounded half-up before
  being reported as DOUBLE (``money.round2``).
* Views are unsorted; ordering happens in the analyst queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlake import functions as X
from claimlake.operators.star import Star

# Fixed value: a state is shown with more lines than this.
LEAST_STATE_LINES = 10
# Procedure codes treated as COVID-19 testing.
COVID_CODES = ["U0003", "U0004", "U0005", "87635", "87426", "G2023", "G2024"]


def _month() -> Column:
    return X.month_start(F.col("received_date")).alias("month")


def _ratio() -> Column:
    """discount / NULLIF(charge, 0) per line, DECIMAL."""
    return X.safe_ratio(F.col("discount_amt"), F.col("charge_amt"))


def _n_in() -> Column:
    return F.sum(F.when(F.col("in_network"), 1).otherwise(0))


def _partials(fact: DataFrame, keys: list) -> DataFrame:
    """Additive partial measures per (provider_npi, keys)."""
    return (fact.where(F.col("provider_npi").isNotNull())
                .groupBy("provider_npi", *keys)
                .agg(F.count(F.lit(1)).alias("_n"),
                     F.count("claim_item_id").alias("_n_id"),
                     F.sum("charge_amt").alias("_charge"),
                     F.count("charge_amt").alias("_n_charge"),
                     F.sum("allowed_amt").alias("_allowed"),
                     F.count("allowed_amt").alias("_n_allowed"),
                     F.sum("discount_amt").alias("_discount"),
                     F.count("discount_amt").alias("_n_discount"),
                     F.sum(_ratio()).alias("_ratio"),
                     F.count(_ratio()).alias("_n_ratio"),
                     _n_in().alias("_n_in")))


def _with_provider(star: Star, fact_keys: list, fact: DataFrame | None = None) -> DataFrame:
    """Partial measures joined to the provider dimension (inner on NPI)."""
    parts = _partials(star.fact_claims if fact is None else fact, fact_keys)
    return parts.join(star.dim_provider.drop("_loaded_at"), "provider_npi")


def _avg(sum_col: str, n_col: str) -> Column:
    """Average from partial sums and counts (money totals)."""
    return X.money_avg(F.sum(sum_col), F.sum(n_col))


def _ratio_avg(sum_col: str, n_col: str) -> Column:
    """Average of per-line ratios from partial sums and counts."""
    return F.try_divide(F.sum(sum_col), F.sum(n_col))


# ----------------------------------------------------------------- V1 / V1b
def monthly_costs(star: Star) -> DataFrame:
    """V1: month, in_network, state -> counts, sums, average discount %."""
    return monthly_costs_of(_with_provider(star, [_month(), "in_network"]))


def monthly_costs_of(joined: DataFrame) -> DataFrame:
    """V1 from partial measures joined with the provider."""
    return (joined.groupBy("month", "in_network", "state")
                  .agg(F.sum("_n").alias("claim_count"),
                       F.sum("_charge").alias("total_charged"),
                       F.sum("_allowed").alias("total_allowed"),
                       F.sum("_discount").alias("total_discount"),
                       X.round2(_ratio_avg("_ratio", "_n_ratio") * 100).alias("avg_discount_pct")))


def monthly_costs_by_payer(star: Star) -> DataFrame:
    """V1 with the payer (inner join on the payer dimension)."""
    fact = star.fact_claims.join(star.dim_payer.select("payer_name"), "payer_name")
    joined = _with_provider(star, [_month(), "in_network", "payer_name"], fact)
    return (joined.groupBy("month", "payer_name", "state", "in_network")
                  .agg(F.sum("_n").alias("claim_count"),
                       F.sum("_charge").alias("total_charged"),
                       F.sum("_allowed").alias("total_allowed"),
                       F.sum("_discount").alias("total_discount"),
                       X.round2(_ratio_avg("_ratio", "_n_ratio") * 100).alias("avg_discount_pct")))


# ----------------------------------------------------------------- V2 / V2b
def provider_kpis(star: Star) -> DataFrame:
    """V2: provider name, city, state -> claims, charged, avg charge, in-network %."""
    return provider_kpis_of(_with_provider(star, []))


def provider_kpis_of(joined: DataFrame) -> DataFrame:
    """V2 from partial measures joined with the provider."""
    return (joined.groupBy("provider_name", "city", "state")
                  .agg(F.sum("_n").alias("total_claims"),
                       F.sum("_charge").alias("total_charged"),
                       X.round2(_avg("_charge", "_n_charge")).alias("avg_charge"),
                       X.pct_of(F.sum("_n_in"), F.sum("_n")).alias("in_network_pct")))


def provider_kpis_wide(star: Star) -> DataFrame:
    """V2 + specialty and payment-to-charge %."""
    joined = _with_provider(star, [])
    return (joined.groupBy("provider_name", "specialty", "city", "state")
                  .agg(F.sum("_n").alias("total_claims"),
                       F.sum("_charge").alias("total_charged"),
                       X.round2(_avg("_charge", "_n_charge")).alias("avg_charge"),
                       X.pct_of(F.sum("_n_in"), F.sum("_n")).alias("in_network_pct"),
                       X.round2(X.money_ratio(F.sum("_allowed"), F.sum("_charge")) * 100)
                       .alias("payment_to_charge_pct")))


# ---------------------------------------------------------------- V3 / V4
def covid19_tests(star: Star) -> DataFrame:
    """V3: COVID test codes by month with description."""
    fact = star.fact_claims.where(F.col("claim_code").isin(COVID_CODES))
    parts = (fact.groupBy(_month(), "claim_code")
                 .agg(F.count(F.lit(1)).alias("_n"), F.sum("charge_amt").alias("_charge"),
                      F.sum("allowed_amt").alias("_allowed"), F.sum("discount_amt").alias("_discount"),
                      F.count("discount_amt").alias("_n_discount")))
    proc = star.dim_procedure.select("claim_code", "procedure_desc")
    return (parts.join(proc, "claim_code")
                 .groupBy("month", "claim_code", "procedure_desc")
                 .agg(F.sum("_n").alias("test_count"),
                      F.sum("_charge").alias("total_charge"),
                      F.sum("_allowed").alias("total_allowed"),
                      X.round2(_avg("_discount", "_n_discount")).alias("avg_discount_per_test")))


def covid19_providers(star: Star) -> DataFrame:
    """V4: COVID tests by provider, state, network status and code."""
    code = F.col("claim_code")
    fact = star.fact_claims.where(code.startswith("U") | code.startswith("87") | (code == "G2023"))
    joined = _with_provider(star, ["in_network", "claim_code"], fact)
    return (joined.groupBy("provider_name", "state", "in_network", "claim_code")
                  .agg(F.sum("_n").alias("tests_performed"),
                       F.sum("_charge").alias("total_charged")))


# ---------------------------------------------------------------------- V5
def network_impact(star: Star) -> DataFrame:
    """V5: in-network vs out-of-network totals."""
    return (star.fact_claims.groupBy("in_network")
                .agg(F.count(F.lit(1)).alias("total_claims"),
                     F.sum("charge_amt").alias("total_charge"),
                     F.sum("allowed_amt").alias("total_allowed"),
                     F.sum("discount_amt").alias("total_discount"),
                     X.round2(F.try_divide(F.sum(_ratio()), F.count(_ratio())) * 100)
                     .alias("avg_discount_rate")))


# ---------------------------------------------------------------------- V6
def high_discount_alerts(star: Star) -> DataFrame:
    """V6: lines whose discount exceeds half the charge (row level)."""
    f = star.fact_claims
    # the guard is part of the ratio itself: conjunct order is not guaranteed
    fact = f.where(F.coalesce(F.col("charge_amt") > 0, F.lit(False))
                   & (F.coalesce(_ratio(), F.lit(0)) > 0.5))
    prov = star.dim_provider.select("provider_npi", "provider_name")
    proc = star.dim_procedure.select("claim_code", "procedure_desc")
    return (fact.join(prov, "provider_npi").join(proc, "claim_code")
                .select("claim_item_id", "procedure_desc", "charge_amt", "allowed_amt",
                        "discount_amt",
                        X.round2(F.col("discount_amt") / F.col("charge_amt") * 100).alias("discount_pct"),
                        "received_date", "provider_name"))


# ---------------------------------------------------------------------- V7
def financial_summary(star: Star, approx_patients: bool = False) -> DataFrame:
    """V7: monthly patients, units, gross / net revenue, adjustments, rate.

    ``approx_patients`` counts patients with HyperLogLog (fixed-size sketch
    per month, no shuffle of (month, patient) pairs)."""
    f = star.fact_claims
    adj = F.col("charge_amt") - F.col("allowed_amt")
    patients = (F.approx_count_distinct("claimant_id") if approx_patients
                else F.count_distinct("claimant_id"))
    return (f.groupBy(_month())
             .agg(patients.alias("unique_patients"),
                  F.sum("units").alias("total_service_units"),
                  F.sum("charge_amt").alias("gross_revenue"),
                  F.sum("allowed_amt").alias("net_revenue"),
                  F.sum(adj).alias("total_contractual_adjustments"),
                  X.round2(X.money_ratio(F.sum(adj), F.sum("charge_amt")) * 100)
                  .alias("discount_rate_pct")))


# ---------------------------------------------------------------------- V8
def top_procedures(star: Star) -> DataFrame:
    """V8: procedures by volume with a volume rank.

    Descriptions are free text, so the rows grow with the data: the ranks are
    taken over the distinct volumes (how many rows have each), of which there
    are few, and joined back. Only that small table sees a global window.
    """
    parts = (star.fact_claims.groupBy("claim_code")
             .agg(F.count(F.lit(1)).alias("_n"), F.sum("units").alias("_units"),
                  F.sum("charge_amt").alias("_charge")))
    proc = star.dim_procedure.select("claim_code", "procedure_desc")
    agg = (parts.join(proc, "claim_code")
                .groupBy("claim_code", "procedure_desc")
                .agg(F.sum("_n").alias("times_billed"), F.sum("_units").alias("total_units"),
                     F.sum("_charge").alias("total_charges")))
    above = Window.orderBy(F.col("times_billed").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (agg.groupBy("times_billed").agg(F.count(F.lit(1)).alias("_rows"))
                .select("times_billed", (F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1).alias("rank_by_volume")))
    return agg.join(ranks, "times_billed").select("claim_code", "procedure_desc", "times_billed", "total_units",
                                                  "total_charges", "rank_by_volume")


# ---------------------------------------------------------------------- V9
def diagnosis_silver(star: Star) -> DataFrame:
    """V9: claim lines with renamed diagnoses, from Silver."""
    from claimlake.operators.star import diagnosis_wide
    return diagnosis_wide(star.silver)


# --------------------------------------------------------------------- V10
def patient_activity(star: Star) -> DataFrame:
    """Per masked patient (more than one line): claims, money, first/last month.

    Grouped on the clear id and hashed afterwards: one hash per patient
    instead of per line, same groups (MD5 is injective on these ids)."""
    f = star.fact_claims
    agg = (f.groupBy("claimant_id")
            .agg(F.count("claim_item_id").alias("total_claims"),
                 F.count(F.lit(1)).alias("_rows"),
                 F.sum("charge_amt").alias("total_patient_charges"),
                 F.sum("allowed_amt").alias("total_patient_allowed"),
                 X.month_start(F.min("received_date")).alias("first_service_date"),
                 X.month_start(F.max("received_date")).alias("last_service_date"))
            .where(F.col("_rows") > 1))
    return agg.select(X.mask_md5(F.col("claimant_id")).alias("hashed_patient_id"),
                      "total_claims", "total_patient_charges", "total_patient_allowed",
                      "first_service_date", "last_service_date")


# --------------------------------------------------------------------- V11
def geo_cost_variation(star: Star) -> DataFrame:
    """Per state (more than 10 lines): count and average money."""
    joined = _with_provider(star, [])
    return (joined.groupBy("state")
                  .agg(F.sum("_n").alias("claim_count"),
                       X.round2(_avg("_charge", "_n_charge")).alias("avg_charge"),
                       X.round2(_avg("_allowed", "_n_allowed")).alias("avg_allowed"),
                       X.round2(_avg("_discount", "_n_discount")).alias("avg_discount"))
                  .where(F.col("claim_count") > LEAST_STATE_LINES))


# --------------------------------------------------------------------- V12
def service_category(code: Column) -> Column:
    """Five-way category, first match wins; ranges compare as text."""
    return (F.when(code.isin(COVID_CODES), F.lit("COVID-19 Testing"))
            .when(code.between("90832", "90899"), F.lit("Psychiatry/Mental Health"))
            .when(code.between("97110", "97599"), F.lit("Therapy/Rehab"))
            .when(code.between("10000", "69999"), F.lit("Surgery/Procedure"))
            .otherwise(F.lit("Lab/Other")))


def service_type_breakdown(star: Star) -> DataFrame:
    """Category x month -> volume, revenue."""
    return (star.fact_claims
            .groupBy(service_category(F.col("claim_code")).alias("service_category"), _month())
            .agg(F.count(F.lit(1)).alias("volume"), F.sum("charge_amt").alias("revenue")))


# --------------------------------------------------------------------- V13
def claim_density(star: Star) -> DataFrame:
    """Patient-days with more than five lines."""
    return (star.fact_claims.groupBy("claimant_id", "received_date")
            .agg(F.count(F.lit(1)).alias("line_items_per_day"),
                 F.sum("charge_amt").alias("daily_charge"))
            .where(F.col("line_items_per_day") > 5))


# --------------------------------------------------------------------- V14
def zero_allowed_audit(star: Star) -> DataFrame:
    """Lines with nothing allowed on a positive charge (row level)."""
    fact = star.fact_claims.where((F.col("allowed_amt") == 0) & (F.col("charge_amt") > 0))
    prov = star.dim_provider.select("provider_npi", "provider_name")
    proc = star.dim_procedure.select("claim_code", "procedure_desc")
    return (fact.join(prov, "provider_npi").join(proc, "claim_code")
                .select("claim_item_id", "procedure_desc", "charge_amt", "allowed_amt",
                        "received_date", "provider_name", "in_network"))


# --------------------------------------------------------------------- V15
def duplicate_suspicions(star: Star) -> DataFrame:
    """4-column keys seen more than once."""
    return (star.fact_claims.groupBy("claimant_id", "received_date", "claim_code", "charge_amt")
            .agg(F.count(F.lit(1)).alias("duplicate_count"))
            .where(F.col("duplicate_count") > 1))


# --------------------------------------------------------------------- V16
def ytd_summary(star: Star) -> DataFrame:
    """Per claimant and year, first-half charges and allowed. The month is read
    from the partition column too, so that half the files are skipped."""
    d = F.col("received_date")
    return (star.fact_claims.where((F.month(d) <= 6) & (F.substring("service_month", 6, 2) <= "06"))
            .groupBy("claimant_id", F.year(d).alias("year"))
            .agg(F.sum("charge_amt").alias("ytd_charges"), F.sum("allowed_amt").alias("ytd_allowed")))


# --------------------------------------------------------------- V17 / V17b
def _dates(star: Star) -> DataFrame:
    # fixed size (one row per day of the spine): safe to broadcast
    return F.broadcast(star.dim_date.select(F.col("date_key").alias("service_date_key"),
                                            "year", "quarter"))


def revenue_cycle_kpi(star: Star) -> DataFrame:
    """Payer, year, quarter -> claims, charges, allowed, payment %."""
    parts = (star.fact_claims.groupBy("payer_name", "service_date_key")
             .agg(F.count("claim_item_id").alias("_n_id"), F.sum("charge_amt").alias("_charge"),
                  F.sum("allowed_amt").alias("_allowed")))
    payer = star.dim_payer.select(F.col("payer_name").alias("_payer"))
    joined = (parts.join(_dates(star), "service_date_key")
                   .join(payer, parts["payer_name"] == payer["_payer"], "left"))
    return (joined.groupBy(F.col("_payer").alias("payer_name"), "year", "quarter")
                  .agg(F.sum("_n_id").alias("total_claims"),
                       F.sum("_charge").alias("gross_charges"),
                       F.sum("_allowed").alias("total_allowed"),
                       X.round2(X.money_ratio(F.sum("_allowed"), F.sum("_charge")) * 100)
                       .alias("payment_to_charge_pct")))


def remittance_per_claim(star: Star) -> DataFrame:
    """Remittance rolled up to one row per claim line before any join (no fan-out)."""
    return (star.fact_remittance.groupBy("claim_id")
            .agg(F.sum("payment_amount").alias("payment_amount"),
                 F.count(F.lit(1)).alias("adjustment_rows")))


def revenue_cycle_kpi_wide(star: Star) -> DataFrame:
    """+ provider, specialty, discounts, payments, denials.

    The only fact-sized join (claim lines to their remittance) carries just a
    narrow key projection of the fact (claim id -> payer, NPI, date key);
    payments and claim measures are each aggregated to (payer, NPI, date)
    before they meet, so no full fact row is shuffled for the join."""
    keys = ["payer_name", "provider_npi", "service_date_key"]
    fact = star.fact_claims.join(star.dim_payer.select("payer_name"), "payer_name")
    remit = remittance_per_claim(star).select(F.col("claim_id").alias("claim_item_id"), "payment_amount")
    paid = (fact.select("claim_item_id", *keys).join(remit, "claim_item_id")
                .groupBy(*keys).agg(F.sum("payment_amount").alias("_paid")))
    parts = (fact.groupBy(*keys)
                 .agg(F.count("claim_item_id").alias("_n_id"), F.count(F.lit(1)).alias("_n"),
                      F.sum("charge_amt").alias("_charge"), F.sum("allowed_amt").alias("_allowed"),
                      F.sum("discount_amt").alias("_discount"),
                      F.sum(F.when(F.col("claim_status") == "Denied", 1).otherwise(0)).alias("_denied"))
                 .join(paid, keys, "left"))
    prov = star.dim_provider.select("provider_npi", "provider_name", "specialty")
    joined = parts.join(prov, "provider_npi").join(_dates(star), "service_date_key")
    return (joined.groupBy("payer_name", "provider_name", "specialty", "year", "quarter")
                  .agg(F.sum("_n_id").alias("total_claims"),
                       F.sum("_charge").alias("gross_charges"),
                       F.sum("_allowed").alias("total_allowed"),
                       F.sum("_discount").alias("total_discounts"),
                       F.coalesce(F.sum("_paid"), F.lit(0)).alias("total_payments"),
                       X.round2(X.money_ratio(F.sum("_allowed"), F.sum("_charge")) * 100)
                       .alias("payment_to_charge_pct"),
                       F.sum("_denied").alias("denied_claims"),
                       X.round2(F.sum("_denied") * F.lit(100.0).cast("decimal(4,1)") / F.sum("_n"))
                       .alias("denial_rate_pct")))


# --------------------------------------------------------------------- V18
def provider_performance(star: Star) -> DataFrame:
    """Provider and specialty -> volume, billed, in-network rate."""
    joined = _with_provider(star, [])
    return (joined.groupBy("provider_name", "specialty")
                  .agg(F.sum("_n").alias("volume"),
                       F.sum("_charge").alias("total_billed"),
                       X.pct_of(F.sum("_n_in"), F.sum("_n")).alias("in_network_rate")))


# --------------------------------------------------------------------- V19
def denial_analysis(star: Star) -> DataFrame:
    """Denied lines by payer and adjustment code, with each code's share
    of the payer's denied lines (a window over the aggregated rows)."""
    denied = star.fact_claims.where(F.col("claim_status") == "Denied")
    remit = star.fact_remittance.select(F.col("claim_id").alias("claim_item_id"), "carc_code",
                                        "adjustment_reason")
    joined = (denied.join(remit, "claim_item_id")
                    .join(star.dim_payer.select("payer_name"), "payer_name"))
    agg = (joined.groupBy("payer_name", "carc_code", "adjustment_reason")
                 .agg(F.count_distinct("claim_item_id").alias("denied_claims"),
                      F.sum("charge_amt").alias("denied_charges")))
    share = F.col("denied_claims") * F.lit(100.0).cast("decimal(4,1)") / \
        F.sum("denied_claims").over(Window.partitionBy("payer_name"))
    return agg.withColumn("denial_rate_pct", X.round2(share))


VIEWS = {
    "vw_monthly_costs": monthly_costs,
    "vw_monthly_costs_by_payer": monthly_costs_by_payer,
    "vw_provider_kpis": provider_kpis,
    "vw_provider_kpis_wide": provider_kpis_wide,
    "vw_covid19_tests": covid19_tests,
    "vw_covid19_providers": covid19_providers,
    "vw_network_impact": network_impact,
    "vw_high_discount_alerts": high_discount_alerts,
    "vw_financial_summary": financial_summary,
    "vw_top_procedures": top_procedures,
    "vw_diagnosis_silver": diagnosis_silver,
    "vw_patient_activity": patient_activity,
    "vw_geo_cost_variation": geo_cost_variation,
    "vw_service_type_breakdown": service_type_breakdown,
    "vw_claim_density": claim_density,
    "vw_zero_allowed_audit": zero_allowed_audit,
    "vw_duplicate_suspicions": duplicate_suspicions,
    "vw_ytd_summary": ytd_summary,
    "vw_revenue_cycle_kpi": revenue_cycle_kpi,
    "vw_revenue_cycle_kpi_wide": revenue_cycle_kpi_wide,
    "vw_provider_performance": provider_performance,
    "vw_denial_analysis": denial_analysis,
}


def register_views(star: Star) -> None:
    """Create every view as a temp view (SQL users query them by name)."""
    for name, fn in VIEWS.items():
        if name == "vw_diagnosis_silver" and star.silver is None:
            continue
        fn(star).createOrReplaceTempView(name)
