"""Aggregated access with small cells withheld (D16: billing managers and executives).

A report shows figures for cells of a group (payers of a month, say), for the groups and for all
lines. A cell of fewer than k patients is withheld, and so that it cannot be worked out from what
is shown, so is a second one:

* If any cell of a group is withheld, the withheld cells of the group together have to be at least two,
  one of them of k patients or more; the smallest such cell is withheld too. The group's
  total less its shown cells is then the sum of cells of which one has k patients.
* If all cells are too small, all are withheld, and only the group's total is shown.
* A group of fewer than k patients is withheld with its cells; the same rule for groups under the grand
  total withholds the smallest group of k patients too, with all its cells, as these would add up to it.
* The grand total is withheld if there are fewer than k patients at all.

A withheld cell keeps its row, with NULL figures, so that a reader sees that there is one.
Figures are counts and exact sums, and ratios of these; patients are counted per cell, not added up.
All of it is aggregation with map-side combining; the windows run over cells, not over lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlake import functions as X

#: Patients that a shown cell has at least.
LEAST_PATIENTS = 11

LEVELS = ("all", "group", "cell")


def _withheld(patients: Column, forced: Column, siblings) -> Column:
    """Whether a cell is withheld among its ``siblings``: too small itself, or the smallest of the others
    while one is. ``forced``: withheld for another reason, and no cover for a small one."""
    small = patients < F.col("_least")
    any_small = F.max(small & ~forced).over(siblings)
    cover = F.row_number().over(siblings.orderBy(small | forced, patients, *[F.col(c).asc_nulls_first() for c in ("_g", "_c")])) == 1
    return small | forced | (any_small & cover & ~small)


def suppressed(lines: DataFrame, group: Column, cell: Column, measures: dict[str, Column], least: int = LEAST_PATIENTS,
               patient: str = "claimant_id") -> DataFrame:
    """level (all, group, cell), group, cell, shown, patients and the measures of a report, withheld as
    described above. ``measures``: aggregates of lines that add up (counts, sums). Lines without a
    patient count for the measures and protect nobody."""
    rows = lines.withColumns({"_g": group.cast("string"), "_c": cell.cast("string")})
    figures = [F.count_distinct(F.col(patient)).alias("patients"), *[c.alias(n) for n, c in measures.items()]]
    least_ = F.lit(least).alias("_least")
    cells = rows.groupBy("_g", "_c").agg(*figures).select("*", least_)
    groups = rows.groupBy("_g").agg(*figures).select("*", F.lit(None).cast("string").alias("_c"), least_)
    total = rows.agg(*figures).select("*", F.lit(None).cast("string").alias("_g"), F.lit(None).cast("string").alias("_c"), least_)
    no = F.lit(False)
    everything = Window.partitionBy(F.lit(0))
    groups = groups.withColumn("_held", _withheld(F.col("patients"), no, everything))
    above = groups.select(F.col("_g").alias("_of"), F.col("_held").alias("_forced"))
    cells = cells.join(above, F.col("_g").eqNullSafe(F.col("_of"))).drop("_of")
    cells = cells.withColumn("_held", _withheld(F.col("patients"), F.col("_forced"), Window.partitionBy("_g"))).drop("_forced")
    total = total.withColumn("_held", F.col("patients") < F.col("_least"))
    parts = [p.withColumn("level", F.lit(level)) for level, p in zip(LEVELS, (total, groups, cells))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    shown = lambda c: F.when(~F.col("_held"), F.col(c)).alias(c)
    return both.select("level", F.col("_g").alias("group"), F.col("_c").alias("cell"), (~F.col("_held")).alias("shown"), shown("patients"), *[shown(n) for n in measures])


def _rate(part: str, whole: str) -> Column:
    return X.round2(X.safe_ratio(F.col(part).cast("decimal(20,0)"), F.col(whole).cast("decimal(20,0)")) * 100)


def billing_report(fact: DataFrame, least: int = LEAST_PATIENTS) -> DataFrame:
    """For billing managers: claims, charges, paid (allowed) amounts and denial rate by month and payer."""
    denied = F.count(F.when(F.col("claim_status") == "Denied", 1))
    out = suppressed(fact, F.col("service_month"), F.col("payer_name"), {
        "claims": F.count(F.lit(1)), "total_charges": F.sum("charge_amt"), "total_paid": F.sum("allowed_amt"), "denied_claims": denied}, least)
    return out.withColumn("denial_rate_pct", _rate("denied_claims", "claims"))


def executive_report(fact: DataFrame, least: int = LEAST_PATIENTS) -> DataFrame:
    """For executives: revenue, net reimbursement (charges less adjustments) and payment share by quarter
    and payer."""
    quarter = F.concat(F.year("received_date").cast("string"), F.lit("-Q"), F.quarter("received_date").cast("string"))
    out = suppressed(fact, quarter, F.col("payer_name"), {
        "claims": F.count(F.lit(1)), "total_revenue": F.sum("charge_amt"), "total_adjustments": F.sum("discount_amt")}, least)
    net = F.col("total_revenue") - F.col("total_adjustments")
    return out.withColumns({"net_reimbursement": net, "payment_to_charge_pct": X.round2(X.money_ratio(net, F.col("total_revenue")) * 100)})


REPORTS = {"billing_manager": billing_report, "executive": executive_report}


def role_report(fact: DataFrame, role: str, least: int = LEAST_PATIENTS) -> DataFrame:
    """The aggregated report of a role that reads no single lines."""
    if role not in REPORTS:
        raise ValueError(f"no aggregated report for role {role!r}")
    return REPORTS[role](fact, least)
