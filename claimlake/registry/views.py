"""Reporting views V1-V19: Spark builders and DuckDB oracles.

The oracles are calculated on their own terms, from the views' rows in the survey
(keys, measures, filter, join rule): every claim line is first widened by what the
dimensions say about it (``lines``), with its figures prepared per line, and a view is
then a group of such lines described by its keys and measures. The Spark builders work
the other way round, aggregating before they join (``plans.views``).
"""

from __future__ import annotations

from claimlake import oracle as O
from claimlake.plans import views as V
from claimlake.registry import select_typed, star_query

r2 = O.r2
COVID_IN = ", ".join(f"'{c}'" for c in V.COVID_CODES)

# What a line says by itself; ratio is NULL where nothing was charged.
O.cte("line_facts", f"""
SELECT fc.*, CAST(make_date(CAST(year(received_date) AS BIGINT), CAST(month(received_date) AS BIGINT), 1) AS DATE) AS month,
       discount_amt / NULLIF(charge_amt, 0) AS ratio, CAST(COALESCE(in_network, false) AS INT) AS inside,
       CAST(claim_status = 'Denied' AS INT) AS denied
FROM fact_claims fc""", ["fact_claims"])


CATEGORY = f"""CASE WHEN list_contains([{COVID_IN}], l.claim_code) THEN 'COVID-19 Testing'
            WHEN l.claim_code >= '90832' AND l.claim_code <= '90899' THEN 'Psychiatry/Mental Health'
            WHEN l.claim_code >= '97110' AND l.claim_code <= '97599' THEN 'Therapy/Rehab'
            WHEN l.claim_code >= '10000' AND l.claim_code <= '69999' THEN 'Surgery/Procedure'
            ELSE 'Lab/Other' END"""


def widened(*dims: str) -> tuple[str, list[str]]:
    """(FROM text, CTEs used): the lines joined with dimensions."""
    rules = {
        "provider": ("dim_provider", "JOIN dim_provider w_provider ON w_provider.provider_npi = l.provider_npi"),
        "procedure": ("dim_procedure", "JOIN dim_procedure w_procedure ON w_procedure.claim_code = l.claim_code"),
        "payer": ("dim_payer", "JOIN dim_payer w_payer ON w_payer.payer_name = l.payer_name"),
        "any_payer": ("dim_payer", "LEFT JOIN dim_payer w_payer ON w_payer.payer_name = l.payer_name"),
        "day": ("dim_date", "JOIN dim_date w_day ON w_day.date_key = l.service_date_key"),
        "paid": ("fact_remittance", "LEFT JOIN (SELECT claim_id, SUM(payment_amount) AS paid FROM fact_remittance GROUP BY ALL) w_paid "
                                    "ON w_paid.claim_id = l.claim_item_id"),
        "remittance": ("fact_remittance", "JOIN fact_remittance w_remit ON w_remit.claim_id = l.claim_item_id"),
    }
    return " ".join(["line_facts l", *[rules[d][1] for d in dims]]), ["line_facts", *[rules[d][0] for d in dims]]


#: Measures by output name; a view names those it shows.
N = "COUNT(*)"
SUMS = {k: f"SUM(l.{c})" for k, c in {
    "total_charged": "charge_amt", "total_charge": "charge_amt", "total_charges": "charge_amt", "gross_charges": "charge_amt",
    "gross_revenue": "charge_amt", "revenue": "charge_amt", "daily_charge": "charge_amt", "ytd_charges": "charge_amt",
    "total_billed": "charge_amt", "total_patient_charges": "charge_amt", "denied_charges": "charge_amt",
    "total_allowed": "allowed_amt", "net_revenue": "allowed_amt", "ytd_allowed": "allowed_amt", "total_patient_allowed": "allowed_amt",
    "total_discount": "discount_amt", "total_discounts": "discount_amt", "total_contractual_adjustments": "discount_amt",
    "total_units": "units", "total_service_units": "units", "denied_claims": "denied"}.items()}


def mean(column: str) -> str:
    return O.mean2(f"SUM(l.{column})", f"COUNT(l.{column})")


def share(part: str, whole: str) -> str:
    return r2(f"100 * {part} / NULLIF({whole}, 0)")


IN_NETWORK_PCT = f"100.0 * CAST(SUM(l.inside) AS DOUBLE) / CAST({N} AS DOUBLE)"
MEAN_RATIO_PCT = r2("100 * (SUM(l.ratio) / NULLIF(COUNT(l.ratio), 0))")


def group_of(dims: tuple[str, ...], keys: dict[str, str], measures: dict[str, str | None], lines: str = "true", groups: str = "true") -> tuple[str, list[str]]:
    """A view as a group of lines: keys and measures by output name (a measure without a
    text is the sum of that name), a condition on lines and one on groups."""
    source, uses = widened(*dims)
    shown = [f"{e} AS {k}" for k, e in keys.items()] + [f"{e or SUMS[k]} AS {k}" for k, e in measures.items()]
    return f"SELECT {', '.join(shown)}\nFROM {source}\nWHERE {lines}\nGROUP BY {', '.join(keys.values())}\nHAVING {groups}", uses


def lines_of(dims: tuple[str, ...], columns: dict[str, str], lines: str) -> tuple[str, list[str]]:
    source, uses = widened(*dims)
    return f"SELECT {', '.join(f'{e} AS {k}' for k, e in columns.items())}\nFROM {source}\nWHERE {lines}", uses


def own(*names: str) -> dict[str, str]:
    return {n: f"l.{n}" for n in names}


PROVIDER = {"provider_name": "w_provider.provider_name"}
STATE = {"state": "w_provider.state"}
COSTS = {"claim_count": N, "total_charged": None, "total_allowed": None, "total_discount": None, "avg_discount_pct": MEAN_RATIO_PCT}
KPIS = {"total_claims": N, "total_charged": None, "avg_charge": mean("charge_amt"), "in_network_pct": IN_NETWORK_PCT}
PAYMENT_PCT = {"payment_to_charge_pct": share(SUMS["total_allowed"], SUMS["total_charged"])}

_REMIT_GROUPS, _REMIT_USES = group_of(
    ("remittance", "payer"), {"payer_name": "w_payer.payer_name", "carc_code": "w_remit.carc_code", "adjustment_reason": "w_remit.adjustment_reason"},
    {"denied_claims": "COUNT(DISTINCT l.claim_item_id)", "denied_charges": None}, lines="l.denied = 1")
O.cte("denied_groups", _REMIT_GROUPS, _REMIT_USES)
_VOLUMES, _VOLUME_USES = group_of(("procedure",), {"claim_code": "w_procedure.claim_code", "procedure_desc": "w_procedure.procedure_desc"},
                                  {"times_billed": N, "total_units": None, "total_charges": None})
O.cte("procedure_volumes", _VOLUMES, _VOLUME_USES)

# name -> (spark builder, (oracle CTE body, CTEs it uses), typed output)
VIEW_ORACLES = {
    "vw_monthly_costs": (V.monthly_costs, group_of(("provider",), own("month", "in_network") | STATE, COSTS),
        "month, in_network, state, claim_count:B, total_charged:D, total_allowed:D, total_discount:D, avg_discount_pct"),
    "vw_monthly_costs_by_payer": (V.monthly_costs_by_payer,
        group_of(("provider", "payer"), own("month", "in_network") | {"payer_name": "w_payer.payer_name"} | STATE, COSTS),
        "month, payer_name, state, in_network, claim_count:B, total_charged:D, total_allowed:D, total_discount:D, avg_discount_pct"),
    "vw_provider_kpis": (V.provider_kpis, group_of(("provider",), PROVIDER | {"city": "w_provider.city"} | STATE, KPIS),
        "provider_name, city, state, total_claims:B, total_charged:D, avg_charge, in_network_pct"),
    "vw_provider_kpis_wide": (V.provider_kpis_wide,
        group_of(("provider",), PROVIDER | {"specialty": "w_provider.specialty", "city": "w_provider.city"} | STATE, KPIS | PAYMENT_PCT),
        "provider_name, specialty, city, state, total_claims:B, total_charged:D, avg_charge, in_network_pct, payment_to_charge_pct"),
    "vw_covid19_tests": (V.covid19_tests,
        group_of(("procedure",), own("month", "claim_code") | {"procedure_desc": "w_procedure.procedure_desc"},
                 {"test_count": N, "total_charge": None, "total_allowed": None, "avg_discount_per_test": mean("discount_amt")},
                 lines=f"l.claim_code IN ({COVID_IN})"),
        "month, claim_code, procedure_desc, test_count:B, total_charge:D, total_allowed:D, avg_discount_per_test"),
    "vw_covid19_providers": (V.covid19_providers,
        group_of(("provider",), PROVIDER | STATE | own("in_network", "claim_code"), {"tests_performed": N, "total_charged": None},
                 lines="regexp_matches(l.claim_code, '^(U|87|G2023$)')"),
        "provider_name, state, in_network, claim_code, tests_performed:B, total_charged:D"),
    "vw_network_impact": (V.network_impact,
        group_of((), own("in_network"), {"total_claims": N, "total_charge": None, "total_allowed": None, "total_discount": None,
                                         "avg_discount_rate": MEAN_RATIO_PCT}),
        "in_network, total_claims:B, total_charge:D, total_allowed:D, total_discount:D, avg_discount_rate"),
    "vw_high_discount_alerts": (V.high_discount_alerts,
        lines_of(("provider", "procedure"), own("claim_item_id", "charge_amt", "allowed_amt", "discount_amt", "received_date") | PROVIDER
                 | {"procedure_desc": "w_procedure.procedure_desc", "discount_pct": r2("l.ratio * 100")},
                 "l.charge_amt > 0 AND 2 * l.discount_amt > l.charge_amt"),
        "claim_item_id, procedure_desc, charge_amt:D, allowed_amt:D, discount_amt:D, discount_pct, received_date, provider_name"),
    "vw_financial_summary": (V.financial_summary,
        group_of((), own("month"), {"unique_patients": "COUNT(DISTINCT l.claimant_id)", "total_service_units": None, "gross_revenue": None,
                                    "net_revenue": None, "total_contractual_adjustments": None,
                                    "discount_rate_pct": share(SUMS["total_discount"], SUMS["gross_revenue"])}),
        "month, unique_patients:B, total_service_units:B, gross_revenue:D, net_revenue:D, total_contractual_adjustments:D, discount_rate_pct"),
    "vw_top_procedures": (V.top_procedures, ("""
SELECT v.*, 1 + (SELECT COUNT(*) FROM procedure_volumes o WHERE o.times_billed > v.times_billed) AS rank_by_volume
FROM procedure_volumes v""", ["procedure_volumes"]),
        "claim_code, procedure_desc, times_billed:B, total_units:B, total_charges:D, rank_by_volume:B"),
    "vw_diagnosis_silver": (V.diagnosis_silver, ("SELECT * RENAME (" + ", ".join(
        f"diag_code_{i + 1} AS {n}" for i, n in enumerate(["primary_diagnosis"] + [f"secondary_diagnosis_{k}" for k in range(1, 5)])) + ") FROM silver", ["silver"]),
        "claim_item_id, claimant_id, claim_code, provider_npi, primary_diagnosis, secondary_diagnosis_1, "
        "secondary_diagnosis_2, secondary_diagnosis_3, secondary_diagnosis_4, charge_amt:D, allowed_amt:D, received_date"),
    "vw_patient_activity": (V.patient_activity,
        group_of((), {"hashed_patient_id": "md5(CAST(l.claimant_id AS VARCHAR))"},
                 {"total_claims": "COUNT(l.claim_item_id)", "total_patient_charges": None, "total_patient_allowed": None,
                  "first_service_date": "MIN(l.month)", "last_service_date": "MAX(l.month)"}, groups=f"{N} >= 2"),
        "hashed_patient_id, total_claims:B, total_patient_charges:D, total_patient_allowed:D, first_service_date, last_service_date"),
    "vw_geo_cost_variation": (V.geo_cost_variation,
        group_of(("provider",), STATE, {"claim_count": N, "avg_charge": mean("charge_amt"), "avg_allowed": mean("allowed_amt"),
                                        "avg_discount": mean("discount_amt")}, groups=f"{N} >= 11"),
        "state, claim_count:B, avg_charge, avg_allowed, avg_discount"),
    "vw_service_type_breakdown": (V.service_type_breakdown, group_of((), {"service_category": CATEGORY} | own("month"), {"volume": N, "revenue": None}),
        "service_category, month, volume:B, revenue:D"),
    "vw_claim_density": (V.claim_density,
        group_of((), own("claimant_id", "received_date"), {"line_items_per_day": N, "daily_charge": None}, groups=f"{N} >= 6"),
        "claimant_id, received_date, line_items_per_day:B, daily_charge:D"),
    "vw_zero_allowed_audit": (V.zero_allowed_audit,
        lines_of(("provider", "procedure"), own("claim_item_id", "charge_amt", "allowed_amt", "received_date", "in_network") | PROVIDER
                 | {"procedure_desc": "w_procedure.procedure_desc"}, "l.denied = 1"),
        "claim_item_id, procedure_desc, charge_amt:D, allowed_amt:D, received_date, provider_name, in_network"),
    "vw_duplicate_suspicions": (V.duplicate_suspicions,
        group_of((), own("claimant_id", "received_date", "claim_code", "charge_amt"), {"duplicate_count": N}, groups=f"{N} >= 2"),
        "claimant_id, received_date, claim_code, charge_amt:D, duplicate_count:B"),
    "vw_ytd_summary": (V.ytd_summary,
        group_of((), own("claimant_id") | {"year": "year(l.received_date)"}, {"ytd_charges": None, "ytd_allowed": None},
                 lines="month(l.received_date) IN (1, 2, 3, 4, 5, 6)"),
        "claimant_id, year:I, ytd_charges:D, ytd_allowed:D"),
    "vw_revenue_cycle_kpi": (V.revenue_cycle_kpi,
        group_of(("day", "any_payer"), {"payer_name": "w_payer.payer_name", "year": "w_day.year", "quarter": "w_day.quarter"},
                 {"total_claims": "COUNT(l.claim_item_id)", "gross_charges": None, "total_allowed": None} | PAYMENT_PCT),
        "payer_name, year:I, quarter:I, total_claims:B, gross_charges:D, total_allowed:D, payment_to_charge_pct"),
    "vw_revenue_cycle_kpi_wide": (V.revenue_cycle_kpi_wide,
        group_of(("payer", "provider", "day", "paid"),
                 {"payer_name": "w_payer.payer_name", "specialty": "w_provider.specialty", "year": "w_day.year", "quarter": "w_day.quarter"} | PROVIDER,
                 {"total_claims": "COUNT(l.claim_item_id)", "gross_charges": None, "total_allowed": None, "total_discounts": None,
                  "total_payments": "SUM(COALESCE(w_paid.paid, 0))", "denied_claims": None, "denial_rate_pct": share(SUMS["denied_claims"], N)} | PAYMENT_PCT),
        "payer_name, provider_name, specialty, year:I, quarter:I, total_claims:B, gross_charges:D, "
        "total_allowed:D, total_discounts:D, total_payments:D, payment_to_charge_pct, denied_claims:B, denial_rate_pct"),
    "vw_provider_performance": (V.provider_performance,
        group_of(("provider",), PROVIDER | {"specialty": "w_provider.specialty"}, {"volume": N, "total_billed": None, "in_network_rate": IN_NETWORK_PCT}),
        "provider_name, specialty, volume:B, total_billed:D, in_network_rate"),
    "vw_denial_analysis": (V.denial_analysis, (f"""
SELECT g.*, {share('g.denied_claims', '(SELECT SUM(t.denied_claims) FROM denied_groups t WHERE t.payer_name = g.payer_name)')} AS denial_rate_pct
FROM denied_groups g""", ["denied_groups"]),
        "payer_name, carc_code, adjustment_reason, denied_claims:B, denied_charges:D, denial_rate_pct"),
}

for _name, (_fn, (_sql, _uses), _spec) in VIEW_ORACLES.items():
    O.cte(_name, _sql, _uses)
    star_query(_name, _fn, O.query(select_typed(_name, _spec), [_name]))
