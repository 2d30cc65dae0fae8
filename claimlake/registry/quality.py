"""Data-quality reports and rules (D1-D16): Spark builders and DuckDB oracles."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from claimlake import oracle as O
from claimlake.operators import aggregates as A, quality as Q, star as G
from claimlake.plans.pipeline import silver_from_tables
from claimlake.registry import register, select_typed, written_once
from claimlake.schema import DIAG_COLUMNS, DUPLICATE_KEY, RAW_COLUMNS, RAW_SCHEMA
from claimlake.session import scratch_path
from claimlake.sources.fixture import raw_claims
from claimlake.sources.ingest import ingest_batch

pct = O.pct


def _reg(name: str, fn, body: str, deps, spec: str) -> None:
    O.cte(name, body, deps)
    register(name, O.query(select_typed(name, spec), [name]))(fn)


def _profile_sql(src: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, 'string' AS data_type, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"{pct(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)')} AS null_pct, "
        f"COUNT(DISTINCT {c}) AS unique_values FROM {src}" for c in cols)


PROFILE_SPEC = "column_name, data_type, null_count:B, null_pct, unique_values:B"

_reg("dq_profile_raw", lambda s, d: Q.profile(raw_claims(s, d)), _profile_sql("raw", RAW_COLUMNS), ["raw"],
     PROFILE_SPEC)
_reg("dq_high_null_columns", lambda s, d: Q.high_null_columns(raw_claims(s, d)),
     "SELECT column_name, null_pct FROM dq_profile_raw WHERE null_pct > 50", ["dq_profile_raw"],
     "column_name, null_pct")
_reg("dq_diagnosis_sparsity", lambda s, d: Q.profile(raw_claims(s, d), DIAG_COLUMNS),
     _profile_sql("raw", DIAG_COLUMNS), ["raw"], PROFILE_SPEC)



def _running(spark, sf_dir):
    """D1 over three batches by their stored sketches, beside the exact profile."""
    raw = written_once(raw_claims(spark, sf_dir), "raw")
    path = scratch_path(spark, f"sketches-{uuid.uuid4().hex}")
    code = F.col("claim_code")
    kind = F.when(code.startswith("U"), 1).when(code.startswith("G"), 2).otherwise(3)
    for i in (1, 2, 3):
        Q.profile_sketches(raw.where(kind == i), str(i)).write.mode("append").parquet(path)
    running = Q.running_profile(spark.read.parquet(path))
    exact = Q.profile(raw).select("column_name", F.col("unique_values").alias("exact"))
    near = F.abs(F.col("unique_values") - F.col("exact")) <= F.ceil(4 * Q.SKETCH_ERROR * F.col("exact"))
    return running.join(exact, "column_name").select("column_name", "rows", "null_count", "null_pct", F.col("exact").alias("unique_values"), near.alias("within_error"))


_reg("dq_profile_running", _running,
     "SELECT column_name, (SELECT COUNT(*) FROM raw) AS rows, null_count, null_pct, unique_values, true AS within_error FROM dq_profile_raw",
     ["raw", "dq_profile_raw"], "column_name, rows:B, null_count:B, null_pct, unique_values:B, within_error")

_reg("dq_duplicate_rows", lambda s, d: Q.duplicate_row_count(silver_from_tables(s, d), DUPLICATE_KEY), f"""
SELECT COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS duplicate_rows, COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM (SELECT COUNT(*) AS n FROM silver GROUP BY {', '.join(DUPLICATE_KEY)})""", ["silver"],
     "duplicate_rows:B, duplicate_keys:B")

_reg("dq_value_checks", lambda s, d: Q.value_checks(silver_from_tables(s, d)), """
SELECT COUNT(*) FILTER (WHERE charge_amt < 0) AS negative_charge_amt,
       COUNT(*) FILTER (WHERE allowed_amt < 0) AS negative_allowed_amt,
       COUNT(*) FILTER (WHERE units <= 0) AS invalid_units,
       MIN(received_date) AS date_min, MAX(received_date) AS date_max
FROM silver""", ["silver"], "negative_charge_amt:B, negative_allowed_amt:B, invalid_units:B, date_min, date_max")

_reg("dq_type_distribution", lambda s, d: Q.value_counts(raw_claims(s, d), "type"),
     "SELECT type, COUNT(*) AS count FROM raw WHERE type IS NOT NULL GROUP BY type", ["raw"], "type, count:B")

# what the report reads
QUALITY_COLUMNS = ["claim_item_id", "claimant_id", "charge_amt", "claim_code", "provider_npi", "received_date", "is_valid", "has_negative_charge",
                   "has_negative_allowed", "has_missing_provider", "has_npi"]
_reg("dq_quality_report", lambda s, d: Q.quality_report(written_once(silver_from_tables(s, d).select(*QUALITY_COLUMNS), "silver")), f"""
SELECT COUNT(*) AS total_rows,
       {O.r2('SUM(CAST(is_valid AS INT)) * 100.0 / NULLIF(COUNT(*), 0)')} AS quality_score,
       COUNT(*) FILTER (WHERE claimant_id IS NULL) AS null_claimant_id,
       COUNT(*) FILTER (WHERE claim_item_id IS NULL) AS null_claim_item_id,
       COUNT(*) FILTER (WHERE charge_amt IS NULL) AS null_charge_amt,
       COUNT(*) FILTER (WHERE claim_code IS NULL) AS null_claim_code,
       SUM(CAST(has_negative_charge AS INT)) AS negative_charges,
       SUM(CAST(has_negative_allowed AS INT)) AS negative_allowed,
       SUM(CAST(has_missing_provider AS INT)) AS missing_providers,
       SUM(CAST(has_npi AS INT)) AS npi_count,
       COUNT(DISTINCT claimant_id) AS unique_claimants, COUNT(DISTINCT claim_code) AS unique_codes,
       COUNT(DISTINCT provider_npi) AS unique_npis,
       MIN(received_date) AS date_min, MAX(received_date) AS date_max,
       (SELECT string_agg(provider_npi, ',' ORDER BY provider_npi) FROM
          (SELECT DISTINCT provider_npi FROM silver WHERE provider_npi IS NOT NULL ORDER BY provider_npi LIMIT 5))
         AS sample_npis
FROM silver""", ["silver"],
     "total_rows:B, quality_score, null_claimant_id:B, null_claim_item_id:B, null_charge_amt:B, null_claim_code:B, "
     "negative_charges:B, negative_allowed:B, missing_providers:B, npi_count:B, unique_claimants:B, "
     "unique_codes:B, unique_npis:B, date_min, date_max, sample_npis")


REQUIRED = ["claim_item_id", "claimant_id", "charge_amt", "allowed_amt"]


def _nb(spark, sf_dir, once: bool = False):
    """Notebook fact and providers. ``once``: of lines written once, with the columns that the checks read."""
    silver = silver_from_tables(spark, sf_dir, "notebook")
    if once:
        silver = written_once(silver.select(*REQUIRED, "discount_amt", "provider_npi", "service_provider", "provider_street", "city", "state"), "silver")
    return G.fact_claim_items(silver), G.dim_provider_notebook(silver)


_reg("dq_referential_integrity", lambda s, d: Q.referential_integrity(*_nb(s, d)), """
SELECT (SELECT COUNT(DISTINCT provider_npi) FROM fact_items
        WHERE provider_npi IS NOT NULL AND provider_npi NOT IN
              (SELECT provider_npi FROM dim_provider_notebook WHERE provider_npi IS NOT NULL)) AS invalid_provider_npis,
       COUNT(*) FILTER (WHERE discount_amt < 0) AS negative_discounts,
       COUNT(*) FILTER (WHERE allowed_amt > charge_amt) AS allowed_exceeds_charge
FROM fact_items""", ["fact_items", "dim_provider_notebook"],
     "invalid_provider_npis:B, negative_discounts:B, allowed_exceeds_charge:B")

_reg("dq_completeness", lambda s, d: Q.completeness(_nb(s, d)[0], REQUIRED),
     "SELECT column_name, null_count, null_pct FROM (" + _profile_sql("fact_items", REQUIRED)
     + ") WHERE null_count > 0", ["fact_items"], "column_name, null_count:B, null_pct")

_reg("dq_uniqueness", lambda s, d: Q.uniqueness(_nb(s, d)[0], "claim_item_id"), """
SELECT COALESCE(SUM(n - 1), 0) = 0 AS is_unique, COALESCE(SUM(n - 1), 0) AS duplicate_count
FROM (SELECT COUNT(*) AS n FROM fact_items GROUP BY claim_item_id)""", ["fact_items"],
     "is_unique, duplicate_count:B")

_reg("dq_check_report",
     lambda s, d: Q.check_report(*_nb(s, d, once=True), REQUIRED, "claim_item_id"), """
SELECT 'referential_integrity' AS check_name,
       (invalid_provider_npis + negative_discounts + allowed_exceeds_charge) = 0 AS passed,
       invalid_provider_npis + negative_discounts + allowed_exceeds_charge AS issues
FROM dq_referential_integrity
UNION ALL SELECT 'data_completeness', COUNT(*) = 0, COUNT(*) FROM dq_completeness
UNION ALL SELECT 'primary_key_uniqueness', duplicate_count = 0, duplicate_count FROM dq_uniqueness""",
     ["dq_referential_integrity", "dq_completeness", "dq_uniqueness"], "check_name, passed, issues:B")


def _rule_sql(src: str, rules) -> str:
    parts = []
    for r in rules:
        c = r.column
        if r.kind == "unique":
            parts.append(f"SELECT '{r.name}' AS rule, COALESCE(SUM(n - 1), 0) = 0 AS passed, "
                         f"COALESCE(SUM(n - 1), 0) AS failing_rows, CAST(NULL AS DOUBLE) AS metric "
                         f"FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {c})")
            continue
        if r.kind == "freshness":
            parts.append(f"SELECT '{r.name}' AS rule, "
                         f"COALESCE(date_diff('day', MAX({c}), current_date) <= {r.value}, false) AS passed, "
                         f"CAST(NULL AS BIGINT) AS failing_rows, "
                         f"CAST(date_diff('day', MAX({c}), current_date) AS DOUBLE) AS metric FROM {src}")
            continue
        v = f"DATE '{r.value}'" if isinstance(r.value, str) else r.value
        if r.kind == "accepted":
            bad = f"{c} NOT IN ({', '.join(str(x).lower() for x in r.value)})"
        else:
            bad = {"complete": f"{c} IS NULL", "min": f"{c} < {v}", "max": f"{c} > {v}",
                   "length": f"length({c}) <> {v}"}[r.kind]
        parts.append(f"SELECT '{r.name}' AS rule, COUNT(*) FILTER (WHERE {bad}) = 0 AS passed, "
                     f"COUNT(*) FILTER (WHERE {bad}) AS failing_rows, "
                     f"CAST(COUNT(*) - COUNT(*) FILTER (WHERE {bad}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS metric "
                     f"FROM {src}")
    return "\nUNION ALL\n".join(parts)


RULE_SPEC = "rule, passed, failing_rows:B, metric"
_reg("dq_silver_rules", lambda s, d: Q.evaluate_rules(silver_from_tables(s, d), Q.SILVER_RULES),
     _rule_sql("silver", Q.SILVER_RULES), ["silver"], RULE_SPEC)
_reg("dq_fact_tests",
     lambda s, d: Q.evaluate_rules(G.fact_claims(silver_from_tables(s, d)), Q.FACT_TESTS),
     _rule_sql("fact_claims", Q.FACT_TESTS), ["fact_claims"], RULE_SPEC)

_ROW_RULES = [r for r in Q.SILVER_RULES if r.row_level]
_CHECKS = []
for _r in _ROW_RULES:
    _v = f"DATE '{_r.value}'" if isinstance(_r.value, str) else _r.value
    _CHECKS.append({"complete": f"({_r.column} IS NOT NULL)",
                    "min": f"COALESCE({_r.column} >= {_v}, true)", "max": f"COALESCE({_r.column} <= {_v}, true)",
                    "length": f"COALESCE(length({_r.column}) = {_v}, true)"}[_r.kind])
_PASSED = " + ".join(f"CAST({c} AS INT)" for c in _CHECKS)

_reg("dq_record_scores",
     lambda s, d: Q.score_records(silver_from_tables(s, d), Q.SILVER_RULES)
     .select("claim_item_id", "rules_passed", "rules_total", "quality_score", "dq_route"), f"""
SELECT claim_item_id, {_PASSED} AS rules_passed, {len(_CHECKS)} AS rules_total,
       {O.r2(f'({_PASSED}) * 100.0 / {len(_CHECKS)}')} AS quality_score,
       CASE WHEN {_PASSED} = {len(_CHECKS)} THEN 'pass' ELSE 'quarantine' END AS dq_route
FROM silver""", ["silver"], "claim_item_id, rules_passed:I, rules_total:I, quality_score, dq_route")


def _post_build(spark, sf_dir):
    star = G.build_star(written_once(silver_from_tables(spark, sf_dir).select(*G.STAR_COLUMNS), "silver"))
    return Q.post_build_checks(star.tables() | {}, {"fact_claims": ["claim_item_id", "charge_amt"],
                                                    "dim_provider": ["provider_npi"]})


_TABLES = ["fact_claims", "fact_remittance", "dim_member", "dim_provider", "dim_payer", "dim_procedure",
           "dim_date"]
_reg("dq_post_build", _post_build, "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, 'row_count' AS check_name, COUNT(*) AS value FROM {t}" for t in _TABLES]
    + ["SELECT 'fact_claims', 'null_claim_item_id', COUNT(*) FILTER (WHERE claim_item_id IS NULL) FROM fact_claims",
       "SELECT 'fact_claims', 'null_charge_amt', COUNT(*) FILTER (WHERE charge_amt IS NULL) FROM fact_claims",
       "SELECT 'dim_provider', 'null_provider_npi', COUNT(*) FILTER (WHERE provider_npi IS NULL) FROM dim_provider"]),
     _TABLES, "table_name, check_name, value:B")

_ROLE_SPEC = ("claim_item_id, claimant_id, provider_npi, payer_name, claim_code, service_date_key, charge_amt:D, "
              "allowed_amt:D, discount_amt:D, units, in_network, received_date, claim_status, service_month")
for _role, _salt in (("analyst", ""), ("scientist", "s3"), ("billing_manager", "s3"), ("engineer", "")):
    _hashed = "claimant_id" if _role == "engineer" else f"sha256('{_salt}' || CAST(claimant_id AS VARCHAR)) AS claimant_id"
    _reg(f"role_view_{_role}_fact",
         lambda s, d, role=_role, salt=_salt: Q.role_view(
             G.fact_claims(silver_from_tables(s, d)).drop("_loaded_at"), role, salt),
         f"SELECT * EXCLUDE (claimant_id), {_hashed} FROM fact_claims", ["fact_claims"], _ROLE_SPEC)


def _report_sql(group: str, cell: str, measures: dict[str, str], more: str = "", least: int = A.LEAST_PATIENTS) -> str:
    """The rules of withholding by lists: per parent, the names of the small children and of the cover."""
    facts = ", ".join(f"{e} AS {n}" for n, e in measures.items())
    names = ", ".join(f"CASE WHEN shown THEN {n} END AS {n}" for n in ("patients", *measures))
    return f"""
WITH src AS (SELECT *, {group} AS g, {cell} AS c FROM fact_claims),
total AS (SELECT COUNT(DISTINCT claimant_id) AS patients, {facts} FROM src),
by_group AS (SELECT g, COUNT(DISTINCT claimant_id) AS patients, {facts} FROM src GROUP BY g),
by_cell AS (SELECT g, c, COUNT(DISTINCT claimant_id) AS patients, {facts} FROM src GROUP BY g, c),
cover_group AS (SELECT COALESCE(g, '') AS name FROM by_group WHERE patients >= {least} AND EXISTS (SELECT 1 FROM by_group WHERE patients < {least})
                ORDER BY patients, g NULLS FIRST LIMIT 1),
open_group AS (SELECT g FROM by_group WHERE patients >= {least} AND COALESCE(g, '') NOT IN (SELECT name FROM cover_group)),
in_open AS (SELECT b.*, list({{'p': b.patients, 'c': COALESCE(b.c, '')}}) OVER (PARTITION BY b.g) AS family FROM by_cell b JOIN open_group o ON o.g IS NOT DISTINCT FROM b.g),
judged AS (
  SELECT g, c, patients >= {least} AND NOT (len(list_filter(family, lambda f: f.p < {least})) > 0
         AND COALESCE(c, '') = list_sort(list_filter(family, lambda f: f.p >= {least}))[1].c) AS shown FROM in_open),
report AS (
  SELECT 'all' AS level, CAST(NULL AS VARCHAR) AS g, CAST(NULL AS VARCHAR) AS c, patients >= {least} AS shown, * FROM total
  UNION ALL SELECT 'group', g, NULL, EXISTS (SELECT 1 FROM open_group o WHERE o.g IS NOT DISTINCT FROM b.g), * EXCLUDE (g) FROM by_group b
  UNION ALL SELECT 'cell', b.g, b.c, COALESCE(j.shown, false), b.* EXCLUDE (g, c)
            FROM by_cell b LEFT JOIN judged j ON j.g IS NOT DISTINCT FROM b.g AND j.c IS NOT DISTINCT FROM b.c)
SELECT *{more} FROM (SELECT level, g AS "group", c AS cell, shown, {names} FROM report)"""


_reg("role_report_billing_manager", lambda s, d: A.role_report(written_once(G.fact_claims(silver_from_tables(s, d)).select("service_month", "payer_name", "claimant_id", "charge_amt", "allowed_amt", "claim_status"), "fact"), "billing_manager"), _report_sql(
    "service_month", "payer_name", {"claims": "COUNT(*)", "total_charges": "SUM(charge_amt)", "total_paid": "SUM(allowed_amt)",
                                    "denied_claims": "COUNT(*) FILTER (WHERE claim_status = 'Denied')"},
    f", {O.r2('100 * denied_claims / NULLIF(claims, 0)')} AS denial_rate_pct"), ["fact_claims"],
     'level, "group", cell, shown, patients:B, claims:B, total_charges:D, total_paid:D, denied_claims:B, denial_rate_pct')
_reg("role_report_executive", lambda s, d: A.role_report(G.fact_claims(silver_from_tables(s, d)), "executive"), _report_sql(
    "year(received_date) || '-Q' || quarter(received_date)", "payer_name",
    {"claims": "COUNT(*)", "total_revenue": "SUM(charge_amt)", "total_adjustments": "SUM(discount_amt)"},
    f", total_revenue - total_adjustments AS net_reimbursement, {O.r2('100 * ((total_revenue - total_adjustments) / NULLIF(total_revenue, 0))')} AS payment_to_charge_pct"), ["fact_claims"],
     'level, "group", cell, shown, patients:B, claims:B, total_revenue:D, total_adjustments:D, net_reimbursement:D, payment_to_charge_pct')


# ------------------------------------------------------------ date readings
_SLASH = r"'^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$'"
_A, _B = (f"TRY_CAST(regexp_extract(received_date, {_SLASH}, {i}) AS INT)" for i in (1, 2))
_reg("dq_date_readings", lambda s, d: Q.date_readings(raw_claims(s, d), "received_date", ["type"]), f"""
SELECT type, CASE WHEN received_date IS NULL THEN NULL WHEN TRY_CAST(received_date AS DATE) IS NOT NULL THEN 'iso'
            WHEN regexp_matches(received_date, {_SLASH}) THEN
              list_extract(['ambiguous', 'either', 'month_first', 'day_first', 'unreadable'],
                           CASE WHEN {_A} > 12 THEN 4 + CAST({_B} > 12 AS INT) WHEN {_B} > 12 THEN 3 ELSE 1 + CAST({_A} = {_B} AS INT) END)
            WHEN {O.DATE_SQL} IS NOT NULL THEN 'other' ELSE 'unreadable' END AS reading, COUNT(*) AS lines
FROM raw GROUP BY ALL""", ["raw"], "type, reading, lines:B")


# ------------------------------------------------------ ingest of broken text
def _broken_text(spark, sf_dir):
    """The raw lines delivered as CSV and as JSON text, Medicare lines with a field too many
    or cut off, Group lines cut after three fields: every record, with its route and reason."""
    raw = raw_claims(spark, sf_dir)
    work = scratch_path(spark, f"broken-{uuid.uuid4().hex}")
    line, record = F.to_csv(F.struct(*RAW_COLUMNS)), F.to_json(F.struct(*RAW_COLUMNS))
    kind = F.coalesce("type", F.lit(""))
    comma = F.when(kind == "Medicare", F.concat(line, F.lit(",x"))).when(kind == "Group", F.array_join(F.slice(F.split(line, ","), 1, 3), ",")).otherwise(line)
    cut = F.when(kind == "Medicare", F.expr("substring(_json, 1, length(_json) - 1)")).otherwise(F.col("_json"))
    packed = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}  # a packed file is read by one task
    raw.select(comma).write.options(**packed).text(os.path.join(work, "csv"))
    raw.withColumn("_json", record).select(cut).write.options(**packed).text(os.path.join(work, "json"))
    parts = []
    for fmt in ("csv", "json"):
        ingest_batch(spark, os.path.join(work, fmt), os.path.join(work, f"bronze_{fmt}"), os.path.join(work, "audit", fmt), "20240101_120000", fmt, schema=RAW_SCHEMA, header=False)
        rows = spark.read.parquet(os.path.join(work, f"bronze_{fmt}"))
        unread = spark.read.parquet(os.path.join(work, "audit", fmt))
        name = F.split("record", ",")[1] if fmt == "csv" else F.regexp_extract("record", '"claim_item_id":"([^"]*)"', 1)
        parts += [rows.select(F.lit(fmt).alias("format"), F.lit("rows").alias("route"), F.col("claim_item_id").cast("string").alias("line"), F.lit(None).cast("string").alias("reason")),
                  unread.select(F.lit(fmt), F.lit("unread"), name, "reason")]
    return reduce(DataFrame.union, parts)


_reg("ingest_broken_text", _broken_text, """
SELECT 'csv' AS format, CASE WHEN type IN ('Medicare', 'Group') THEN 'unread' ELSE 'rows' END AS route, claim_item_id AS line,
       CASE type WHEN 'Medicare' THEN 'more fields than columns' WHEN 'Group' THEN 'fewer fields than columns' END AS reason FROM raw
UNION ALL
SELECT 'json', CASE WHEN type = 'Medicare' THEN 'unread' ELSE 'rows' END, claim_item_id, CASE type WHEN 'Medicare' THEN 'no JSON object' END FROM raw""",
     ["raw"], "format, route, line, reason")
