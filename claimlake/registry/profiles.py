"""Cleaning profiles, duplicate handling and notebook marts (P9-P18, P29,
W1, W2, S15, G3, G11, M1-M7): Spark builders and DuckDB oracles."""

from __future__ import annotations

import uuid

from claimlake import oracle as O
from claimlake.operators import dedup as D, star as G
from claimlake.operators.cleaning import clean_claims
from claimlake.plans import marts as M
from claimlake.plans.pipeline import silver_from_tables
from claimlake.registry import register, select_typed, written_once
from claimlake.session import scratch_path
from claimlake.sources.fixture import raw_claims

r2, pct = O.r2, O.pct
RAW_TEXT = ["diag_code_1", "diag_code_2", "diag_code_3", "diag_code_4", "diag_code_5", "claim_code",
            "proc_desc", "claim_code_modifier", "claim_code_modifier_2", "oi_in_network",
            "service_provider", "service_address_3", "service_address_2"]
MONEY = {"charge_amt", "allowed_amt", "discount_amt"}


def _spec(cols) -> str:
    return ", ".join(c + (":D" if c in MONEY else "") for c in cols)


def _reg(name: str, fn, body: str, deps, cols_or_spec) -> None:
    spec = cols_or_spec if isinstance(cols_or_spec, str) else _spec(cols_or_spec)
    O.cte(name, body, deps)
    register(name, O.query(select_typed(name, spec), [name]))(fn)


# ------------------------------------------------------------ doc profile
DOC_COLS = ["claimant_id", "claim_item_id", "type", "received_date", "charge_amt", "allowed_amt",
            *RAW_TEXT, "units", "provider_npi", "city", "state", "discount_amt", "is_valid"]


def _silver_doc(spark, sf_dir):
    """Lines are derived and written once: the removal of duplicates reads them several times."""
    return clean_claims(written_once(raw_claims(spark, sf_dir), "claims"), profile="doc", batch_id="fixture")


_reg("silver_claims_doc", lambda s, d: _silver_doc(s, d).select(*DOC_COLS),
     "SELECT * FROM silver_doc", ["silver_doc"], DOC_COLS)

# ------------------------------------------------------- notebook profile
NB_COLS = ["claimant_id", "claim_item_id", "type", "received_date", "charge_amt", "allowed_amt",
           *RAW_TEXT, "units", "discount_amt", "discount_pct", "claim_type", "provider_street",
           "provider_npi", "city", "state", "in_network_flag", "year", "month"]
_reg("silver_claims_notebook", lambda s, d: silver_from_tables(s, d, "notebook").select(*NB_COLS),
     "SELECT * FROM silver_nb", ["silver_nb"], NB_COLS)

# ----------------------------------------------------------- duplicates
KEY = "claimant_id, received_date, claim_code, charge_amt"
SILVER_KEYED = ["claim_item_id", "claimant_id", "received_date", "claim_code", "charge_amt", "allowed_amt"]

_reg("dedup_keep_first",
     lambda s, d: D.keep_first(silver_from_tables(s, d), columns=SILVER_KEYED),
     f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY}
            ORDER BY claim_item_id NULLS LAST, type NULLS LAST, allowed_amt NULLS LAST, diag_code_1 NULLS LAST,
                     diag_code_2 NULLS LAST, diag_code_3 NULLS LAST, diag_code_4 NULLS LAST, diag_code_5 NULLS LAST,
                     proc_desc NULLS LAST) AS rn FROM silver) WHERE rn = 1""",
     ["silver"], SILVER_KEYED)

_reg("duplicate_quarantine",
     lambda s, d: D.quarantine(silver_from_tables(s, d)).select(*SILVER_KEYED),
     f"""SELECT * FROM (SELECT *, COUNT(*) OVER (PARTITION BY {KEY}) AS n FROM silver) WHERE n > 1""",
     ["silver"], SILVER_KEYED)

_reg("duplicate_flags",
     lambda s, d: D.flag_duplicates(silver_from_tables(s, d)).select(*SILVER_KEYED, "is_duplicate"),
     f"""SELECT *, COUNT(*) OVER (PARTITION BY {KEY}) > 1 AS is_duplicate FROM silver""",
     ["silver"], SILVER_KEYED + ["is_duplicate"])

# ------------------------------------------------------- notebook star
O.cte("fact_items", """
SELECT claim_item_id, claimant_id, received_date, claim_type, charge_amt, allowed_amt, discount_amt,
       discount_pct, units, oi_in_network, claim_code, claim_code_modifier, claim_code_modifier_2,
       provider_npi, oi_in_network = 'Y' AS in_network_flag
FROM silver_nb""", ["silver_nb"])


def _items(spark, sf_dir):
    return G.fact_claim_items(silver_from_tables(spark, sf_dir, "notebook"))


ITEM_COLS = ["claim_item_id", "claimant_id", "received_date", "claim_type", "charge_amt", "allowed_amt",
             "discount_amt", "discount_pct", "units", "oi_in_network", "claim_code", "claim_code_modifier",
             "claim_code_modifier_2", "provider_npi", "in_network_flag"]
register("fact_claim_items", O.query(select_typed("fact_items", _spec(ITEM_COLS)), ["fact_items"]))(
    lambda s, d: _items(s, d).select(*ITEM_COLS))

_reg("dim_provider_notebook",
     lambda s, d: G.dim_provider_notebook(silver_from_tables(s, d, "notebook")),
     """SELECT DISTINCT provider_npi, service_provider, provider_street, city, state FROM silver_nb
        WHERE provider_npi IS NOT NULL""", ["silver_nb"],
     "provider_npi, service_provider, provider_street, city, state")

_reg("bridge_diagnosis_notebook",
     lambda s, d: G.bridge_diagnosis(silver_from_tables(s, d, "notebook")),
     """SELECT * FROM (
          SELECT claim_item_id, 'PRIMARY' AS diag_rank, diag_code_1 AS icd10_code FROM silver_nb UNION ALL
          SELECT claim_item_id, 'SECONDARY', diag_code_2 FROM silver_nb UNION ALL
          SELECT claim_item_id, 'TERTIARY', diag_code_3 FROM silver_nb UNION ALL
          SELECT claim_item_id, 'FOURTH', diag_code_4 FROM silver_nb UNION ALL
          SELECT claim_item_id, 'FIFTH', diag_code_5 FROM silver_nb)
        WHERE icd10_code IS NOT NULL AND icd10_code <> ''""", ["silver_nb"],
     "claim_item_id, diag_rank, icd10_code")

# ---------------------------------------------------------------- marts
MEAN_PCT = r2("AVG(CAST(discount_pct AS DECIMAL(10,2)))")

_reg("mart_monthly_summary", lambda s, d: M.monthly_summary(_items(s, d)), f"""
SELECT strftime(received_date, '%Y-%m') AS year_month, claim_type, COUNT(claim_item_id) AS total_claims,
       COUNT(DISTINCT claimant_id) AS unique_patients, COALESCE(SUM(charge_amt), 0) AS total_charged,
       COALESCE(SUM(allowed_amt), 0) AS total_allowed, COALESCE(SUM(discount_amt), 0) AS total_discount,
       {MEAN_PCT} AS avg_discount_pct,
       {pct('SUM(CAST(in_network_flag AS INT))', 'COUNT(*)')} AS in_network_percentage
FROM fact_items WHERE received_date IS NOT NULL AND claim_type IS NOT NULL GROUP BY 1, 2""", ["fact_items"],
     "year_month, claim_type, total_claims:B, unique_patients:B, total_charged:D, total_allowed:D, "
     "total_discount:D, avg_discount_pct, in_network_percentage")

O.cte("mart_provider_summary_q", f"""
SELECT provider_npi, COUNT(claim_item_id) AS total_claims, COUNT(DISTINCT claimant_id) AS unique_patients,
       COALESCE(SUM(charge_amt), 0) AS total_charged, COALESCE(SUM(allowed_amt), 0) AS total_allowed,
       {MEAN_PCT} AS avg_discount_pct
FROM fact_items WHERE provider_npi IS NOT NULL GROUP BY 1""", ["fact_items"])
_PS = "provider_npi, total_claims:B, unique_patients:B, total_charged:D, total_allowed:D, avg_discount_pct"
register("mart_provider_summary", O.query(select_typed("mart_provider_summary_q", _PS),
                                          ["mart_provider_summary_q"]))(
    lambda s, d: M.provider_summary(_items(s, d)))

_reg("mart_diagnosis_summary", lambda s, d: M.diagnosis_summary(silver_from_tables(s, d, "notebook")), """
SELECT icd10_code, diag_rank, COUNT(*) AS frequency FROM bridge_diagnosis_notebook
GROUP BY 1, 2 ORDER BY frequency DESC, icd10_code, diag_rank LIMIT 20""", ["bridge_diagnosis_notebook"],
     "icd10_code, diag_rank, frequency:B")

_reg("mart_key_metrics", lambda s, d: M.key_metrics(_items(s, d)), f"""
SELECT metric, value FROM (
  SELECT CAST(COALESCE(SUM(allowed_amt), 0) AS DOUBLE) AS total_allowed_amount,
         CAST(COUNT(*) AS DOUBLE) AS total_claims_processed,
         {r2('COALESCE(SUM(allowed_amt), 0) / NULLIF(COUNT(*), 0)')} AS average_claim_value,
         {r2('SUM(CAST(in_network_flag AS INT)) * 100.0 / NULLIF(COUNT(*), 0)')} AS in_network_rate,
         CAST(COUNT(DISTINCT claimant_id) AS DOUBLE) AS unique_patients,
         CAST(COUNT(DISTINCT claim_type) AS DOUBLE) AS unique_claim_types
  FROM fact_items)
UNPIVOT (value FOR metric IN (total_allowed_amount, total_claims_processed, average_claim_value,
                              in_network_rate, unique_patients, unique_claim_types))""", ["fact_items"],
     "metric, value")

# The types shown in columns of their own; the rest are summed as "other".
CLAIM_TYPES = ["MEDICARE", "GROUP", "COVID_TEST", "MENTAL_HEALTH", "UNKNOWN"]
_reg("mart_monthly_type_pivot", lambda s, d: M.monthly_type_pivot(_items(s, d), CLAIM_TYPES),
     "SELECT strftime(received_date, '%Y-%m') AS year_month, " + ", ".join(
         f"SUM(CASE WHEN claim_type = '{t}' THEN allowed_amt END) AS allowed_{t.lower()}" for t in CLAIM_TYPES)
     + f", SUM(CASE WHEN claim_type NOT IN ({', '.join(map(repr, CLAIM_TYPES))}) THEN allowed_amt END) AS allowed_other"
     + " FROM fact_items WHERE received_date IS NOT NULL AND claim_type IS NOT NULL GROUP BY 1",
     ["fact_items"], "year_month, " + ", ".join(f"allowed_{t.lower()}:D" for t in [*CLAIM_TYPES, "other"]))

_reg("mart_top_providers", lambda s, d: M.top_providers_by_allowed(_items(s, d)), """
SELECT * FROM mart_provider_summary_q ORDER BY total_allowed DESC, provider_npi LIMIT 10""",
     ["mart_provider_summary_q"], _PS)

_reg("mart_discount_histogram", lambda s, d: M.discount_histogram(_items(s, d)), f"""
WITH pos AS (SELECT discount_pct FROM fact_items WHERE discount_pct > 0),
     bounded AS (SELECT discount_pct, (SELECT MIN(discount_pct) FROM pos) AS lo,
                        (SELECT MAX(discount_pct) FROM pos) AS hi FROM pos),
     binned AS (SELECT CAST(CASE WHEN hi = lo THEN 0
                                 ELSE least(floor((discount_pct - lo) * 30.0 / (hi - lo)), 29) END AS INT) AS bin,
                       lo, hi FROM bounded)
SELECT bin, lo + bin * ((hi - lo) / 30.0) AS bin_start, lo + (bin + 1) * ((hi - lo) / 30.0) AS bin_end,
       COUNT(*) AS frequency
FROM binned GROUP BY bin, lo, hi""", ["fact_items"], "bin, bin_start, bin_end, frequency:B")

_reg("mart_discount_stats", lambda s, d: M.discount_stats(_items(s, d)), f"""
SELECT {MEAN_PCT} AS mean_discount_pct, ROUND(quantile_cont(discount_pct, 0.5), 2) AS median_discount_pct,
       COUNT(*) AS positive_discount_lines
FROM fact_items WHERE discount_pct > 0""", ["fact_items"],
     "mean_discount_pct, median_discount_pct, positive_discount_lines:B")


def _quantiles_sql(column: str, src: str) -> str:
    """Value by rank in a sorted list, in proportion between neighbours."""
    shown = ", ".join(f"CAST(v[a{i}] AS DOUBLE) + (p{i} - floor(p{i})) * (CAST(v[b{i}] AS DOUBLE) - CAST(v[a{i}] AS DOUBLE)) AS {n}" for i, n in enumerate(M.AMOUNT_SHARES))
    places = ", ".join(f"{s} * (len(v) - 1) AS p{i}, CAST(floor({s} * (len(v) - 1)) AS BIGINT) + 1 AS a{i}, CAST(ceil({s} * (len(v) - 1)) AS BIGINT) + 1 AS b{i}" for i, s in enumerate(M.AMOUNT_SHARES.values()))
    return f"SELECT '{column}' AS column_name, {shown} FROM (SELECT v, {places} FROM (SELECT list_sort(list({column})) AS v FROM {src} WHERE {column} IS NOT NULL))"


_QUANTILE_SPEC = "column_name, " + ", ".join(M.AMOUNT_SHARES)
_AMOUNTS = ("charge_amt", "allowed_amt", "discount_amt")


def _amount_quantiles(spark, sf_dir):
    """Written once: every pass of the refinement reads one column of it."""
    path = scratch_path(spark, f"amounts-{uuid.uuid4().hex}")
    _items(spark, sf_dir).select(*_AMOUNTS).write.parquet(path)
    return M.amount_quantiles(spark.read.parquet(path), _AMOUNTS)


_reg("mart_amount_quantiles", _amount_quantiles,
     "\nUNION ALL\n".join(_quantiles_sql(c, "fact_items") for c in _AMOUNTS), ["fact_items"], _QUANTILE_SPEC)
_reg("mart_discount_quantiles", lambda s, d: M.discount_quantiles(written_once(_items(s, d).select("discount_pct"), "discounts")),
     _quantiles_sql("discount_pct", "(SELECT * FROM fact_items WHERE discount_pct > 0)"), ["fact_items"], _QUANTILE_SPEC)

_reg("mart_claim_type_share", lambda s, d: M.claim_type_share(_items(s, d)), f"""
SELECT claim_type, COUNT(*) AS claims,
       {r2('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM fact_items WHERE claim_type IS NOT NULL)')} AS share_pct
FROM fact_items WHERE claim_type IS NOT NULL GROUP BY 1""", ["fact_items"], "claim_type, claims:B, share_pct")

_reg("mart_pipeline_summary",
     lambda s, d: M.pipeline_summary(raw_claims(s, d), silver_from_tables(s, d, "notebook")), """
SELECT 'raw' AS layer, 'claims' AS table_name, COUNT(*) AS rows, 20 AS columns FROM raw
UNION ALL SELECT 'bronze', 'claims', COUNT(*), 20 FROM raw
UNION ALL SELECT 'silver', 'fact_claim_items', COUNT(*), 17 FROM fact_items
UNION ALL SELECT 'silver', 'dim_provider', COUNT(*), 5 FROM dim_provider_notebook
UNION ALL SELECT 'silver', 'bridge_diagnosis', COUNT(*), 3 FROM bridge_diagnosis_notebook
UNION ALL SELECT 'gold', 'monthly_summary', COUNT(*), 9 FROM mart_monthly_summary
UNION ALL SELECT 'gold', 'provider_summary', COUNT(*), 6 FROM mart_provider_summary_q""",
     ["raw", "fact_items", "dim_provider_notebook", "bridge_diagnosis_notebook", "mart_monthly_summary",
      "mart_provider_summary_q"], 'layer, table_name, rows:B, columns:I')


def _payer_mix(spark, sf_dir):
    silver = written_once(silver_from_tables(spark, sf_dir), "silver")
    return M.payer_mix(G.fact_claims(silver), G.fact_remittance_long(silver))


_reg("mart_payer_mix", _payer_mix, f"""
SELECT f.payer_name, COUNT(*) AS total_claims,
       {r2('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM fact_claims)')} AS claim_share_pct,
       SUM(f.charge_amt) AS total_charges,
       {r2('SUM(f.charge_amt) / (SELECT SUM(charge_amt) FROM fact_claims) * 100')} AS charge_share_pct,
       SUM(f.discount_amt) AS total_adjustments,
       SUM(f.charge_amt) - SUM(f.discount_amt) AS net_reimbursement,
       COALESCE(SUM(r.adjustment_codes), 0) AS adjustment_codes
FROM fact_claims f LEFT JOIN (SELECT claim_id, COUNT(*) AS adjustment_codes FROM fact_remittance_long_q
                              GROUP BY claim_id) r ON r.claim_id = f.claim_item_id
GROUP BY f.payer_name""", ["fact_claims", "fact_remittance_long_q"],
     "payer_name, total_claims:B, claim_share_pct, total_charges:D, charge_share_pct, total_adjustments:D, "
     "net_reimbursement:D, adjustment_codes:B")

# ------------------------------------------------ Gold from the doc profile
O.cte("fact_claims_doc_q", O.FACT.replace("FROM silver WHERE is_valid", "FROM silver_doc WHERE is_valid"),
      ["silver_doc"])
register("fact_claims_doc", O.query(select_typed("fact_claims_doc_q", _spec([
    "claim_item_id", "claimant_id", "provider_npi", "payer_name", "claim_code", "service_date_key",
    "charge_amt", "allowed_amt", "discount_amt", "units", "in_network", "received_date", "claim_status",
    "service_month"])), ["fact_claims_doc_q"]))(
    lambda s, d: G.fact_claims(_silver_doc(s, d)).drop("_loaded_at"))
