"""Silver and Gold tables (P*, G1-G15): Spark builders and DuckDB oracles.

Clock columns (``_cleaned_at``, ``_loaded_at``) are left out of the compared
projections: they differ per run by design.
"""

from __future__ import annotations

from claimlake import oracle as O
from claimlake.operators import star as G
from claimlake.plans.pipeline import silver_from_tables
from claimlake.registry import register, select_typed
from claimlake.sources.writers import stage

SILVER_COLS = [
    "claimant_id", "claim_item_id", "type", "received_date", "charge_amt", "allowed_amt",
    "diag_code_1", "diag_code_2", "diag_code_3", "diag_code_4", "diag_code_5", "claim_code",
    "proc_desc", "claim_code_modifier", "claim_code_modifier_2", "units", "oi_in_network",
    "service_provider", "service_address_3", "service_address_2", "claim_type", "modifier_1",
    "modifier_2", "provider_npi", "city", "state", "discount_amt", "discount_pct", "year", "month",
    "quarter", "has_negative_charge", "has_negative_allowed", "has_missing_provider", "has_npi",
    "is_valid", "_validation_status",
]

O.cte("silver_out", """
SELECT *, CASE WHEN is_valid THEN 'PASS' ELSE 'FAIL' END AS _validation_status FROM silver""", ["silver"])


@register("silver_claims", O.query(select_typed(
    "silver_out", ", ".join(c + (":D" if c in ("charge_amt", "allowed_amt", "discount_amt") else "")
                            for c in SILVER_COLS)), ["silver_out"]))
def _silver(spark, sf_dir):
    return silver_from_tables(spark, sf_dir).select(*SILVER_COLS)


def _gold(name: str, builder, oracle_body: str, deps, spec: str, drop=("_loaded_at",)):
    O.cte(name + "_q", oracle_body, deps)

    @register(name, O.query(select_typed(name + "_q", spec), [name + "_q"]))
    def _fn(spark, sf_dir):
        return builder(silver_from_tables(spark, sf_dir)).drop(*drop)
    return _fn


_gold("fact_claims", G.fact_claims, "SELECT * FROM fact_claims", ["fact_claims"],
      "claim_item_id, claimant_id, provider_npi, payer_name, claim_code, service_date_key, charge_amt:D, "
      "allowed_amt:D, discount_amt:D, units, in_network, received_date, claim_status, service_month")

_gold("fact_claims_orchestrated", G.fact_claims_orchestrated, """
SELECT claim_item_id AS claim_id, claimant_id AS member_id, provider_npi, type AS payer_name,
       claim_code AS procedure_code, CAST(strftime(received_date, '%Y%m%d') AS INT) AS service_date_key,
       CAST(charge_amt AS DECIMAL(18,2)) AS total_charges, CAST(allowed_amt AS DECIMAL(18,2)) AS allowed_amt,
       units AS units_count, COALESCE(upper(oi_in_network) = 'Y', false) AS in_network,
       strftime(received_date, '%Y-%m') AS service_month
FROM silver""", ["silver"],
      "claim_id, member_id, provider_npi, payer_name, procedure_code, service_date_key, total_charges:D, "
      "allowed_amt:D, units_count, in_network, service_month")

_gold("dim_member", G.dim_member, "SELECT * FROM dim_member", ["dim_member"], "member_id")
_gold("dim_provider", G.dim_provider, "SELECT * FROM dim_provider", ["dim_provider"],
      "provider_npi, provider_name, city, state, specialty")
_gold("dim_payer", G.dim_payer, "SELECT * FROM dim_payer", ["dim_payer"], "payer_name")
_gold("dim_procedure", G.dim_procedure, "SELECT * FROM dim_procedure", ["dim_procedure"],
      "claim_code, procedure_desc, code_type")
_gold("dim_claimant", G.dim_claimant, "SELECT DISTINCT claimant_id, claim_type FROM silver", ["silver"],
      "claimant_id, claim_type")
_gold("fact_remittance", G.fact_remittance, "SELECT * FROM fact_remittance", ["fact_remittance"],
      "claim_id, payment_amount:D, carc_code, rarc_code, adjustment_reason")
_gold("fact_remittance_long", G.fact_remittance_long, """
SELECT claim_item_id AS claim_id, 1 AS adjustment_seq, claim_code_modifier AS adjustment_code
FROM silver WHERE claim_code_modifier IS NOT NULL
UNION ALL
SELECT claim_item_id, 2, claim_code_modifier_2 FROM silver WHERE claim_code_modifier_2 IS NOT NULL""",
      ["silver"], "claim_id, adjustment_seq:I, adjustment_code")
_gold("bridge_diagnosis", G.bridge_diagnosis, """
SELECT * FROM (
  SELECT claim_item_id, 'PRIMARY' AS diag_rank, diag_code_1 AS icd10_code FROM silver UNION ALL
  SELECT claim_item_id, 'SECONDARY', diag_code_2 FROM silver UNION ALL
  SELECT claim_item_id, 'TERTIARY', diag_code_3 FROM silver UNION ALL
  SELECT claim_item_id, 'FOURTH', diag_code_4 FROM silver UNION ALL
  SELECT claim_item_id, 'FIFTH', diag_code_5 FROM silver)
WHERE icd10_code IS NOT NULL AND icd10_code <> ''""", ["silver"], "claim_item_id, diag_rank, icd10_code")
_gold("dim_provider_unique", G.dim_provider_unique, """
SELECT provider_npi, p.provider_name, p.city, p.state FROM (
  SELECT provider_npi,
         arg_min(struct_pack(provider_name := service_provider, city := city, state := state),
                 struct_pack(a := service_provider IS NULL, b := service_provider, c := city IS NULL,
                             d := city, e := state IS NULL, f := state)) AS p
  FROM silver WHERE provider_npi IS NOT NULL GROUP BY provider_npi)""", ["silver"],
      "provider_npi, provider_name, city, state", drop=())


_gold("staging_claims", stage, """
SELECT claim_item_id, claimant_id, claim_code, provider_npi, service_provider, city, state, type,
       CAST(charge_amt AS DOUBLE) AS charge_amt, CAST(allowed_amt AS DOUBLE) AS allowed_amt, units,
       strftime(received_date, '%Y-%m-%d') AS received_date, oi_in_network, proc_desc,
       claim_code_modifier, claim_code_modifier_2
FROM silver""", ["silver"],
      "claim_item_id, claimant_id, claim_code, provider_npi, service_provider, city, state, type, charge_amt, "
      "allowed_amt, units, received_date, oi_in_network, proc_desc, claim_code_modifier, claim_code_modifier_2",
      drop=())
