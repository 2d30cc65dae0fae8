"""Column lists, typed schemas, PHI tags and the data dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw claim line layout (20 text columns, table grain = claim_item_id).
RAW_COLUMNS = [
    "claimant_id", "claim_item_id", "type", "received_date", "charge_amt", "allowed_amt",
    "diag_code_1", "diag_code_2", "diag_code_3", "diag_code_4", "diag_code_5",
    "claim_code", "proc_desc", "claim_code_modifier", "claim_code_modifier_2", "units",
    "oi_in_network", "service_provider", "service_address_3", "service_address_2",
]
DIAG_COLUMNS = ["diag_code_1", "diag_code_2", "diag_code_3", "diag_code_4", "diag_code_5"]
# Diagnosis rank names of the bridge table, in column order.
DIAG_RANKS = ["PRIMARY", "SECONDARY", "TERTIARY", "FOURTH", "FIFTH"]
# The description column also arrives under this spreadsheet name.
PROC_DESC_ALIASES = {"rev_code/procedure_description": "proc_desc"}
# The duplicate key of a claim line.
DUPLICATE_KEY = ["claimant_id", "received_date", "claim_code", "charge_amt"]
REQUIRED_RAW = ["claimant_id", "claim_item_id", "received_date", "charge_amt",
                "allowed_amt", "claim_code", "units"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

MONEY = T.DecimalType(18, 2)
# wider than the documented BIGINT: the fixture's ids have up to 38 digits
CLAIM_ID = T.DecimalType(38, 0)

FACT_CLAIMS_SCHEMA = T.StructType([
    T.StructField("claim_item_id", CLAIM_ID),
    T.StructField("claimant_id", T.LongType()),
    T.StructField("provider_npi", T.StringType()),
    T.StructField("payer_name", T.StringType()),
    T.StructField("claim_code", T.StringType()),
    T.StructField("service_date_key", T.IntegerType()),
    T.StructField("charge_amt", MONEY),
    T.StructField("allowed_amt", MONEY),
    T.StructField("discount_amt", T.DecimalType(19, 2)),
    T.StructField("units", T.IntegerType()),
    T.StructField("in_network", T.BooleanType()),
    T.StructField("received_date", T.DateType()),
    T.StructField("claim_status", T.StringType()),
    T.StructField("service_month", T.StringType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

# PHI classification per column (drives role-scoped projections, D16).
PHI_TAGS = {
    "claimant_id": "PHI",
    "member_id": "PHI",
    "hashed_patient_id": "masked",
    "service_address_3": "PII",
    "service_address_2": "PII",
    "provider_street": "PII",
    "diag_code_1": "PHI", "diag_code_2": "PHI", "diag_code_3": "PHI",
    "diag_code_4": "PHI", "diag_code_5": "PHI",
    "icd10_code": "PHI",
    "primary_diagnosis": "PHI", "secondary_diagnosis_1": "PHI", "secondary_diagnosis_2": "PHI",
    "secondary_diagnosis_3": "PHI", "secondary_diagnosis_4": "PHI",
}

# Columns that say nothing about a person by themselves. A column that is neither here
# nor in PHI_TAGS is unknown, and role views withhold it.
OPEN_COLUMNS = frozenset("""
    claim_item_id claim_id type claim_type payer_name claim_code procedure_code proc_desc procedure_desc code_type
    claim_code_modifier claim_code_modifier_2 modifier_1 modifier_2 carc_code rarc_code adjustment_reason adjustment_seq
    adjustment_code diag_rank units oi_in_network in_network in_network_flag service_provider provider_npi provider_name
    specialty city state charge_amt allowed_amt discount_amt discount_pct total_charges payment_amount claim_status
    received_date service_date_key service_month year month quarter is_valid has_negative_charge has_negative_allowed
    has_missing_provider has_npi
""".split())

# Business descriptions (D17); columns not listed get an empty description.
COLUMN_DESCRIPTIONS = {
    "claim_item_id": "Claim line identifier; grain of fact_claims.",
    "claimant_id": "Member identifier (PHI; masked for analysts).",
    "provider_npi": "National Provider Identifier parsed from the service address.",
    "payer_name": "Payer / plan type of the claim.",
    "claim_code": "CPT or HCPCS procedure code.",
    "charge_amt": "Amount billed by the provider.",
    "allowed_amt": "Amount the payer allowed.",
    "discount_amt": "charge_amt - allowed_amt: contractual write-off before patient responsibility.",
    "units": "Service units billed.",
    "in_network": "True when the provider is in the payer network.",
    "received_date": "Date the claim line was received.",
    "service_date_key": "yyyyMMdd key into dim_date.",
    "service_month": "yyyy-MM partition of fact_claims.",
    "claim_status": "Denied when nothing was allowed on a positive charge, else Paid.",
}

TABLE_DESCRIPTIONS = {
    "fact_claims": "Claim line items (one row per line), partitioned by service_month.",
    "fact_remittance": "Payment and adjustment codes per claim line (1:N).",
    "dim_member": "Distinct members.",
    "dim_provider": "Providers by NPI, name, city and state.",
    "dim_payer": "Distinct payers.",
    "dim_procedure": "Procedure codes with description and code type.",
    "dim_date": "Calendar and fiscal attributes per day.",
}
