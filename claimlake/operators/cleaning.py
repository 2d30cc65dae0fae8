"""Silver cleaning: typing, parsing, flags and metadata for claim lines.

``clean_claims(df, profile)`` is one projection (plus, for the ``doc``
profile, one duplicate removal, which reads ``df`` three times), built only from Spark SQL
built-ins, so the whole step stays in whole-stage codegen and has no Python
worker in its plan.

Profiles (the same step is defined three ways by the reference):

* ``lambda`` (default): NPI with fallback, claim type upper-cased with blank ->
  UNKNOWN, unparseable money -> 0, units -> 1, ``is_valid`` = non-negative money
  and positive units. Duplicates are kept.
* ``doc``: strict ten-digit NPI, city/state split at the last comma, missing
  TYPE imputed from the code, duplicates removed (lowest claim_item_id kept),
  claimant id SHA-256 masked, ``is_valid`` = charge and date present.
* ``notebook``: NPI = text after ``' - '``, negatives clipped to 0, claim type
  inferred from code, description and modifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimlake import functions as X
from claimlake.schema import PROC_DESC_ALIASES, REQUIRED_RAW

PROFILES = ("lambda", "doc", "notebook")

# Fixed values of the claim-type rules.
MENTAL_HEALTH_CODES = ["90837", "90834", "90853"]
MEDICARE_CODE_PREFIXES = ("9", "G")


# ---------------------------------------------------------------- P1, P31, P32
def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names, spaces -> '_' (P1); spreadsheet aliases renamed."""
    names = [c.lower().replace(" ", "_") for c in df.columns]
    names = [PROC_DESC_ALIASES.get(n, n) if PROC_DESC_ALIASES.get(n, n) not in names else n
             for n in names]
    return df.toDF(*names)


def require_columns(df: DataFrame, cols=REQUIRED_RAW) -> DataFrame:
    """Raise listing the missing columns (P31); returns ``df`` unchanged."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def select_available(df: DataFrame, cols) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    return df.select([c for c in cols if c in df.columns])


def _ensure(df: DataFrame, cols) -> DataFrame:
    """Add absent optional raw columns as typed NULL text."""
    missing = {c: F.lit(None).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


OPTIONAL_RAW = ["type", "claim_code_modifier", "claim_code_modifier_2", "oi_in_network",
                "service_provider", "service_address_3", "service_address_2", "proc_desc",
                "diag_code_1", "diag_code_2", "diag_code_3", "diag_code_4", "diag_code_5"]


# ------------------------------------------------------------------ profiles
def _upper_or_empty(c: str) -> Column:
    return F.upper(F.coalesce(F.col(c), F.lit("")))


def _network_flag(c: str) -> Column:
    """NULL -> 'N'; upper-case; 'Y' stays, anything else -> 'N' (P6)."""
    return F.when(F.upper(F.col(c)) == "Y", F.lit("Y")).otherwise(F.lit("N"))


def _discount_pct(charge: Column, discount: Column) -> Column:
    """round(discount / charge * 100, 2) when charge > 0, else 0 (P20)."""
    return F.when(charge > 0, X.round2(discount / charge * 100)).otherwise(F.lit(0.0))


def _silver_lambda(df: DataFrame, batch_id: str | None) -> DataFrame:
    charge, allowed = F.col("charge_amt"), F.col("allowed_amt")
    typed = df.withColumns({
        "received_date": X.to_date_lenient(F.col("received_date")),
        "claimant_id": X.to_long(F.col("claimant_id")),
        "claim_item_id": X.to_claim_id(F.col("claim_item_id")),
        "charge_amt": X.money_or_zero(charge),
        "allowed_amt": X.money_or_zero(allowed),
        "units": X.to_int_truncated(F.col("units"), default=1),
    })
    city, state = X.city_state_first_comma(F.col("service_address_2"))
    d = F.col("received_date")
    parsed = typed.withColumns({
        "oi_in_network": _network_flag("oi_in_network"),
        "claim_type": F.coalesce(F.nullif(F.upper(F.col("type")), F.lit("")), F.lit("UNKNOWN")),
        "modifier_1": _upper_or_empty("claim_code_modifier"),
        "modifier_2": _upper_or_empty("claim_code_modifier_2"),
        "provider_npi": X.npi_with_fallback(F.col("service_address_3")),
        "city": city,
        "state": state,
        "discount_amt": charge - allowed,
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
    })
    flagged = parsed.withColumns({
        "discount_pct": _discount_pct(charge, F.col("discount_amt")),
        "has_negative_charge": charge < 0,
        "has_negative_allowed": allowed < 0,
        "has_missing_provider": F.col("service_provider").isNull(),
        "has_npi": F.col("provider_npi").isNotNull(),
        "is_valid": F.coalesce((charge >= 0) & (allowed >= 0) & (F.col("units") > 0), F.lit(False)),
    })
    return _add_validation_metadata(flagged, batch_id)


def impute_type(code: Column, type_col: Column) -> Column:
    """NULL TYPE -> 'Medicare' when the code starts with 9 or G, else 'Group' (P9)."""
    medicare = F.coalesce(code, F.lit("None")).startswith(MEDICARE_CODE_PREFIXES[0]) | \
        F.coalesce(code, F.lit("None")).startswith(MEDICARE_CODE_PREFIXES[1])
    return F.coalesce(type_col, F.when(medicare, F.lit("Medicare")).otherwise(F.lit("Group")))


def _silver_doc(df: DataFrame, batch_id: str | None, mask: str | None) -> DataFrame:
    from claimlake.operators.dedup import keep_first

    typed = df.withColumns({
        "received_date": X.to_date_lenient(F.col("received_date")),
        "claim_item_id": X.to_claim_id(F.col("claim_item_id")),
        "charge_amt": X.to_money(F.col("charge_amt")),
        "allowed_amt": X.to_money(F.col("allowed_amt")),
        "units": X.to_int_truncated(F.col("units")),
    })
    deduped = keep_first(typed, sparse=True)
    city, state = X.city_state_last_comma(F.col("service_address_2"))
    out = deduped.withColumns({
        "provider_npi": X.npi_strict(F.col("service_address_3")),
        "city": city,
        "state": state,
        "type": impute_type(F.col("claim_code"), F.col("type")),
    })
    masker = X.MASKERS.get(mask or "sha256")
    if mask != "none":
        out = out.withColumn("claimant_id", masker(F.col("claimant_id")))
    out = out.withColumns({
        "claim_type": F.upper(F.col("type")),
        "discount_amt": F.col("charge_amt") - F.col("allowed_amt"),
        "is_valid": F.col("charge_amt").isNotNull() & F.col("received_date").isNotNull(),
    })
    return _add_validation_metadata(out, batch_id)


def infer_claim_type(type_col: Column, code: Column, desc: Column, modifier: Column) -> Column:
    """Keep a non-blank TYPE; else U* -> COVID_TEST, listed psychotherapy codes ->
    MENTAL_HEALTH, 'therapy' in the description (any case) or 'PT' in the
    modifier -> PHYSICAL_THERAPY, else UNKNOWN (P10)."""
    code_s = F.coalesce(code, F.lit("nan"))
    desc_s = F.lower(F.coalesce(desc, F.lit("nan")))
    mod_s = F.coalesce(modifier, F.lit("nan"))
    return (F.when(type_col.isNotNull() & (type_col != ""), type_col)
            .when(code_s.startswith("U"), F.lit("COVID_TEST"))
            .when(code_s.isin(MENTAL_HEALTH_CODES), F.lit("MENTAL_HEALTH"))
            .when(desc_s.contains("therapy") | mod_s.contains("PT"), F.lit("PHYSICAL_THERAPY"))
            .otherwise(F.lit("UNKNOWN")))


def _silver_notebook(df: DataFrame, batch_id: str | None) -> DataFrame:
    charge, allowed = F.col("charge_amt"), F.col("allowed_amt")
    if "_ingested_at" not in df.columns:
        df = add_ingestion_metadata(df, source_file="claims")
    bronze = df.withColumns({
        "received_date": X.to_date_lenient(F.col("received_date")),
        "claimant_id": X.to_long(F.col("claimant_id")),
        "claim_item_id": X.to_claim_id(F.col("claim_item_id")),
        "charge_amt": X.clip_negative(X.to_money(charge)),
        "allowed_amt": X.clip_negative(X.to_money(allowed)),
        "units": X.to_int_truncated(F.col("units"), default=1),
        "type": _upper_or_empty("type"),
        "claim_code_modifier": _upper_or_empty("claim_code_modifier"),
        "claim_code_modifier_2": _upper_or_empty("claim_code_modifier_2"),
        "oi_in_network": _upper_or_empty("oi_in_network"),
    })
    city, state = X.city_state_two_chars(F.col("service_address_2"))
    addr3 = F.col("service_address_3")
    blank3 = addr3.isNull() | (addr3 == "")
    out = bronze.withColumns({
        "discount_amt": charge - allowed,
        "claim_type": infer_claim_type(F.col("type"), F.col("claim_code"), F.col("proc_desc"),
                                       F.col("claim_code_modifier")),
        "provider_street": X.street_before_dash(addr3),
        "provider_npi": F.when(~blank3, X.npi_after_dash(addr3)),
        "city": city,
        "state": state,
        "in_network_flag": F.col("oi_in_network") == "Y",
        "year": F.year("received_date"),
        "month": F.month("received_date"),
    })
    out = out.withColumns({
        "discount_pct": _discount_pct(charge, F.col("discount_amt")),
        "is_valid": F.lit(True),
    })
    return _add_validation_metadata(out, batch_id)


def _add_validation_metadata(df: DataFrame, batch_id: str | None) -> DataFrame:
    """_cleaned_at, _silver_batch_id, _validation_status."""
    batch = F.lit(batch_id) if batch_id else F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    return df.withColumns({
        "_cleaned_at": F.current_timestamp(),
        "_silver_batch_id": batch,
        "_validation_status": F.when(F.col("is_valid"), F.lit("PASS")).otherwise(F.lit("FAIL")),
    })


def clean_claims(df: DataFrame, profile: str = "lambda", batch_id: str | None = None,
                 mask: str | None = None) -> DataFrame:
    """Raw claim lines (text) -> Silver for the chosen profile.

    ``mask``: ``None`` keeps identifiers in the clear (``lambda``/``notebook``)
    or SHA-256 (``doc``); ``"sha256"``/``"md5"`` force a hash; ``"none"`` keeps clear.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; expected one of {PROFILES}")
    df = _ensure(require_columns(normalize_columns(df)), OPTIONAL_RAW)
    if profile == "lambda":
        out = _silver_lambda(df, batch_id)
    elif profile == "doc":
        return _silver_doc(df, batch_id, mask)
    else:
        out = _silver_notebook(df, batch_id)
    if mask in X.MASKERS:
        out = out.withColumn("claimant_id", X.MASKERS[mask](F.col("claimant_id")))
    return out


def add_ingestion_metadata(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """_ingested_at, _run_id (8 hex chars of an md5 of the clock), _source_file."""
    now = F.current_timestamp()
    return df.withColumns({
        "_ingested_at": now,
        "_run_id": F.substring(F.md5(now.cast("string")), 1, 8),
        "_source_file": F.lit(source_file) if source_file else F.input_file_name(),
    })
