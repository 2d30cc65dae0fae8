"""DuckDB oracle SQL for every registered query.

same driver tables: the claims fixture (``sources.fixture.LENS_SQL``) ->
Silver CTE -> Gold CTEs -> the view / query. The Spark side is written with
the DataFrame API; only this module holds SQL text, for verification.

Type alignment with Spark (see SURVEY §2.14): money sums and ratios are
reported as DOUBLE; a rounded value is rounded from a DECIMAL (DuckDB turns
decimal division into DOUBLE, so the value goes back to DECIMAL(38,10)
first); counts and integer sums are BIGINT; months are DATE.
"""

from __future__ import annotations

from claimlake.functions.dates import ORACLE_DATE_FORMATS
from claimlake.sources.fixture import LENS_SQL


def r2(expr: str, scale: int = 2) -> str:
    """Half-up rounding of a (possibly DOUBLE) value, reported as DOUBLE."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def mean2(total: str, n: str) -> str:
    """total / n of a DECIMAL sum, rounded half-up to cents in integers: a DOUBLE quotient
    of large sums can fall on the wrong side of a tie."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST(sign({cents}) * ((2 * abs({cents}) + {n}) // NULLIF(2 * {n}, 0)) AS DOUBLE) / 100"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    """part * 100.0 / whole in DOUBLE arithmetic (same operation order as Spark)."""
    return f"(CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE))"


DATE_SQL = ("COALESCE(TRY_CAST(received_date AS DATE), CAST(try_strptime(received_date, ["
            + ", ".join(f"'{f}'" for f in ORACLE_DATE_FORMATS) + "]) AS DATE))")
MONTH = "CAST(date_trunc('month', received_date) AS DATE)"

# ----------------------------------------------------------------- Silver
NPI_FALLBACK = r"""COALESCE(
      NULLIF(regexp_extract({a}, '\b(\d{{10}})\b', 1), ''),
      CASE WHEN length(list_reduce(regexp_extract_all(CASE WHEN contains({a}, ' - ') THEN string_split({a}, ' - ')[2] END, '\d+'),
                                   lambda acc, x: CASE WHEN length(x) > length(acc) THEN x ELSE acc END, '')) >= 9
           THEN list_reduce(regexp_extract_all(CASE WHEN contains({a}, ' - ') THEN string_split({a}, ' - ')[2] END, '\d+'),
                            lambda acc, x: CASE WHEN length(x) > length(acc) THEN x ELSE acc END, '') END,
      NULLIF(regexp_extract({a}, '\b(\d{{9,10}})\b', 1), ''))"""

NPI_STRICT = r"NULLIF(regexp_extract({a}, '\b(\d{{10}})\b', 1), '')"

BLANK = "({a} IS NULL OR {a} = '')"

CITY_FIRST_COMMA = ("CASE WHEN " + BLANK + " THEN NULL WHEN contains({a}, ',') "
                    "THEN trim(string_split({a}, ',')[1]) ELSE {a} END")
STATE_FIRST_COMMA = ("CASE WHEN NOT " + BLANK + " AND contains({a}, ',') "
                     "THEN NULLIF(regexp_extract(trim(string_split({a}, ',')[2]), '([A-Z]{{2}})', 1), '') END")

SILVER_LAMBDA = f"""
SELECT claimant_id, claim_item_id, type, received_date, charge_amt, allowed_amt,
       diag_code_1, diag_code_2, diag_code_3, diag_code_4, diag_code_5,
       claim_code, proc_desc, claim_code_modifier, claim_code_modifier_2, units,
       oi_in_network, service_provider, service_address_3, service_address_2,
       claim_type, modifier_1, modifier_2, provider_npi, city, state,
       charge_amt - allowed_amt AS discount_amt,
       CASE WHEN charge_amt > 0 THEN {r2('CAST(charge_amt - allowed_amt AS DOUBLE) / CAST(charge_amt AS DOUBLE) * 100')}
            ELSE 0.0 END AS discount_pct,
       CAST(year(received_date) AS INT) AS year, CAST(month(received_date) AS INT) AS month,
       CAST(quarter(received_date) AS INT) AS quarter,
       charge_amt < 0 AS has_negative_charge, allowed_amt < 0 AS has_negative_allowed,
       service_provider IS NULL AS has_missing_provider, provider_npi IS NOT NULL AS has_npi,
       COALESCE(charge_amt >= 0 AND allowed_amt >= 0 AND units > 0, false) AS is_valid
FROM (
  SELECT TRY_CAST(claimant_id AS BIGINT) AS claimant_id,
         TRY_CAST(claim_item_id AS DECIMAL(38,0)) AS claim_item_id,
         type,
         {DATE_SQL} AS received_date,
         CASE WHEN TRY_CAST(charge_amt AS DECIMAL(18,2)) IS NULL AND TRY_CAST(charge_amt AS DOUBLE) IS NOT NULL THEN NULL
              ELSE COALESCE(TRY_CAST(charge_amt AS DECIMAL(18,2)), 0) END AS charge_amt,
         CASE WHEN TRY_CAST(allowed_amt AS DECIMAL(18,2)) IS NULL AND TRY_CAST(allowed_amt AS DOUBLE) IS NOT NULL THEN NULL
              ELSE COALESCE(TRY_CAST(allowed_amt AS DECIMAL(18,2)), 0) END AS allowed_amt,
         diag_code_1, diag_code_2, diag_code_3, diag_code_4, diag_code_5,
         claim_code, proc_desc, claim_code_modifier, claim_code_modifier_2,
         TRY_CAST(trunc(COALESCE(TRY_CAST(units AS DOUBLE), 1.0)) AS INT) AS units,
         CASE WHEN upper(oi_in_network) = 'Y' THEN 'Y' ELSE 'N' END AS oi_in_network,
         service_provider, service_address_3, service_address_2,
         COALESCE(NULLIF(upper(type), ''), 'UNKNOWN') AS claim_type,
         upper(COALESCE(claim_code_modifier, '')) AS modifier_1,
         upper(COALESCE(claim_code_modifier_2, '')) AS modifier_2,
         {NPI_FALLBACK.format(a='service_address_3')} AS provider_npi,
         {CITY_FIRST_COMMA.format(a='service_address_2')} AS city,
         {STATE_FIRST_COMMA.format(a='service_address_2')} AS state
  FROM raw
) typed
"""

# ------------------------------------------------------------------- Gold
FACT = """
SELECT claim_item_id, claimant_id, provider_npi, type AS payer_name, claim_code,
       CAST(strftime(received_date, '%Y%m%d') AS INT) AS service_date_key,
       charge_amt, allowed_amt, charge_amt - allowed_amt AS discount_amt, units,
       COALESCE(upper(oi_in_network) = 'Y', false) AS in_network, received_date,
       CASE WHEN allowed_amt = 0 AND charge_amt > 0 THEN 'Denied' ELSE 'Paid' END AS claim_status,
       strftime(received_date, '%Y-%m') AS service_month
FROM silver WHERE is_valid
"""

DIM_PROVIDER = """
SELECT DISTINCT provider_npi, service_provider AS provider_name, city, state,
       CAST(NULL AS VARCHAR) AS specialty
FROM silver WHERE provider_npi IS NOT NULL
"""

DIM_PROCEDURE = """
SELECT DISTINCT claim_code, proc_desc AS procedure_desc,
       CASE WHEN regexp_matches(claim_code, '^[0-9]') THEN 'CPT'
            WHEN regexp_matches(claim_code, '^[A-Za-z]') THEN 'HCPCS' END AS code_type
FROM silver WHERE claim_code IS NOT NULL
"""

DIM_PAYER = "SELECT DISTINCT type AS payer_name FROM silver WHERE type IS NOT NULL"
DIM_MEMBER = "SELECT DISTINCT claimant_id AS member_id FROM silver WHERE claimant_id IS NOT NULL"

DIM_DATE = """
SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key,
       CAST(day(full_date) AS INT) AS day, CAST(month(full_date) AS INT) AS month,
       strftime(full_date, '%B') AS month_name, CAST(quarter(full_date) AS INT) AS quarter,
       CAST(year(full_date) AS INT) AS year, isodow(full_date) > 5 AS is_weekend,
       CAST(CASE WHEN month(full_date) >= 10 THEN year(full_date) + 1 ELSE year(full_date) END AS INT) AS fiscal_year,
       'FY' || CAST(CASE WHEN month(full_date) >= 10 THEN year(full_date) + 1 ELSE year(full_date) END AS VARCHAR)
         || '-Q' || CAST(quarter(full_date) AS VARCHAR) AS fiscal_period
FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS full_date)
"""

REMITTANCE = """
SELECT claim_item_id AS claim_id, CAST(allowed_amt AS DECIMAL(18,2)) AS payment_amount,
       claim_code_modifier AS carc_code, claim_code_modifier_2 AS rarc_code,
       CAST(NULL AS VARCHAR) AS adjustment_reason
FROM silver WHERE claim_code_modifier IS NOT NULL
"""

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw": (LENS_SQL, ()),
    "silver": (SILVER_LAMBDA, ("raw",)),
    "fact_claims": (FACT, ("silver",)),
    "dim_provider": (DIM_PROVIDER, ("silver",)),
    "dim_procedure": (DIM_PROCEDURE, ("silver",)),
    "dim_payer": (DIM_PAYER, ("silver",)),
    "dim_member": (DIM_MEMBER, ("silver",)),
    "dim_date": (DIM_DATE, ()),
    "fact_remittance": (REMITTANCE, ("silver",)),
}


def cte(name: str, sql: str, deps=()) -> None:
    """Register a further CTE (views and marts add theirs)."""
    CTES[name] = (sql, tuple(deps))


def query(final_sql: str, uses) -> str:
    """``WITH <uses and their dependencies, in order> <final_sql>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for u in uses:
        visit(u)
    body = ",\n".join(f"{n} AS (\n{CTES[n][0].strip()}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


# ---------------------------------------------------------- other profiles
SILVER_DOC = rf"""
SELECT claimant_id_raw AS _claimant_raw, sha256(claimant_id_raw) AS claimant_id, claim_item_id,
       COALESCE(type, CASE WHEN starts_with(COALESCE(claim_code, 'None'), '9')
                             OR starts_with(COALESCE(claim_code, 'None'), 'G') THEN 'Medicare' ELSE 'Group' END) AS type,
       received_date, charge_amt, allowed_amt, diag_code_1, diag_code_2, diag_code_3, diag_code_4, diag_code_5,
       claim_code, proc_desc, claim_code_modifier, claim_code_modifier_2, units, oi_in_network,
       service_provider, service_address_3, service_address_2,
       NULLIF(regexp_extract(service_address_3, '\b(\d{{10}})\b', 1), '') AS provider_npi,
       CASE WHEN contains(service_address_2, ',') THEN trim(regexp_extract(service_address_2, '^(.*),[^,]*$', 1))
            ELSE trim(service_address_2) END AS city,
       CASE WHEN contains(service_address_2, ',') THEN trim(string_split(service_address_2, ',')[-1]) END AS state,
       charge_amt - allowed_amt AS discount_amt,
       charge_amt IS NOT NULL AND received_date IS NOT NULL AS is_valid
FROM (
  SELECT *, row_number() OVER (PARTITION BY claimant_id_raw, received_date, claim_code, charge_amt
                               ORDER BY claim_item_id NULLS LAST, type NULLS LAST, allowed_amt NULLS LAST,
                                        diag_code_1 NULLS LAST, diag_code_2 NULLS LAST, diag_code_3 NULLS LAST,
                                        diag_code_4 NULLS LAST, diag_code_5 NULLS LAST, proc_desc NULLS LAST,
                                        claim_code_modifier NULLS LAST, claim_code_modifier_2 NULLS LAST,
                                        units NULLS LAST, oi_in_network NULLS LAST, service_provider NULLS LAST,
                                        service_address_3 NULLS LAST, service_address_2 NULLS LAST) AS rn
  FROM (
    SELECT claimant_id AS claimant_id_raw, TRY_CAST(claim_item_id AS DECIMAL(38,0)) AS claim_item_id, type,
           {DATE_SQL} AS received_date,
           TRY_CAST(charge_amt AS DECIMAL(18,2)) AS charge_amt, TRY_CAST(allowed_amt AS DECIMAL(18,2)) AS allowed_amt,
           diag_code_1, diag_code_2, diag_code_3, diag_code_4, diag_code_5, claim_code, proc_desc,
           claim_code_modifier, claim_code_modifier_2,
           TRY_CAST(trunc(TRY_CAST(units AS DOUBLE)) AS INT) AS units,
           oi_in_network, service_provider, service_address_3, service_address_2
    FROM raw) typed
) numbered
WHERE rn = 1
"""

SILVER_NOTEBOOK = f"""
SELECT claimant_id, claim_item_id, type, received_date, charge_amt, allowed_amt,
       diag_code_1, diag_code_2, diag_code_3, diag_code_4, diag_code_5, claim_code, proc_desc,
       claim_code_modifier, claim_code_modifier_2, units, oi_in_network, service_provider,
       service_address_3, service_address_2,
       charge_amt - allowed_amt AS discount_amt,
       CASE WHEN charge_amt > 0 THEN {r2('CAST(charge_amt - allowed_amt AS DOUBLE) / CAST(charge_amt AS DOUBLE) * 100')}
            ELSE 0.0 END AS discount_pct,
       CASE WHEN type IS NOT NULL AND type <> '' THEN type
            WHEN starts_with(COALESCE(claim_code, 'nan'), 'U') THEN 'COVID_TEST'
            WHEN COALESCE(claim_code, 'nan') IN ('90837', '90834', '90853') THEN 'MENTAL_HEALTH'
            WHEN contains(lower(COALESCE(proc_desc, 'nan')), 'therapy')
              OR contains(COALESCE(claim_code_modifier, 'nan'), 'PT') THEN 'PHYSICAL_THERAPY'
            ELSE 'UNKNOWN' END AS claim_type,
       CASE WHEN {BLANK.format(a='service_address_3')} THEN NULL
            WHEN contains(service_address_3, ' - ') THEN string_split(service_address_3, ' - ')[1]
            ELSE service_address_3 END AS provider_street,
       CASE WHEN NOT {BLANK.format(a='service_address_3')} AND contains(service_address_3, ' - ')
            THEN string_split(service_address_3, ' - ')[2] END AS provider_npi,
       {CITY_FIRST_COMMA.format(a='service_address_2')} AS city,
       CASE WHEN NOT {BLANK.format(a='service_address_2')} AND contains(service_address_2, ',')
            THEN substr(trim(string_split(service_address_2, ',')[2]), 1, 2) END AS state,
       oi_in_network = 'Y' AS in_network_flag,
       CAST(year(received_date) AS INT) AS year, CAST(month(received_date) AS INT) AS month,
       true AS is_valid
FROM (
  SELECT TRY_CAST(claimant_id AS BIGINT) AS claimant_id, TRY_CAST(claim_item_id AS DECIMAL(38,0)) AS claim_item_id,
         upper(COALESCE(type, '')) AS type, {DATE_SQL} AS received_date,
         CASE WHEN TRY_CAST(charge_amt AS DECIMAL(18,2)) < 0 THEN CAST(0 AS DECIMAL(18,2))
              ELSE TRY_CAST(charge_amt AS DECIMAL(18,2)) END AS charge_amt,
         CASE WHEN TRY_CAST(allowed_amt AS DECIMAL(18,2)) < 0 THEN CAST(0 AS DECIMAL(18,2))
              ELSE TRY_CAST(allowed_amt AS DECIMAL(18,2)) END AS allowed_amt,
         diag_code_1, diag_code_2, diag_code_3, diag_code_4, diag_code_5, claim_code, proc_desc,
         upper(COALESCE(claim_code_modifier, '')) AS claim_code_modifier,
         upper(COALESCE(claim_code_modifier_2, '')) AS claim_code_modifier_2,
         TRY_CAST(trunc(COALESCE(TRY_CAST(units AS DOUBLE), 1.0)) AS INT) AS units,
         upper(COALESCE(oi_in_network, '')) AS oi_in_network,
         service_provider, service_address_3, service_address_2
  FROM raw) bronze
"""

CTES["silver_doc"] = (SILVER_DOC, ("raw",))
CTES["silver_nb"] = (SILVER_NOTEBOOK, ("raw",))
