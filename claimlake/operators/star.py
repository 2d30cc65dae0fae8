"""Gold star schema builders.

Every builder is a projection / distinct / filter of Silver, so building the
whole star from one Silver table is a set of independent scans that Spark can
run in parallel; Silver is written once (``plans.pipeline``) because the star
has many readers.

Grain notes kept from the reference:
* ``dim_provider`` is a literal DISTINCT of (npi, name, city, state): one NPI
  can have several rows, and a join on NPI then fans out. ``dim_provider_unique``
  (one row per NPI) is offered as an explicit alternative, never silently.
* ``fact_remittance`` has one row per claim line with a first modifier;
  ``fact_remittance_long`` is the 1:N form (one row per non-null modifier).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake import functions as X
from claimlake.functions.money import CLAIM_ID, MONEY
from claimlake.schema import DIAG_COLUMNS, DIAG_RANKS

# The calendar spine of dim_date.
DATE_SPINE_START = "2020-01-01"
DATE_SPINE_END = "2030-12-31"


# ------------------------------------------------------------------- dims
def dim_member(silver: DataFrame) -> DataFrame:
    """G1: distinct non-null claimant."""
    return (silver.where(F.col("claimant_id").isNotNull())
                  .select(F.col("claimant_id").alias("member_id")).distinct()
                  .withColumn("_loaded_at", F.current_timestamp()))


def dim_provider(silver: DataFrame) -> DataFrame:
    """Distinct (npi, name, city, state) with an NPI."""
    return (silver.where(F.col("provider_npi").isNotNull())
                  .select("provider_npi", F.col("service_provider").alias("provider_name"),
                          "city", "state").distinct()
                  .withColumn("specialty", F.lit(None).cast("string"))
                  .withColumn("_loaded_at", F.current_timestamp()))


def dim_provider_unique(silver: DataFrame) -> DataFrame:
    """One row per NPI: the smallest (name, city, state) seen for it, NULLs
    last. A partial/final aggregate, so a hot NPI is combined map-side."""
    name, city, state = F.col("service_provider"), F.col("city"), F.col("state")
    order = F.struct(name.isNull(), name, city.isNull(), city, state.isNull(), state)
    return (silver.where(F.col("provider_npi").isNotNull())
                  .groupBy("provider_npi")
                  .agg(F.min_by(F.struct(name.alias("provider_name"), city, state), order).alias("p"))
                  .select("provider_npi", "p.*"))


def dim_provider_notebook(silver: DataFrame) -> DataFrame:
    """Notebook form with the street, NPI not null."""
    return (silver.select("provider_npi", "service_provider", "provider_street", "city", "state")
                  .distinct().where(F.col("provider_npi").isNotNull()))


def dim_payer(silver: DataFrame) -> DataFrame:
    """Distinct non-null raw TYPE as payer name."""
    return (silver.where(F.col("type").isNotNull())
                  .select(F.col("type").alias("payer_name")).distinct()
                  .withColumn("_loaded_at", F.current_timestamp()))


def dim_procedure(silver: DataFrame, require_code: bool = True) -> DataFrame:
    """Distinct (code, description) + code type (CPT / HCPCS)."""
    src = silver.where(F.col("claim_code").isNotNull()) if require_code else silver
    return (src.select("claim_code", F.col("proc_desc").alias("procedure_desc")).distinct()
               .withColumn("code_type", X.code_type(F.col("claim_code")))
               .withColumn("_loaded_at", F.current_timestamp()))


def dim_claimant(silver: DataFrame) -> DataFrame:
    """Distinct (claimant, claim type)."""
    return silver.select("claimant_id", "claim_type").distinct()


def _date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def dim_date_short(spark: SparkSession, start: str = DATE_SPINE_START,
                   end: str = DATE_SPINE_END) -> DataFrame:
    """date_key, full_date, day, month, year over the spine (4,018 rows)."""
    d = F.col("full_date")
    return _date_spine(spark, start, end).select(
        X.date_key(d).alias("date_key"), d, F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"), F.year(d).alias("year"))


def dim_date(spark: SparkSession, start_year: int = 2020, end_year: int = 2030) -> DataFrame:
    """Full calendar + fiscal attributes (fiscal year starts in October;
    ``fiscal_period`` pairs it with the calendar quarter)."""
    d = F.col("full_date")
    return _date_spine(spark, f"{start_year}-01-01", f"{end_year}-12-31").select(
        d, X.date_key(d).alias("date_key"), F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), F.year(d).alias("year"),
        (F.weekday(d) > 4).alias("is_weekend"),
        X.fiscal_year(d).alias("fiscal_year"), X.fiscal_period(d).alias("fiscal_period"))


# ------------------------------------------------------------------ facts
def _in_network(c: str = "oi_in_network") -> F.Column:
    return F.coalesce(F.upper(F.col(c)) == "Y", F.lit(False))


def claim_status(charge: F.Column, allowed: F.Column) -> F.Column:
    """'Denied' when nothing was allowed on a positive charge, else 'Paid'."""
    return F.when((allowed == 0) & (charge > 0), F.lit("Denied")).otherwise(F.lit("Paid"))


def fact_claims(silver: DataFrame, valid_only: bool = True) -> DataFrame:
    """G10 (canonical superset fact): valid lines, view column names."""
    src = silver.where(F.col("is_valid")) if valid_only else silver
    d = F.col("received_date")
    charge, allowed = F.col("charge_amt").cast(MONEY), F.col("allowed_amt").cast(MONEY)
    return src.select(
        F.col("claim_item_id").cast(CLAIM_ID).alias("claim_item_id"),
        F.col("claimant_id"),
        F.col("provider_npi"),
        F.col("type").alias("payer_name"),
        F.col("claim_code"),
        X.date_key(d).alias("service_date_key"),
        charge.alias("charge_amt"),
        allowed.alias("allowed_amt"),
        F.round(charge - allowed, 2).alias("discount_amt"),
        F.col("units").cast("int").alias("units"),
        _in_network().alias("in_network"),
        d.alias("received_date"),
        claim_status(charge, allowed).alias("claim_status"),
        X.service_month(d).alias("service_month"),
        F.current_timestamp().alias("_loaded_at"),
    )


def fact_claims_orchestrated(silver: DataFrame) -> DataFrame:
    """The orchestrator's 12-column fact over all lines (no validity filter)."""
    d = F.col("received_date")
    return silver.select(
        F.col("claim_item_id").cast(CLAIM_ID).alias("claim_id"),
        F.col("claimant_id").alias("member_id"),
        "provider_npi",
        F.col("type").alias("payer_name"),
        F.col("claim_code").alias("procedure_code"),
        X.date_key(d).alias("service_date_key"),
        F.col("charge_amt").cast("decimal(18,2)").alias("total_charges"),
        F.col("allowed_amt").cast("decimal(18,2)").alias("allowed_amt"),
        F.col("units").alias("units_count"),
        _in_network().alias("in_network"),
        X.service_month(d).alias("service_month"),
        F.current_timestamp().alias("_loaded_at"),
    )


FACT_CLAIM_ITEM_COLUMNS = [
    "claim_item_id", "claimant_id", "received_date", "claim_type", "charge_amt", "allowed_amt",
    "discount_amt", "discount_pct", "units", "oi_in_network", "claim_code",
    "claim_code_modifier", "claim_code_modifier_2", "provider_npi", "_ingested_at", "_run_id",
]


def fact_claim_items(silver_nb: DataFrame) -> DataFrame:
    """Notebook fact (available columns) + ``in_network_flag``."""
    cols = [c for c in FACT_CLAIM_ITEM_COLUMNS if c in silver_nb.columns]
    out = silver_nb.select(*cols)
    if "oi_in_network" in out.columns:
        out = out.withColumn("in_network_flag", F.col("oi_in_network") == "Y")
    return out


def fact_remittance(silver: DataFrame) -> DataFrame:
    """One row per line with a first modifier; allowed as payment,
    modifiers as CARC / RARC."""
    return (silver.where(F.col("claim_code_modifier").isNotNull())
                  .select(F.col("claim_item_id").cast(CLAIM_ID).alias("claim_id"),
                          F.col("allowed_amt").cast("decimal(18,2)").alias("payment_amount"),
                          F.col("claim_code_modifier").alias("carc_code"),
                          F.col("claim_code_modifier_2").alias("rarc_code"),
                          F.lit(None).cast("string").alias("adjustment_reason"),
                          F.current_timestamp().alias("_loaded_at")))


def fact_remittance_long(silver: DataFrame) -> DataFrame:
    """The stated 1:N grain, one row per non-null modifier (unpivot)."""
    base = silver.select(F.col("claim_item_id").cast(CLAIM_ID).alias("claim_id"),
                         F.col("claim_code_modifier").alias("1"),
                         F.col("claim_code_modifier_2").alias("2"))
    return (base.unpivot("claim_id", ["1", "2"], "adjustment_seq", "adjustment_code")
                .where(F.col("adjustment_code").isNotNull())
                .withColumn("adjustment_seq", F.col("adjustment_seq").cast("int")))


def bridge_diagnosis(silver: DataFrame) -> DataFrame:
    """(claim line, rank name, ICD-10 code) for non-null, non-empty codes.
    One ``unpivot`` pass instead of five filtered copies."""
    renamed = silver.select("claim_item_id", *[F.col(c).alias(r) for c, r in zip(DIAG_COLUMNS, DIAG_RANKS)])
    return (renamed.unpivot("claim_item_id", DIAG_RANKS, "diag_rank", "icd10_code")
                   .where(F.col("icd10_code").isNotNull() & (F.col("icd10_code") != "")))


def diagnosis_wide(silver: DataFrame) -> DataFrame:
    """Claim line with its five diagnoses renamed."""
    return silver.select(
        F.col("claim_item_id").cast(CLAIM_ID).alias("claim_item_id"),
        F.col("claimant_id").cast("bigint").alias("claimant_id"),
        "claim_code", "provider_npi",
        F.col("diag_code_1").alias("primary_diagnosis"),
        F.col("diag_code_2").alias("secondary_diagnosis_1"),
        F.col("diag_code_3").alias("secondary_diagnosis_2"),
        F.col("diag_code_4").alias("secondary_diagnosis_3"),
        F.col("diag_code_5").alias("secondary_diagnosis_4"),
        "charge_amt", "allowed_amt", "received_date")


# ------------------------------------------------------------------- star
@dataclass
class Star:
    """The Gold tables as DataFrames (lazily built, or read back from disk)."""
    fact_claims: DataFrame
    fact_remittance: DataFrame
    dim_member: DataFrame
    dim_provider: DataFrame
    dim_payer: DataFrame
    dim_procedure: DataFrame
    dim_date: DataFrame
    silver: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        """The tables by name, dimensions before the facts that refer to them."""
        names = sorted((f.name for f in fields(self) if f.name != "silver"), key=lambda n: not n.startswith("dim_"))
        return {n: getattr(self, n) for n in names if getattr(self, n) is not None}

    def register(self, prefix: str = "") -> "Star":
        """Expose every table (and Silver) as a temp view for SQL users."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)
        if self.silver is not None:
            self.silver.createOrReplaceTempView(prefix + "claims_silver")
        return self


#: The columns of Silver that the star is made of.
STAR_COLUMNS = ["claim_item_id", "claimant_id", "provider_npi", "type", "claim_code", "proc_desc", "received_date", "charge_amt", "allowed_amt",
                "units", "oi_in_network", "claim_code_modifier", "claim_code_modifier_2", "service_provider", "city", "state", "is_valid"]


def build_star(silver: DataFrame) -> Star:
    spark = silver.sparkSession
    return Star(
        fact_claims=fact_claims(silver),
        fact_remittance=fact_remittance(silver),
        dim_member=dim_member(silver),
        dim_provider=dim_provider(silver),
        dim_payer=dim_payer(silver),
        dim_procedure=dim_procedure(silver),
        dim_date=dim_date(spark),
        silver=silver,
    )
