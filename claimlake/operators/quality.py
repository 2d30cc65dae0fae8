"""Data-quality profiling, reports and rules.

Every report is one aggregation pass (one job) producing a small table; rules
that concern single rows are also available as boolean columns, so routing
and per-record scores need no second pass. Uniqueness is measured with a
grouped count (partial aggregation; skew-safe), never with a window.

Exact profiles count (column, value) pairs in one pass; ``exact=False`` switches to
HyperLogLog (``approx_count_distinct``), and ``profile_sketches`` stores mergeable sketches
of a batch for a running profile.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimlake import functions as X
from claimlake.schema import COLUMN_DESCRIPTIONS, OPEN_COLUMNS, PHI_TAGS, TABLE_DESCRIPTIONS


def _distinct(c: str, exact: bool) -> Column:
    return F.count_distinct(F.col(c)) if exact else F.approx_count_distinct(F.col(c))


def _distinct_scalar(df: DataFrame, c: str, exact: bool) -> Column:
    """Distinct non-NULL values of one column as a scalar subquery: a
    single-column scan and shuffle, no row expansion in the caller's aggregate."""
    if not exact:
        return df.select(F.approx_count_distinct(c)).scalar()
    return df.select(c).where(F.col(c).isNotNull()).distinct().select(F.count(F.lit(1))).scalar()


def _n_null(c: str) -> Column:
    return F.count(F.when(F.col(c).isNull(), 1))


# ------------------------------------------------------------- D1, D2, D5
def null_profile(df: DataFrame, columns: list[str] | None = None, approx_distinct: bool = False) -> DataFrame:
    """Per column: type, NULL count and NULL % from one aggregate (long form);
    with ``approx_distinct`` also a HyperLogLog distinct count."""
    cols = columns or df.columns
    types = dict(df.dtypes)
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[_n_null(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                 *([_distinct(c, False).alias(f"d_{i}") for i, c in enumerate(cols)] if approx_distinct else []))
    fields = lambda i, c: [F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                           F.col(f"n_{i}").alias("null_count")] + (
        [F.col(f"d_{i}").alias("unique_values")] if approx_distinct else [])
    out = (one.select("_rows", F.explode(F.array(*[F.struct(*fields(i, c)) for i, c in enumerate(cols)])).alias("p"))
              .select("_rows", "p.*"))
    return out.withColumn("null_pct", X.pct_of(F.col("null_count"), F.col("_rows"))).drop("_rows")


def _as_text(df: DataFrame, c: str) -> Column:
    """A value as text, equal values alike (-0.0 is 0.0)."""
    value = F.col(c) + F.lit(0.0) if dict(df.dtypes)[c] in ("float", "double") else F.col(c)
    return value.cast("string")


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column type, nulls, null %, distinct values.

    The exact profile is one pass: every row is spread into (column, value) pairs, which are
    counted with map-side combining, so a task ships each value of a column once, however often
    it occurs, and rows, NULLs and distinct values of all columns come from these counts.
    ``exact=False`` uses HyperLogLog inside a single aggregate. pandas ``nunique`` ignores NULL,
    as these counts do."""
    cols = columns or df.columns
    if not exact:
        return null_profile(df, cols, approx_distinct=True)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _as_text(df, c).alias("v")) for i, c in enumerate(cols)])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.i", "p.v").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("i").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
                                    F.count("v").alias("unique_values"))
    types = dict(df.dtypes)
    names = df.sparkSession.createDataFrame([(i, c, types[c]) for i, c in enumerate(cols)], "i int, column_name string, data_type string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (names.join(found, "i", "left")
            .select("column_name", "data_type", zero("null_count"), F.when(F.col("rows") > 0, X.pct_of(F.col("null_count"), F.col("rows"))).alias("null_pct"), zero("unique_values")))


#: Registers of a stored sketch, as a power of two, and its relative standard error, 1.04 / sqrt(2^14).
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def profile_sketches(df: DataFrame, batch: str, columns: list[str] | None = None) -> DataFrame:
    """D1 for a batch, to be stored and merged: (batch, column, type, rows, nulls, sketch of the
    distinct values), one aggregate over one pass. A sketch has a fixed size (16 KB)."""
    cols = columns or df.columns
    types = dict(df.dtypes)
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[_n_null(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                 *[F.hll_sketch_agg(_as_text(df, c), SKETCH_BITS).alias(f"s_{i}") for i, c in enumerate(cols)])
    line = lambda i, c: F.struct(F.lit(batch).alias("batch"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                                 F.col("_rows").alias("rows"), F.col(f"n_{i}").alias("null_count"), F.col(f"s_{i}").alias("sketch"))
    return _long(one, [line(i, c) for i, c in enumerate(cols)])


def running_profile(sketches: DataFrame) -> DataFrame:
    """D1 over all stored batches: rows and NULLs are added, sketches merged; no row of a
    batch is read. The distinct count has a standard error of ``SKETCH_ERROR``."""
    merged = sketches.groupBy("column_name", "data_type").agg(F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column_name", "data_type", "rows", "null_count", X.pct_of(F.col("null_count"), F.col("rows")).alias("null_pct"),
                         F.hll_sketch_estimate("sketch").alias("unique_values"))


def high_null_columns(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Columns with more than ``threshold`` % NULL."""
    return null_profile(df).where(F.col("null_pct") > threshold).select("column_name", "null_pct")


# --------------------------------------------------------------------- D3
def duplicate_row_count(df: DataFrame, keys) -> DataFrame:
    """D3: rows whose key occurs more than once (every member counted)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
                 F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"))


# --------------------------------------------------------------------- D4
def value_checks(typed: DataFrame) -> DataFrame:
    """Negative money, non-positive units and the date range, one pass."""
    return typed.agg(F.count(F.when(F.col("charge_amt") < 0, 1)).alias("negative_charge_amt"),
                     F.count(F.when(F.col("allowed_amt") < 0, 1)).alias("negative_allowed_amt"),
                     F.count(F.when(F.col("units") <= 0, 1)).alias("invalid_units"),
                     F.min("received_date").alias("date_min"),
                     F.max("received_date").alias("date_max"))


def date_readings(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Lines by how their date text can be read (see ``dates.date_reading``), per ``by`` (a file or batch).
    Dates that two orders would read differently are counted here; cleaning takes their month first."""
    return df.groupBy(*(by or []), X.date_reading(F.col(col)).alias("reading")).agg(F.count(F.lit(1)).alias("lines"))


def date_orders(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """Per file or batch, the order that its unambiguous slashed dates show (``month_first``, ``day_first``,
    ``mixed``, or NULL if there are none) and the number of dates that hang on it."""
    kind = X.date_reading(F.col(col))
    n = lambda name: F.count(F.when(kind == name, 1)).alias(name)
    counts = df.groupBy(*by).agg(n("month_first"), n("day_first"), n("ambiguous"))
    month, day = F.col("month_first") > 0, F.col("day_first") > 0
    order = F.when(month & day, F.lit("mixed")).when(month, F.lit("month_first")).when(day, F.lit("day_first"))
    return counts.withColumn("date_order", order)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per non-NULL value."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


# --------------------------------------------------------------------- D6
QUALITY_KEY_COLUMNS = ["claimant_id", "claim_item_id", "charge_amt", "claim_code"]


def quality_report(silver: DataFrame, sample_size: int = 5, exact: bool = True) -> DataFrame:
    """One-row Silver quality report. The score is NULL (not an error)
    on empty input; the NPI sample is the ``sample_size`` smallest distinct
    NPIs (a bounded top-k, not a collect of the column)."""
    sample = (silver.where(F.col("provider_npi").isNotNull()).select("provider_npi").distinct()
              .orderBy("provider_npi").limit(sample_size)
              .agg(F.sort_array(F.collect_list("provider_npi"))).scalar())
    valid = F.sum(F.col("is_valid").cast("int"))
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        X.round2(F.try_divide(valid * F.lit(100.0).cast("decimal(4,1)"), F.count(F.lit(1)))).alias("quality_score"),
        *[_n_null(c).alias(f"null_{c}") for c in QUALITY_KEY_COLUMNS],
        F.sum(F.col("has_negative_charge").cast("int")).alias("negative_charges"),
        F.sum(F.col("has_negative_allowed").cast("int")).alias("negative_allowed"),
        F.sum(F.col("has_missing_provider").cast("int")).alias("missing_providers"),
        F.sum(F.col("has_npi").cast("int")).alias("npi_count"),
        F.min("received_date").alias("date_min"),
        F.max("received_date").alias("date_max"),
    ).select("*",
             _distinct_scalar(silver, "claimant_id", exact).alias("unique_claimants"),
             _distinct_scalar(silver, "claim_code", exact).alias("unique_codes"),
             _distinct_scalar(silver, "provider_npi", exact).alias("unique_npis"),
             F.array_join(sample, ",").alias("sample_npis"))


# -------------------------------------------------------------- D7 - D10
def referential_integrity(fact: DataFrame, dim_provider: DataFrame) -> DataFrame:
    """Distinct fact NPIs missing from the provider dimension, negative
    discounts and allowed > charged (anti join + one aggregate)."""
    dim_keys = dim_provider.select(F.col("provider_npi").alias("_npi")).distinct()
    orphans = (fact.select("provider_npi").where(F.col("provider_npi").isNotNull()).distinct()
               .join(dim_keys, F.col("provider_npi") == F.col("_npi"), "left_anti")
               .agg(F.count(F.lit(1)).alias("orphan_npis")))
    # (a NULL NPI is not counted: ``nunique`` ignores it)
    money = fact.agg(F.count(F.when(F.col("discount_amt") < 0, 1)).alias("negative_discounts"),
                     F.count(F.when(F.col("allowed_amt") > F.col("charge_amt"), 1)).alias("allowed_exceeds_charge"))
    return (_one_row(orphans, money)
            .select(F.col("orphan_npis").alias("invalid_provider_npis"),
                    "negative_discounts", "allowed_exceeds_charge"))


def _one_row(*dfs: DataFrame) -> DataFrame:
    """Combine one-row aggregates side by side via scalar subqueries."""
    base = dfs[0]
    for other in dfs[1:]:
        base = base.select("*", *[other.select(c).scalar().alias(c) for c in other.columns])
    return base


def completeness(df: DataFrame, required: list[str]) -> DataFrame:
    """NULL % per required column, only columns with NULLs."""
    return (null_profile(df, required).where(F.col("null_count") > 0)
            .select("column_name", "null_count", "null_pct"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """(is_unique, duplicate_count): rows beyond the first per key value
    (NULL counts as a value, as in pandas ``duplicated``)."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    dup = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return g.agg((dup == 0).alias("is_unique"), dup.alias("duplicate_count"))


def check_report(fact: DataFrame, dim_provider: DataFrame, required: list[str], key: str) -> DataFrame:
    """Three checks (integrity, completeness, key uniqueness) as rows of
    (check_name, passed, issues)."""
    ri = referential_integrity(fact, dim_provider)
    ri_issues = ri.select(F.col("invalid_provider_npis") + F.col("negative_discounts")
                          + F.col("allowed_exceeds_charge")).scalar()
    comp = completeness(fact, required).agg(F.count(F.lit(1))).scalar()
    uniq = uniqueness(fact, key).select("duplicate_count").scalar()
    base = fact.sparkSession.range(1)
    rows = [("referential_integrity", ri_issues), ("data_completeness", comp), ("primary_key_uniqueness", uniq)]
    return reduce(DataFrame.unionByName, [
        base.select(F.lit(n).alias("check_name"), (v == 0).alias("passed"), v.cast("bigint").alias("issues"))
        for n, v in rows])


# ------------------------------------------------------------ D11 - D14
@dataclass(frozen=True)
class Rule:
    """A declarative rule. ``kind`` is one of: complete, unique, min, max,
    length, freshness, accepted. Row-level kinds also yield a per-row check."""
    kind: str
    column: str
    value: object = None

    @property
    def name(self) -> str:
        v = "" if self.value is None else f" {self.value}"
        return f"{self.kind} {self.column}{v}"

    @property
    def row_level(self) -> bool:
        return self.kind in ("complete", "min", "max", "length", "accepted")

    def row_check(self) -> Column | None:
        """Per-row boolean (NULL-safe) for row-level rules, else None."""
        c = F.col(self.column)
        if self.kind == "complete":
            return c.isNotNull()
        if self.kind == "min":
            return F.coalesce(c >= F.lit(self.value), F.lit(True))
        if self.kind == "max":
            return F.coalesce(c <= F.lit(self.value), F.lit(True))
        if self.kind == "length":
            return F.coalesce(F.length(c) == F.lit(self.value), F.lit(True))
        if self.kind == "accepted":
            return F.coalesce(c.isin(list(self.value)), F.lit(True))
        return None


# The documented Silver rule set and the schema tests of fact_claims.
SILVER_RULES = [
    Rule("complete", "claim_item_id"), Rule("unique", "claim_item_id"), Rule("complete", "charge_amt"),
    Rule("min", "charge_amt", 0), Rule("max", "charge_amt", 100000), Rule("complete", "received_date"),
    Rule("min", "received_date", "2020-01-01"), Rule("length", "provider_npi", 10),
    Rule("freshness", "received_date", 30),
]
FACT_TESTS = [
    Rule("unique", "claim_item_id"), Rule("complete", "claim_item_id"), Rule("complete", "charge_amt"),
    Rule("min", "charge_amt", 0), Rule("max", "charge_amt", 100000),
    Rule("accepted", "in_network", (True, False)),
]


def _literal_for(df: DataFrame, rule: Rule) -> Column:
    dtype = dict(df.dtypes)[rule.column]
    return F.lit(rule.value).cast(dtype) if dtype == "date" else F.lit(rule.value)


def evaluate_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate all rules in one aggregation pass (plus one grouped
    count per uniqueness rule). Output: rule, passed, failing_rows, metric."""
    row_rules = [r for r in rules if r.kind not in ("unique", "freshness")]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, r in enumerate(row_rules):
        rc = r.row_check()
        if r.kind in ("min", "max") and dict(df.dtypes)[r.column] == "date":
            c = F.col(r.column)
            lit = _literal_for(df, r)
            rc = F.coalesce(c >= lit if r.kind == "min" else c <= lit, F.lit(True))
        aggs.append(F.count(F.when(~rc, 1)).alias(f"f_{i}"))
    fresh = [r for r in rules if r.kind == "freshness"]
    for i, r in enumerate(fresh):
        aggs.append(F.max(r.column).alias(f"m_{i}"))
    one = df.agg(*aggs)
    line = lambda r, passed, failing, metric: F.struct(
        F.lit(r.name).alias("rule"), passed.alias("passed"), failing.cast("bigint").alias("failing_rows"),
        metric.cast("double").alias("metric"))
    lines = [line(r, F.col(f"f_{i}") == 0, F.col(f"f_{i}"),
                  F.try_divide(F.col("_rows") - F.col(f"f_{i}"), F.col("_rows"))) for i, r in enumerate(row_rules)]
    for i, r in enumerate(fresh):
        age = F.datediff(F.current_date(), F.col(f"m_{i}"))
        lines.append(line(r, F.coalesce(age <= r.value, F.lit(False)), F.lit(None), age))
    out = [_long(one, lines)] if lines else []
    for r in [r for r in rules if r.kind == "unique"]:
        u = uniqueness(df, r.column)
        out.append(u.select(F.lit(r.name).alias("rule"), F.col("is_unique").alias("passed"),
                            F.col("duplicate_count").cast("bigint").alias("failing_rows"),
                            F.lit(None).cast("double").alias("metric")))
    return reduce(DataFrame.unionByName, out)


def _long(one: DataFrame, lines: list[Column]) -> DataFrame:
    """A one-row aggregate as one row per struct: exploding the structs together keeps the
    single scan, where a union of selections would read the input once for each."""
    return one.select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")


def score_records(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per-row passed / total row rules, a score and a route."""
    checks = [r.row_check() for r in rules if r.row_level]
    passed = reduce(lambda a, b: a + b, [c.cast("int") for c in checks])
    return df.withColumns({
        "rules_passed": passed,
        "rules_total": F.lit(len(checks)),
        "quality_score": X.round2(passed * F.lit(100.0).cast("decimal(4,1)") / F.lit(len(checks))),
        "dq_route": F.when(passed == len(checks), F.lit("pass")).otherwise(F.lit("quarantine")),
    })


def route(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, failing rows) from the row rules."""
    scored = score_records(df, rules)
    return (scored.where(F.col("dq_route") == "pass"), scored.where(F.col("dq_route") != "pass"))


# --------------------------------------------------------------------- D15
def post_build_checks(tables: dict[str, DataFrame], not_null: dict[str, list[str]]) -> DataFrame:
    """Row count per table and NULL counts of its key columns (long form)."""
    parts = []
    for name, df in tables.items():
        cols = not_null.get(name, [])
        one = df.agg(F.count(F.lit(1)).alias("rows"), *[_n_null(c).alias(f"null_{c}") for c in cols])
        line = lambda check, value: F.struct(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"),  # noqa: B023, E731
                                             F.col(value).alias("value"))
        parts.append(_long(one, [line("row_count", "rows"), *[line(f"null_{c}", f"null_{c}") for c in cols]]))
    return reduce(DataFrame.unionByName, parts)


# --------------------------------------------------------------- D16, D17
ROLES = ("engineer", "scientist", "analyst", "billing_manager", "executive")


def role_view(df: DataFrame, role: str, salt: str = "", unknown: str = "drop") -> DataFrame:
    """Role-scoped projection. Engineers see everything; scientists see
    PHI hashed (SHA-256, after ``salt``); analysts and billing managers lose PII and
    see PHI hashed; executives get no row-level access: ``aggregates.role_report`` has the
    aggregated reports of billing managers and executives.
    Columns without a tag are withheld unless ``unknown`` is "keep"."""
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}")
    if role == "engineer":
        return df
    if role == "executive":
        raise PermissionError("executives read aggregates only: see operators.aggregates.role_report")
    shown = []
    for c in df.columns:
        tag = PHI_TAGS.get(c)
        if tag == "PHI":
            shown.append(X.mask_sha256(F.col(c), salt).alias(c))
        elif tag == "masked" or (tag == "PII" and role == "scientist") or (tag is None and (c in OPEN_COLUMNS or unknown == "keep")):
            shown.append(F.col(c))
    return df.select(*shown)


def data_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type, description, classification) from the schemas."""
    rows = [(t, f.name, f.dataType.simpleString(), COLUMN_DESCRIPTIONS.get(f.name, ""),
             PHI_TAGS.get(f.name, "non-sensitive"), TABLE_DESCRIPTIONS.get(t, ""))
            for t, df in tables.items() for f in df.schema.fields]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, "
                                       "description string, classification string, table_description string")
