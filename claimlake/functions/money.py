"""Numeric parsing and exact rounding helpers.

Money stays DECIMAL end to end so sums are exact and independent of the
order in which partitions are combined. Ratios and averages are computed in
DECIMAL, rounded half-up, and only then converted to DOUBLE for reporting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
#: Claim ids: the joined keys of a line need more than a BIGINT (see ``sources.fixture``).
CLAIM_ID = "decimal(38,0)"


def to_money(c: Column) -> Column:
    """Text -> DECIMAL(18,2); anything unparseable or too large becomes NULL (never an error)."""
    return c.try_cast(MONEY)


def money_or_zero(c: Column) -> Column:
    """Text -> DECIMAL(18,2) with 0 for what is no number; a number that is too large
    stays NULL, so that the line is flagged invalid instead of counting as free."""
    money = to_money(c)
    return F.coalesce(money, F.when(to_number(c).isNull(), F.lit(0).cast(MONEY)))


def to_claim_id(c: Column) -> Column:
    return c.try_cast(CLAIM_ID)


def to_number(c: Column) -> Column:
    """Text -> DOUBLE, NULL when unparseable."""
    return c.try_cast("double")


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def to_int_truncated(c: Column, default: float | None = None) -> Column:
    """Text -> INT through DOUBLE, truncating toward zero ('2.7' -> 2).

    ``default`` replaces values that do not parse (before truncation).
    """
    num = to_number(c)
    if default is not None:
        num = F.coalesce(num, F.lit(float(default)))
    return num.try_cast("int")


def round2(c: Column, scale: int = 2) -> Column:
    """Half-up rounding reported as DOUBLE (round happens in DECIMAL first)."""
    return F.round(c, scale).cast("double")


def exact_avg(c: Column) -> Column:
    """Average of a DECIMAL column as sum/count in DECIMAL.

    ``avg(decimal)`` rounds its result to six places before any later
    ``round``; dividing the exact sum keeps 18 places, so a later two-place
    rounding sees the true value. NULL for an empty group.
    """
    return F.try_divide(F.sum(c), F.count(c))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL when the denominator is 0 or NULL."""
    return F.when(den != 0, num / den)


# Operand type for money divisions: DECIMAL(20,2) (up to 10^18) keeps the
# quotient at >= 18 decimal places; a wider operand (e.g. a sum of sums)
# would make Spark cut the quotient to 6 places before a later rounding.
MONEY_SUM = "decimal(20,2)"


def money_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` for money totals, exact to 18+ places."""
    return safe_ratio(num.cast(MONEY_SUM), den.cast(MONEY_SUM))


def money_avg(total: Column, count: Column) -> Column:
    """Average from a money total and a row count, exact to 18+ places."""
    return F.try_divide(total.cast(MONEY_SUM), count)


def pct_of(part: Column, whole: Column) -> Column:
    """``part * 100.0 / whole`` in DOUBLE arithmetic, unrounded."""
    return part.cast("double") * F.lit(100.0) / whole.cast("double")


def clip_negative(c: Column) -> Column:
    """Negative -> 0, NULL stays NULL (``greatest(c, 0)`` would turn NULL to 0)."""
    return F.when(c < 0, F.lit(0).cast(MONEY)).otherwise(c)
