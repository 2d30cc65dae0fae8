"""Date helpers: month buckets, surrogate date keys and fiscal periods."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the federal fiscal year starts on 1 October.
FISCAL_YEAR_START_MONTH = 10

#: Formats read beside ISO; the oracle's are the same in its own spelling.
DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d", "dd-MMM-yyyy")
ORACLE_DATE_FORMATS = ("%m/%d/%Y", "%Y/%m/%d", "%d-%b-%Y")


def to_date_lenient(c: Column) -> Column:
    """Text -> DATE, NULL when it does not parse (the coerce rule). ISO text first, then
    DATE_FORMATS in order; of two readings of 01/02/2021 the month comes first."""
    return F.coalesce(c.try_cast("date"), *[F.try_to_date(c, f) for f in DATE_FORMATS])


_SLASHED = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$"


def date_reading(c: Column) -> Column:
    """How a text can be read as a date: ``iso``, ``month_first`` or ``day_first`` (the other order
    has no such month), ``either`` (both numbers are the same), ``ambiguous`` (both orders give a date,
    and not the same one), ``other`` (another known format), ``unreadable``; NULL for NULL."""
    part = lambda i: F.regexp_extract(c, _SLASHED, i).cast("int")
    slashed = c.rlike(_SLASHED)
    a, b = F.when(slashed, part(1)), F.when(slashed, part(2))
    order = (F.when((a > 12) & (b > 12), F.lit("unreadable")).when(a > 12, F.lit("day_first")).when(b > 12, F.lit("month_first"))
             .when(a == b, F.lit("either")).otherwise(F.lit("ambiguous")))
    return (F.when(c.isNull(), F.lit(None).cast("string")).when(c.try_cast("date").isNotNull(), F.lit("iso")).when(slashed, order)
            .when(to_date_lenient(c).isNotNull(), F.lit("other")).otherwise(F.lit("unreadable")))


def day_first_text(c: Column) -> Column:
    """Slashed dates that are written day first as ISO text, other texts unchanged: for deliveries that
    ``quality.date_orders`` finds to be written so, before cleaning."""
    read = F.date_format(F.try_to_date(F.when(c.rlike(_SLASHED), F.trim(c)), "d/M/yyyy"), "yyyy-MM-dd")
    return F.coalesce(read, c)


def month_start(d: Column) -> Column:
    """First day of the month as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(d, "MM")


def date_key(d: Column) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def service_month(d: Column) -> Column:
    """'yyyy-MM' partition value."""
    return F.date_format(d, "yyyy-MM")


def fiscal_year(d: Column) -> Column:
    return F.when(F.month(d) >= FISCAL_YEAR_START_MONTH, F.year(d) + 1).otherwise(F.year(d))


def fiscal_period(d: Column) -> Column:
    """'FY<fiscal year>-Q<calendar quarter>' (the quarter stays calendar-based)."""
    return F.concat(F.lit("FY"), fiscal_year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
