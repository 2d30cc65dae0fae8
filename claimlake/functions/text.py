"""Provider address parsing as Spark SQL expressions (no Python workers).

All parsers return ``Column`` objects, so they run inside whole-stage codegen
and vectorise over every row of a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that define the parse rules (must match the reference's rules).
NPI_10_DIGITS = r"\b(\d{10})\b"      # a standard NPI: ten digits as a whole word
NPI_9_OR_10_DIGITS = r"\b(\d{9,10})\b"
DIGIT_RUN = r"(\d+)"
DASH_SEPARATOR = " - "
NPI_MIN_FALLBACK_LEN = 9


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _part(c: Column, sep: str, i: int) -> Column:
    """0-based piece ``i`` of ``c`` split on a literal separator, NULL past the end."""
    return F.get(F.split(c, sep), F.lit(i))


def npi_strict(address: Column) -> Column:
    """First ten-digit word in the address, else NULL."""
    return _blank_to_null(F.regexp_extract(address, NPI_10_DIGITS, 1))


def npi_with_fallback(address: Column) -> Column:
    """NPI with a three-step fallback.

    1. the first ten-digit word;
    2. in the text between the first and second ``' - '``, the longest digit
       run (the first one on ties) when it has at least nine digits;
    3. the first nine- or ten-digit word;
    else NULL. Empty or NULL input gives NULL.
    """
    after_dash = F.when(address.contains(DASH_SEPARATOR), _part(address, DASH_SEPARATOR, 1))
    runs = F.regexp_extract_all(after_dash, F.lit(DIGIT_RUN), 1)
    # strict '>' keeps the earlier run on equal length; the length test is the
    # finish step, so the array is scanned once per row
    step2 = F.aggregate(runs, F.lit(""),
                        lambda acc, x: F.when(F.length(x) > F.length(acc), x).otherwise(acc),
                        lambda acc: F.when(F.length(acc) >= NPI_MIN_FALLBACK_LEN, acc))
    step3 = _blank_to_null(F.regexp_extract(address, NPI_9_OR_10_DIGITS, 1))
    return F.coalesce(npi_strict(address), step2, step3)


def npi_after_dash(address: Column) -> Column:
    """Text after the first ``' - '`` up to the next one (the notebook's rule)."""
    return F.when(address.contains(DASH_SEPARATOR), _part(address, DASH_SEPARATOR, 1))


def street_before_dash(address: Column) -> Column:
    """Street part: text before the first ``' - '``, or the whole address."""
    blank = address.isNull() | (address == "")
    return (F.when(blank, F.lit(None).cast("string"))
            .when(address.contains(DASH_SEPARATOR), _part(address, DASH_SEPARATOR, 0))
            .otherwise(address))


def city_state_first_comma(addr: Column) -> tuple[Column, Column]:
    """``'City, ST'`` split on commas: city = trimmed first piece, state = the
    first two capital letters in the trimmed second piece. No comma: the whole
    text is the city and the state is NULL."""
    blank = addr.isNull() | (addr == "")
    has_comma = addr.contains(",")
    city = (F.when(blank, F.lit(None).cast("string"))
            .when(has_comma, F.trim(_part(addr, ",", 0)))
            .otherwise(addr))
    state = F.when(~blank & has_comma,
                   _blank_to_null(F.regexp_extract(F.trim(_part(addr, ",", 1)), "([A-Z]{2})", 1)))
    return city, state


def city_state_last_comma(addr: Column) -> tuple[Column, Column]:
    """Split at the last comma: city = trimmed text before it, state = trimmed
    text after it. No comma: trimmed whole text and NULL."""
    has_comma = addr.contains(",")
    city = F.when(has_comma, F.trim(F.regexp_extract(addr, r"^(.*),[^,]*$", 1))).otherwise(F.trim(addr))
    state = F.when(has_comma, F.trim(F.substring_index(addr, ",", -1)))
    return city, state


def city_state_two_chars(addr: Column) -> tuple[Column, Column]:
    """City = trimmed first comma piece; state = first two characters of the
    trimmed second piece. No comma: whole text and NULL."""
    blank = addr.isNull() | (addr == "")
    has_comma = addr.contains(",")
    city = (F.when(blank, F.lit(None).cast("string"))
            .when(has_comma, F.trim(_part(addr, ",", 0)))
            .otherwise(addr))
    state = F.when(~blank & has_comma, F.substring(F.trim(_part(addr, ",", 1)), 1, 2))
    return city, state


def code_type(code: Column) -> Column:
    """CPT when the procedure code starts with a digit, HCPCS when with a letter."""
    return (F.when(code.rlike("^[0-9]"), F.lit("CPT"))
            .when(code.rlike("^[A-Za-z]"), F.lit("HCPCS")))
