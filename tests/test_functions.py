"""Unit cases for the column expressions (FIXTURES.md section 2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake import functions as X


def _one(spark, expr_fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"a {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("a"))).collect()]


NPI_CASES = [
    ("123 Main St, 1234567890", "1234567890", "1234567890"),
    (None, None, None),
    ("123 Main St, No NPI here", None, None),
    ("8885 VENICE BLVD STE 104 - 900343242", "900343242", None),
    ("PO BOX 95970 - 840950970", "840950970", None),
    ("6 BENDIX - 926182006", "926182006", None),
    ("A - 12345678901", "12345678901", None),
    ("A - 111111111 222222222", "111111111", None),
    ("A - 1234 - 987654321", "987654321", None),
    ("", None, None),
]


@pytest.mark.parametrize("addr,fallback,strict", NPI_CASES)
def test_npi(spark, addr, fallback, strict):
    assert _one(spark, X.npi_with_fallback, [addr]) == [fallback]
    assert _one(spark, X.npi_strict, [addr]) == [strict]


CITY_CASES = [
    # address, first-comma (lambda), last-comma (doc), two-chars (notebook)
    ("Houston, TX", ("Houston", "TX"), ("Houston", "TX"), ("Houston", "TX")),
    (None, (None, None), (None, None), (None, None)),
    ("Houston", ("Houston", None), ("Houston", None), ("Houston", None)),
    ("A, B, TX", ("A", None), ("A, B", "TX"), ("A", "B")),
]


@pytest.mark.parametrize("addr,first,last,two", CITY_CASES)
def test_city_state(spark, addr, first, last, two):
    df = spark.createDataFrame([(addr,)], "a string")
    for fn, want in [(X.city_state_first_comma, first), (X.city_state_last_comma, last),
                     (X.city_state_two_chars, two)]:
        city, state = fn(F.col("a"))
        assert tuple(df.select(city, state).first()) == want, fn.__name__


def test_number_traps(spark):
    """Bad casts give NULL, not an error; '2.7' units truncate to 2 via DOUBLE."""
    df = spark.createDataFrame([("2.7", "n/a"), ("x", "-5.00"), (None, "12.345")], "u string, m string")
    got = df.select(X.to_int_truncated(F.col("u"), default=1).alias("u"), X.to_money(F.col("m")).alias("m")).collect()
    assert [r.u for r in got] == [2, 1, 1]
    assert [None if r.m is None else float(r.m) for r in got] == [None, -5.0, 12.35]


def test_round_half_up_and_safe_ratio(spark):
    df = spark.createDataFrame([(1, 0), (1, 8)], "a int, b int")
    got = df.select(X.safe_ratio(F.col("a").cast("decimal(12,2)"), F.col("b").cast("decimal(12,2)")).alias("r")).collect()
    assert got[0].r is None
    assert X.round2 is not None
    half = spark.range(1).select(X.round2(F.lit(12.345).cast("decimal(10,3)")).alias("v")).first().v
    assert half == 12.35


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (4.0,)], "c double")
    got = [r[0] for r in df.select(X.clip_negative(F.col("c").cast("decimal(12,2)"))).collect()]
    assert [None if v is None else float(v) for v in got] == [0.0, None, 4.0]


def test_dates_and_fiscal(spark):
    df = spark.createDataFrame([(dt.date(2021, 10, 3),)], "d date")
    r = df.select(X.date_key(F.col("d")).alias("k"), X.service_month(F.col("d")).alias("m"),
                  X.fiscal_year(F.col("d")).alias("fy"), X.fiscal_period(F.col("d")).alias("fp"),
                  X.month_start(F.col("d")).alias("ms")).first()
    assert (r.k, r.m, r.fy, r.fp, r.ms) == (20211003, "2021-10", 2022, "FY2022-Q4", dt.date(2021, 10, 1))


def test_masking(spark):
    got = spark.createDataFrame([("123",), (None,)], "c string").select(
        X.mask_md5(F.col("c")).alias("m"), X.mask_sha256(F.col("c")).alias("s")).collect()
    assert got[0].m == "202cb962ac59075b964b07152d234b70"
    assert got[0].s.startswith("a665a459")
    assert got[1].m is None and got[1].s is None


def test_code_type(spark):
    assert _one(spark, X.code_type, ["99213", "G2023", None]) == ["CPT", "HCPCS", None]


def test_date_readings(spark):
    from claimlake.functions import date_reading, day_first_text
    texts = {"2021-03-04": "iso", "3/4/2021": "ambiguous", "13/4/2021": "day_first", "4/13/2021": "month_first", "5/5/2021": "either",
             "13/14/2021": "unreadable", "2021/3/4": "other", "04-Mar-2021": "other", "soon": "unreadable", None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", date_reading(F.col("t"))).collect()} == texts
    fixed = {r[0]: r[1] for r in df.select("t", day_first_text(F.col("t"))).collect()}
    assert fixed["3/4/2021"] == "2021-04-03" and fixed["13/4/2021"] == "2021-04-13" and fixed["4/13/2021"] == "4/13/2021" and fixed["soon"] == "soon"


def test_the_order_of_a_delivery(spark):
    from claimlake.operators.quality import date_orders
    rows = [("us", "1/31/2021"), ("us", "2/3/2021"), ("eu", "31/1/2021"), ("eu", "2/3/2021"), ("eu", "3/2/2021"), ("both", "31/1/2021"), ("both", "1/31/2021"), ("iso", "2021-01-01")]
    got = {r["f"]: (r["date_order"], r["ambiguous"]) for r in date_orders(spark.createDataFrame(rows, "f string, t string"), "t", ["f"]).collect()}
    assert got == {"us": ("month_first", 1), "eu": ("day_first", 2), "both": ("mixed", 0), "iso": (None, 0)}
