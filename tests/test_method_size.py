"""Generated methods stay under the size that HotSpot compiles; written shorter, lines keep their values."""

import contextlib
import io
import re

import duckdb
import pytest

from claimlake import oracle as O
from claimlake.functions import money_or_zero
from claimlake.operators import star as G
from claimlake.plans.pipeline import silver_from_tables
from claimlake.registry.gold import SILVER_COLS
from claimlake.schema import RAW_COLUMNS
from claimlake.sources.fixture import raw_claims
from conftest import SF_SMALL

COMPILED = 8000  # bytes of bytecode, HotSpot's HugeMethodLimit


@pytest.mark.parametrize("name", ["raw", "silver", "fact", "items"])
def test_methods_are_compiled(spark, name):
    # as over large tables: orders are shuffled, suppliers sent to every task
    with _settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "8k"}):
        assert 0 < _largest_method(spark, name) < COMPILED


@contextlib.contextmanager
def _settings(spark, new):
    old = {k: spark.conf.get(k) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _largest_method(spark, name):
    df = {"raw": lambda: raw_claims(spark, SF_SMALL), "silver": lambda: silver_from_tables(spark, SF_SMALL).select(*SILVER_COLS),
          "fact": lambda: G.fact_claims(silver_from_tables(spark, SF_SMALL)),
          "items": lambda: G.fact_claim_items(silver_from_tables(spark, SF_SMALL, "notebook"))}[name]()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


def test_short_forms_have_the_same_lines(spark):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(O.query(f"SELECT {', '.join(RAW_COLUMNS)} FROM raw", ["raw"])).fetchall()
    got = [tuple(r) for r in raw_claims(spark, SF_SMALL).select(*RAW_COLUMNS).collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(want)


def test_money_or_zero(spark):
    rows = spark.createDataFrame([(x,) for x in ("1.25", "n/a", None, "", "-3", "98765432109876543.21", "1e3")], "m string")
    got = [None if r[0] is None else float(r[0]) for r in rows.select(money_or_zero(rows.m)).collect()]
    assert got == [1.25, 0.0, 0.0, 0.0, -3.0, None, 1000.0]
