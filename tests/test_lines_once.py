"""Jobs that read the lines several times read them as written, not derived anew."""

from claimlake import registry
from claimlake.operators import quality as Q
from claimlake.plans import marts as M
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_discount_quantiles_refine_written_discounts(spark, monkeypatch):
    seen, real = [], M.quantiles
    monkeypatch.setattr(M, "quantiles", lambda df, *a, **k: seen.append(_plan(df)) or real(df, *a, **k))
    registry.queries()["mart_discount_quantiles"](spark, SF_SMALL)
    assert len(seen) == 1 and "discount_pct" in seen[0] and "l_orderkey" not in seen[0]


def test_post_build_counts_tables_of_written_lines(spark, monkeypatch):
    seen, real = [], Q.post_build_checks
    monkeypatch.setattr(Q, "post_build_checks", lambda tables, *a: seen.extend(_plan(t) for t in tables.values()) or real(tables, *a))
    registry.queries()["dq_post_build"](spark, SF_SMALL).collect()
    assert len(seen) == 7 and not any("l_orderkey" in p for p in seen)
