"""Plan checks: no Python in Silver, pushdown, pre-aggregation before joins."""

from claimlake.plans import views as V
from claimlake.plans.pipeline import silver_from_tables, star_from_tables
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_has_no_python_worker(spark):
    plan = _plan(silver_from_tables(spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_provider_views_aggregate_before_join(spark):
    star = star_from_tables(spark, SF_SMALL)
    plan = V.provider_kpis(star)._jdf.queryExecution().optimizedPlan().toString()
    # an Aggregate sits below the join with the provider dimension
    join_at = plan.index("Join Inner")
    assert "Aggregate" in plan[join_at:]


def test_dedup_uses_group_limit(spark):
    from claimlake.operators.dedup import keep_first
    plan = _plan(keep_first(silver_from_tables(spark, SF_SMALL)))
    assert "WindowGroupLimit" in plan  # partial limit before the shuffle


def test_small_dimension_is_broadcast_over_written_star(spark):
    import os
    import uuid
    from claimlake.plans.pipeline import read_star, run
    from claimlake.session import checkpoint_dir
    from claimlake.sources.fixture import raw_claims
    out = os.path.join(checkpoint_dir(spark), f"pl-{uuid.uuid4().hex}")
    run(spark, raw_claims(spark, SF_SMALL), out, batch_id="20240101_000000").collect()
    star = read_star(spark, os.path.join(out, "gold"))
    df = V.monthly_costs(star)
    df.collect()  # final adaptive plan
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final


def test_view_counts_scan_the_fact_once(spark, tmp_path):
    from types import SimpleNamespace

    from claimlake.plans import analysis as A
    star = star_from_tables(spark, SF_SMALL)
    written = {}
    for name in ("fact_claims", "dim_provider", "dim_procedure"):
        getattr(star, name).write.parquet(str(tmp_path / name))
        written[name] = spark.read.parquet(str(tmp_path / name))
    written = SimpleNamespace(**written)
    counts = A.view_row_counts(written)
    scans = [line for line in _plan(counts).splitlines() if "FileScan" in line]
    assert sum("received_date" in line for line in scans) == 1 and len(scans) == 3
    got = {r["view_name"]: r["row_count"] for r in counts.collect()}
    assert got == {n: V.VIEWS[n](written).count() for n in A.COUNTED_VIEWS}
    empty = SimpleNamespace(**{k: v.limit(0) for k, v in vars(written).items()})
    assert {r["row_count"] for r in A.view_row_counts(empty).collect()} == {0}
