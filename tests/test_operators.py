"""Operator behaviour on small literal inputs and on the claims fixture."""

import os
import uuid

from pyspark.sql import functions as F

from claimlake.operators import cleaning as C, dedup as D, quality as Q, star as G
from claimlake.plans import views as V
from claimlake.session import checkpoint_dir
from conftest import SF_SMALL, raw_frame

BASE = {"claimant_id": "1", "received_date": "2021-01-05", "claim_code": "99213", "charge_amt": "100.00",
        "allowed_amt": "60.00", "units": "1", "oi_in_network": "y", "service_provider": "P",
        "service_address_3": "1 A ST - 1234567890", "service_address_2": "Houston, TX",
        "proc_desc": "visit"}


def test_dedup_keeps_lowest_id(spark):
    rows = [dict(BASE, claim_item_id=i) for i in ("200", "100", "300")]
    silver = C.clean_claims(raw_frame(spark, rows), batch_id="t")
    kept = D.keep_first(silver).select("claim_item_id").collect()
    assert [r[0] for r in kept] == [100]
    assert D.quarantine(silver).count() == 3
    assert D.flag_duplicates(silver).where("is_duplicate").count() == 3


def test_doc_profile_dedups_and_masks(spark):
    rows = [dict(BASE, claim_item_id=i) for i in ("200", "100")]
    out = C.clean_claims(raw_frame(spark, rows), profile="doc", batch_id="t").collect()
    assert len(out) == 1 and out[0].claim_item_id == 100
    assert len(out[0].claimant_id) == 64 and out[0].type == "Medicare"


def test_lambda_profile_rules(spark):
    rows = [dict(BASE, claim_item_id="1", charge_amt="n/a", units="0", type=None),
            dict(BASE, claim_item_id="2", allowed_amt="-5.00", units="2.7", type="group")]
    out = {r.claim_item_id: r for r in C.clean_claims(raw_frame(spark, rows), batch_id="t").collect()}
    assert float(out[1].charge_amt) == 0.0 and out[1].units == 0 and not out[1].is_valid  # X17, X18
    assert out[1].claim_type == "UNKNOWN" and out[2].claim_type == "GROUP"
    assert out[2].units == 2 and out[2].has_negative_allowed and out[2]._validation_status == "FAIL"
    assert out[1].oi_in_network == "Y" and out[1].provider_npi == "1234567890"


def test_notebook_claim_type(spark):
    rows = [dict(BASE, claim_item_id="1", claim_code="U0003"),
            dict(BASE, claim_item_id="2", claim_code="90837"),
            dict(BASE, claim_item_id="3", proc_desc="Therapy 97110"),
            dict(BASE, claim_item_id="4", claim_code_modifier="pt"),
            dict(BASE, claim_item_id="5", type="Medicare"),
            dict(BASE, claim_item_id="6")]
    out = {r.claim_item_id: r.claim_type
           for r in C.clean_claims(raw_frame(spark, rows), profile="notebook", batch_id="t").collect()}
    assert out == {1: "COVID_TEST", 2: "MENTAL_HEALTH", 3: "PHYSICAL_THERAPY", 4: "PHYSICAL_THERAPY",
                   5: "MEDICARE", 6: "UNKNOWN"}


def test_dim_date(spark):
    d = G.dim_date(spark)
    assert d.count() == 4018
    r = d.where(F.col("date_key") == 20211003).first()
    assert (r.quarter, r.is_weekend, r.fiscal_year, r.fiscal_period, r.month_name) == (4, True, 2022, "FY2022-Q4", "October")
    assert G.dim_date_short(spark).count() == 4018


def test_remittance_does_not_fan_out(spark):
    """A charge of 100 with three adjustment rows still totals 100."""
    rows = [dict(BASE, claim_item_id="1", type="Medicare", claim_code_modifier="CO")]
    silver = C.clean_claims(raw_frame(spark, rows), batch_id="t")
    star = G.build_star(silver)
    remit = star.fact_remittance
    star.fact_remittance = remit.unionByName(remit).unionByName(remit)
    got = V.revenue_cycle_kpi_wide(star).first()
    assert float(got.gross_charges) == 100.0 and got.total_claims == 1


def test_required_columns(spark):
    import pytest
    with pytest.raises(ValueError, match="Missing required columns"):
        C.require_columns(spark.createDataFrame([("1",)], "claimant_id string"))


def test_quality_report_empty_input(spark):
    silver = C.clean_claims(raw_frame(spark, [dict(BASE, claim_item_id="1")]), batch_id="t").limit(0)
    r = Q.quality_report(silver).first()
    assert r.total_rows == 0 and r.quality_score is None


def test_route_partitions_rows(spark):
    from claimlake.plans.pipeline import silver_from_tables
    silver = silver_from_tables(spark, SF_SMALL)
    passed, failed = Q.route(silver, Q.SILVER_RULES)
    assert passed.count() + failed.count() == silver.count()


def test_role_view(spark):
    import pytest
    fact = spark.createDataFrame([(1, 7, "addr")], "claim_item_id long, claimant_id long, service_address_3 string")
    analyst = Q.role_view(fact, "analyst")
    assert analyst.columns == ["claim_item_id", "claimant_id"] and len(analyst.first().claimant_id) == 64
    assert Q.role_view(fact, "scientist").columns == fact.columns
    with pytest.raises(PermissionError):
        Q.role_view(fact, "executive")


def test_data_dictionary(spark):
    from claimlake.plans.pipeline import star_from_tables
    star = star_from_tables(spark, SF_SMALL)
    dd = Q.data_dictionary(star.tables())
    r = dd.where((F.col("table_name") == "fact_claims") & (F.col("column_name") == "claimant_id")).first()
    assert r.classification == "PHI" and r.description


def test_pipeline_run_is_idempotent(spark):
    from claimlake.plans.pipeline import read_star, run
    from claimlake.sources.fixture import raw_claims
    out = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    raw = raw_claims(spark, SF_SMALL)
    valid = C.clean_claims(raw).where("is_valid").count()  # unparsed and oversized amounts are not
    for _ in range(2):
        status = run(spark, raw, out, batch_id="20240101_000000").collect()
        assert all(r.status == "SUCCESS" for r in status)
        rows = {r.table: r.rows for r in status}
        assert rows["silver"] == raw.count() and rows["fact_claims"] == valid
    star = read_star(spark, os.path.join(out, "gold"))
    assert spark.read.parquet(os.path.join(out, "bronze")).count() == raw.count()
    assert star.fact_claims.count() == valid
    # month filter prunes partitions of the written fact
    plan = star.fact_claims.where(F.col("service_month") == "2021-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_month" in plan


def test_star_builds_from_every_profile(spark):
    from claimlake.plans.pipeline import star_from_tables
    for profile in ("doc", "notebook"):
        star = star_from_tables(spark, SF_SMALL, profile)
        assert V.financial_summary(star).count() > 0
        assert star.fact_claims.where(F.col("claim_item_id").isNull()).count() == 0


def test_bucketed_claim_facts_join_without_shuffle(spark):
    from claimlake.plans.pipeline import read_star, run
    from claimlake.sources.fixture import raw_claims
    out = os.path.join(checkpoint_dir(spark), f"b-{uuid.uuid4().hex}")
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    status = run(spark, raw_claims(spark, SF_SMALL), out, batch_id="20240101_000000", bucket_claims=8,
                 table_prefix=prefix).collect()
    assert all(r.status == "SUCCESS" for r in status)
    star = read_star(spark, os.path.join(out, "gold"), table_prefix=prefix)
    plain = read_star(spark, os.path.join(out, "gold"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-or-bucket choice
    try:
        joined = star.fact_claims.join(star.fact_remittance,
                                       star.fact_claims["claim_item_id"] == star.fact_remittance["claim_id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        a = V.revenue_cycle_kpi_wide(star).drop("specialty")
        b = V.revenue_cycle_kpi_wide(plain).drop("specialty")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_financial_summary_approx_patients(spark):
    from claimlake.plans.pipeline import star_from_tables
    star = star_from_tables(spark, SF_SMALL)
    exact = {r.month: r.unique_patients for r in V.financial_summary(star).collect()}
    approx = {r.month: r.unique_patients for r in V.financial_summary(star, approx_patients=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[m] - exact[m]) <= max(2, 0.1 * exact[m]) for m in exact)
