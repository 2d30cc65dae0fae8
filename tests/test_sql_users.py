"""SQL users: star tables and views registered as temp views answer SQL directly in
Spark, with the same results as the DataFrame plans."""

from pyspark.sql import functions as F

from claimlake.plans import analysis as A, views as V
from claimlake.plans.pipeline import star_from_tables
from conftest import SF_SMALL


def _rows(df):
    return sorted(str([round(float(x), 6) if isinstance(x, float) or hasattr(x, "as_tuple") else x for x in r]) for r in df.collect())


def test_sql_over_registered_views(spark):
    star = star_from_tables(spark, SF_SMALL).register()
    V.register_views(star)
    spark.createDataFrame([(s, r) for r, states in A.REGIONS.items() for s in states], "state string, region string").createOrReplaceTempView("state_regions")
    regions = spark.sql("SELECT ifnull(r.region, 'Other') AS region, sum(g.claim_count) AS lines "
                        "FROM vw_geo_cost_variation g LEFT JOIN state_regions r ON r.state <=> g.state GROUP BY ALL")
    assert _rows(regions) == _rows(A.region_summary(star).select("region", "total_claims"))
    grown = spark.sql("SELECT b.month FROM vw_financial_summary a JOIN vw_financial_summary b "
                      "ON b.month = add_months(a.month, 1) WHERE b.gross_revenue > a.gross_revenue")
    want = A.mom_growth(star).where((F.col("mom_growth_pct") > 0) | (F.col("gross_revenue") > F.col("previous_month_revenue"))).where("month IS NOT NULL")
    assert _rows(grown) == _rows(want.select("month"))
    per_state = spark.sql("SELECT state, count(*) FROM fact_claims NATURAL JOIN dim_provider GROUP BY state HAVING count(*) > 10")
    assert _rows(per_state) == _rows(V.geo_cost_variation(star).select("state", "claim_count"))
