"""Hot keys: one key holding a third of all rows must give exact results."""

import datetime as dt

from pyspark.sql import functions as F

from claimlake.operators import dedup as D
from claimlake.operators.star import build_star
from claimlake.plans import views as V
from claimlake.plans.pipeline import silver_from_tables
from claimlake.schema import DUPLICATE_KEY
from conftest import SF_SMALL


def _hot(silver):
    hot = F.col("claim_item_id") % 3 == 0   # test data shaping only
    return silver.withColumns({
        "claimant_id": F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("claimant_id")),
        "received_date": F.when(hot, F.lit(dt.date(2021, 5, 1))).otherwise(F.col("received_date")),
        "claim_code": F.when(hot, F.lit("99213")).otherwise(F.col("claim_code")),
        "charge_amt": F.when(hot, F.lit(100).cast("decimal(12,2)")).otherwise(F.col("charge_amt")),
        "provider_npi": F.when(hot, F.lit("1000000000")).otherwise(F.col("provider_npi")),
    })


def test_hot_duplicate_key(spark):
    silver = _hot(silver_from_tables(spark, SF_SMALL))
    n_keys = silver.select(*DUPLICATE_KEY).distinct().count()
    assert D.keep_first(silver).count() == n_keys
    sizes = silver.groupBy(*DUPLICATE_KEY).count()
    expected = sizes.where("count > 1").agg(F.sum("count")).first()[0]
    assert D.quarantine(silver).count() == expected
    assert D.flag_duplicates(silver).where("is_duplicate").count() == expected
    # the kept row of the hot key is its lowest id
    is_hot = ((F.col("claimant_id") == 1) & (F.col("received_date") == dt.date(2021, 5, 1))
              & (F.col("claim_code") == "99213") & (F.col("charge_amt") == 100))
    hot_min = silver.where(is_hot).agg(F.min("claim_item_id")).first()[0]
    kept = D.keep_first(silver).where(is_hot).select("claim_item_id").collect()
    assert [r[0] for r in kept] == [hot_min]


def test_hot_npi_views_equal_literal_join(spark):
    star = build_star(_hot(silver_from_tables(spark, SF_SMALL)))
    got = V.provider_kpis(star).select("provider_name", "city", "state", "total_claims", "total_charged",
                                       "avg_charge")
    f, p = star.fact_claims, star.dim_provider
    literal = (f.join(p, "provider_npi").groupBy("provider_name", "city", "state")
                .agg(F.count(F.lit(1)).alias("total_claims"), F.sum("charge_amt").alias("total_charged"),
                     F.round(F.avg("charge_amt"), 2).cast("double").alias("avg_charge")))
    assert got.exceptAll(literal).count() == 0 and literal.exceptAll(got).count() == 0
