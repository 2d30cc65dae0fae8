"""Profiles in one pass, and running profiles from stored sketches."""

import pytest
from pyspark.sql import functions as F

from claimlake.operators import quality as Q


@pytest.fixture
def written(spark, tmp_path):
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 700).alias("a"), F.when(F.col("id") % 3 == 0, F.lit("x")).alias("b"),
        (F.col("id") * 1.5).alias("c"), F.lit(None).cast("string").alias("d"), F.expr("date_add(DATE '2020-01-01', cast(id % 40 AS int))").alias("e"))
    df.write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def rows(df):
    return {r["column_name"]: (r["data_type"], r["null_count"], r["unique_values"]) for r in df.collect()}


def test_equals_a_count_per_column(written):
    got = rows(Q.profile(written))
    for c, t in written.dtypes:
        assert got[c] == (t, written.where(F.col(c).isNull()).count(), written.select(F.count_distinct(c)).first()[0])


def test_one_scan(written):
    plan = Q.profile(written)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "count(distinct" not in plan


def test_empty_table_and_signed_zero(spark):
    assert rows(Q.profile(spark.createDataFrame([], "a int, b string"))) == {"a": ("int", 0, 0), "b": ("string", 0, 0)}
    assert rows(Q.profile(spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (float("nan"),), (float("nan"),)], "a double")))["a"] == ("double", 0, 3)


def test_a_hot_value_is_combined_before_the_shuffle(spark):
    plan = Q.profile(spark.range(10))._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(i")
    assert "partial_count" in plan[shuffle:]


def test_merged_sketches_stay_within_their_error(spark, tmp_path):
    path, n = str(tmp_path / "s"), 60_000
    for i in range(4):  # batches overlap by half
        part = spark.range(i * n // 2, i * n // 2 + n).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("m"))
        Q.profile_sketches(part, str(i)).write.mode("append").parquet(path)
    got = {r["column_name"]: r for r in Q.running_profile(spark.read.parquet(path)).collect()}
    assert abs(got["k"]["unique_values"] - 2.5 * n) <= 4 * Q.SKETCH_ERROR * 2.5 * n
    assert (got["m"]["unique_values"], got["m"]["rows"], got["m"]["null_count"]) == (5, 4 * n, 2 * n)
