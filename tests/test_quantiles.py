"""Exact quantiles against ``percentile``."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimlake.operators import quantiles as Z

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def same(df, column, scale=None):
    want = df.agg(F.percentile(F.col(column).cast("double"), SHARES)).first()[0]
    got = Z.quantiles(df, column, SHARES, scale)
    assert got == pytest.approx(want, rel=1e-15, abs=0)


@pytest.mark.parametrize("bins", [3, 4096])
def test_equals_percentile(spark, monkeypatch, bins):
    monkeypatch.setattr(Z, "BINS", bins)
    df = spark.range(997).select(
        (F.col("id") * 7919 % 1000003).alias("whole"), (F.col("id") % 5).cast("int").alias("ties"),
        ((F.col("id") * 7919 % 100003 - 50000) / 100).cast("decimal(18,2)").alias("money"),
        F.when(F.col("id") % 3 > 0, (F.col("id") * 31 % 10000) / 100).alias("percent")).cache()
    for column, scale in (("whole", None), ("ties", None), ("money", None), ("percent", 2)):
        same(df, column, scale)


def test_few_rows(spark):
    for rows in ([(1,)], [(1,), (2,)], [(None,), (5,), (5,)]):
        same(spark.createDataFrame(rows, "a int"), "a")
    assert Z.quantiles(spark.createDataFrame([(None,)], "a int"), "a", [0.5]) == [None]
    with pytest.raises(ValueError):
        Z.quantiles(spark.createDataFrame([(1.5,)], "a double"), "a", [0.5])


def test_the_whole_range_of_amounts(spark):
    top = Decimal("9999999999999999.99")
    df = spark.createDataFrame([(-top,), (Decimal("0.01"),), (Decimal("0.02"),), (top,), (top,)], "a decimal(18,2)")
    assert Z.order_statistics(df, "a", [0, 1, 2, 3, 4, 9]) == {0: -top, 1: Decimal("0.01"), 2: Decimal("0.02"), 3: top, 4: top}


def test_no_task_holds_the_values(spark):
    df = spark.range(50_000).select((F.col("id") * 104_729 % 10_000_019).alias("a"))
    assert Z.order_statistics(df, "a", [25_000]) == {25_000: Decimal(sorted(i * 104_729 % 10_000_019 for i in range(50_000))[25_000])}
