"""Exact quantiles by refining a histogram.

``percentile`` holds every distinct value of a group in one buffer, in one task. Here the value
of a rank is found by counting: the range of all values is cut into bins, the bin that holds
the rank becomes the next range, and so on until a bin is a single value. A pass counts, with
map-side combining, at most ``BINS`` bins for each rank looked for, so no task ever holds
more than these; values outside the current ranges are filtered out before they are counted. A range
of 2^63 units takes 6 passes, the cents of amounts up to a million 3.

Values are whole units: integers, or decimals as multiples of their last place (cents). A double of
few places is given with its ``scale``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bins that a range is cut into.
BINS = 4096


def _units(df: DataFrame, column: str, scale: int | None) -> tuple[Column, int]:
    """The values as whole units, and the decimal places of a unit."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        scale = kind.scale
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        scale = 0
    elif scale is None:
        raise ValueError(f"{column} needs a scale: its decimal places")
    exact = F.col(column).cast(T.DecimalType(38, scale)) if not isinstance(kind, T.DecimalType) else F.col(column)
    return (exact * F.lit(10**scale).cast(T.DecimalType(scale + 1, 0))).cast("decimal(38,0)"), scale


def order_statistics(df: DataFrame, column: str, ranks: list[int], scale: int | None = None) -> dict[int, Decimal]:
    """rank (from 0) -> value. Ranks beyond the non-NULL values are left out."""
    units, scale = _units(df, column, scale)
    values = df.select(units.alias("v")).where(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n")).first()
    n = span["n"]
    # rank -> (lowest value of its range, highest, rank within the range)
    open_ = {r: (int(span["lo"]), int(span["hi"]), r) for r in sorted(set(ranks)) if 0 <= r < n}
    found = {r: lo for r, (lo, hi, _) in open_.items() if lo == hi}
    while open_ := {r: x for r, x in open_.items() if r not in found}:
        ranges = sorted({(lo, hi) for lo, hi, _ in open_.values()})
        steps = {x: -(-(x[1] - x[0] + 1) // BINS) for x in ranges}
        whole = lambda x: f"cast('{x}' AS decimal(38,0))"
        # div is exact; the quotient of two decimals would be rounded
        bins = F.array(*[F.expr(f"CASE WHEN v BETWEEN {whole(lo)} AND {whole(hi)} THEN struct({i} AS i, cast((v - {whole(lo)}) div {whole(steps[lo, hi])} AS int) AS bin) END")
                         for i, (lo, hi) in enumerate(ranges)])
        inside = values.select(F.explode(bins).alias("b")).where(F.col("b").isNotNull())
        counts: dict[int, list[tuple[int, int]]] = {}
        for r in inside.groupBy("b.i", "b.bin").agg(F.count(F.lit(1)).alias("n")).collect():  # at most BINS for each range
            counts.setdefault(r["i"], []).append((r["bin"], r["n"]))
        for rank, (lo, hi, within) in open_.items():
            step = steps[lo, hi]
            for b, held in sorted(counts[ranges.index((lo, hi))]):
                if within < held:
                    break
                within -= held
            low = lo + b * step
            open_[rank] = (low, min(hi, low + step - 1), within)
            if step == 1:
                found[rank] = low
    return {r: Decimal(v).scaleb(-scale) for r, v in found.items()}


def quantiles(df: DataFrame, column: str, shares: list[float], scale: int | None = None) -> list[float | None]:
    """What ``percentile`` gives for each share: the value at rank share * (n - 1), in proportion between the
    two values next to it. None for all if there is no value."""
    n = df.agg(F.count(column)).first()[0]
    if not n:
        return [None] * len(shares)
    places = [s * (n - 1) for s in shares]
    ranks = sorted({r for p in places for r in (int(p), min(n - 1, int(p) + (p > int(p))))})
    at = {r: float(v) for r, v in order_statistics(df, column, ranks, scale).items()}

    def between(p: float) -> float:
        low = int(p)
        high = low + (p > low)
        if low == high or at[low] == at[high]:
            return at[low]
        return (high - p) * at[low] + (p - low) * at[high]

    return [between(p) for p in places]
