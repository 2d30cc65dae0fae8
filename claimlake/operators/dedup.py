"""Duplicate handling on the 4-column claim key.

* ``keep_first``: one row per key, the lowest ``claim_item_id``. A
  ``row_number() = 1`` filter, which Spark plans with a partial
  ``WindowGroupLimit`` before the shuffle: each map task already keeps one
  row per key, so a key holding a third of all rows still ships only one row
  per task.
* ``duplicate_groups`` / ``quarantine`` / ``flag_duplicates``: members of keys
  seen more than once (pandas ``keep=False``). Counts come from a
  partial/final aggregate (map-side combine), and the rows are matched back
  with a null-safe semi/left join, which AQE splits when a key is skewed. No
  per-key window, so no task ever buffers a hot group.

NULL key parts group together, as pandas does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from claimlake.schema import DUPLICATE_KEY

#: Bits of the table that is sent to every task to tell repeated keys, 64 a row: 2,097,152 rows (some 70 MB)
#: at most, whatever the input. More keys than bits only let more rows be shuffled.
REPEAT_BITS = 1 << 27


def keep_first(df: DataFrame, keys=DUPLICATE_KEY, order_col: str = "claim_item_id", columns=None,
               sparse: bool = False) -> DataFrame:
    """Keep one row per key: lowest ``order_col`` (NULL last), remaining columns
    as a deterministic tie-break. ``columns``: only these are returned; columns that come after
    all of them break no tie that shows, so they are not moved. ``sparse``: rows are wide and few
    keys repeat; ``df`` is then read three times and should come from files."""
    if columns is not None:
        last = max((i for i, c in enumerate(df.columns) if c in columns and c not in (*keys, order_col)), default=-1)
        return keep_first(df.select(*dict.fromkeys([*df.columns[:last + 1], *keys, order_col])), keys, order_col, sparse=sparse).select(*columns)
    if sparse:
        marked = _may_repeat(df, keys)
        alone, several = (marked.where(which).select(*df.columns) for which in (~F.col("_repeat"), F.col("_repeat")))
        return alone.unionByName(keep_first(several, keys, order_col))
    tie = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c != order_col]
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_last(), *tie)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def with_bits(df: DataFrame, h, hashes: DataFrame, col: str) -> DataFrame:
    """Adds ``col``: True for rows whose hash ``h`` is among ``hashes`` (column ``_h``), and for some others
    that share a bit with one of these."""
    bit = lambda h: F.pmod(h, F.lit(REPEAT_BITS))
    words = (hashes.select(bit(F.col("_h")).alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word"))
                   .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_bit & 63 AS INT))")).alias("_bits")))
    rows = df.withColumn("_bit", bit(h)).withColumn("_word", F.shiftright("_bit", 6))
    return (rows.join(F.broadcast(words), "_word", "left")
                .withColumn(col, F.expr("coalesce(shiftright(_bits, CAST(_bit & 63 AS INT)) & 1L, 0L) = 1L")))


def _may_repeat(df: DataFrame, keys) -> DataFrame:
    """Adds ``_repeat``: True for all rows of a key that occurs more than once, and for some others whose
    hash shares a bit with one of these."""
    h = F.xxhash64(*keys)
    repeated = df.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    return with_bits(df, h, repeated, "_repeat")


def duplicate_groups(df: DataFrame, keys=DUPLICATE_KEY) -> DataFrame:
    """Keys that occur more than once, with their size (``duplicate_count``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
              .where(F.col("duplicate_count") > 1))


def _renamed_groups(df: DataFrame, keys) -> DataFrame:
    # fresh column names: the aggregate shares lineage with ``df``, and a
    # self-join on identical attributes would be ambiguous
    return (duplicate_groups(df, keys)
            .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_dup")))


def _null_safe_on(df: DataFrame, groups: DataFrame, keys) -> F.Column:
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(groups[f"_k_{k}"]) for k in keys])


def quarantine(df: DataFrame, keys=DUPLICATE_KEY) -> DataFrame:
    """Every member of a duplicated key, the kept row included (audit set)."""
    groups = _renamed_groups(df, keys)
    return df.join(groups, _null_safe_on(df, groups, keys), "left_semi")


def flag_duplicates(df: DataFrame, keys=DUPLICATE_KEY, col: str = "is_duplicate") -> DataFrame:
    """Adds a boolean: True for all members of a duplicated key."""
    groups = _renamed_groups(df, keys)
    return (df.join(groups, _null_safe_on(df, groups, keys), "left")
              .withColumn(col, F.coalesce(F.col("_dup"), F.lit(False)))
              .drop("_dup", *[f"_k_{k}" for k in keys]))


def dedup_with_quarantine(df: DataFrame, keys=DUPLICATE_KEY) -> tuple[DataFrame, DataFrame]:
    """(kept rows, audit rows) as the documented Silver step does."""
    return keep_first(df, keys), quarantine(df, keys)
