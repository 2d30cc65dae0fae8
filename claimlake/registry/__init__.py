"""Registered queries: name -> Spark builder and DuckDB oracle.

Each Spark builder takes ``(spark, sf_dir)``, derives claims from the driver
tables (``sources.fixture``) and returns the operator's DataFrame. Outputs
pass through ``compare_ready``: DECIMAL money becomes DOUBLE so both engines
report the same types (DuckDB hands decimals to clients as DOUBLE).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from claimlake.plans.pipeline import star_from_tables
from claimlake.session import scratch_path

SparkFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[SparkFn, str | None]] = {}


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: a job that reads its input several times
    does not derive it anew each time. Packed closely, as it goes to a shared disk and back."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compare_ready(df: DataFrame) -> DataFrame:
    """DECIMAL money -> DOUBLE, DECIMAL claim ids -> text, the rest unchanged."""
    def ready(f):
        if not isinstance(f.dataType, T.DecimalType):
            return F.col(f.name)
        return F.col(f.name).cast("string" if f.name in CLAIM_IDS else "double").alias(f.name)

    return df.select([ready(f) for f in df.schema.fields])


def register(name: str, oracle: str | None):
    def deco(fn: SparkFn) -> SparkFn:
        REGISTRY[name] = (lambda spark, sf_dir: compare_ready(fn(spark, sf_dir)), oracle)
        return fn
    return deco


def star_query(name: str, view_fn, oracle: str | None) -> None:
    """Register a function of the star built from the driver tables."""
    register(name, oracle)(lambda spark, sf_dir: view_fn(star_from_tables(spark, sf_dir)))


CLAIM_IDS = ("claim_item_id", "claim_id")


def select_typed(cte_name: str, spec: str) -> str:
    """``SELECT`` over a CTE with casts from a compact spec: ``name`` keeps the
    type, ``name:D`` -> DOUBLE, ``name:B`` -> BIGINT, ``name:I`` -> INT; claim ids -> text."""
    casts = {"D": "DOUBLE", "B": "BIGINT", "I": "INT", "V": "VARCHAR"}
    cols = []
    for item in [x.strip() for x in spec.split(",") if x.strip()]:
        name, _, t = item.partition(":")
        t = t or ("V" if name in CLAIM_IDS else "")
        cols.append(f"CAST({name} AS {casts[t]}) AS {name}" if t else name)
    return f"SELECT {', '.join(cols)} FROM {cte_name}"


def queries() -> dict[str, SparkFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


# register every group (import for side effects, after the helpers exist)
from claimlake.registry import gold, views, analysis, profiles, quality, streaming  # noqa: E402,F401
