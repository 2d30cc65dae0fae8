"""Silver of the pipeline: dealt out as text before cleaning, in passes, with the same rows."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from claimlake.operators.cleaning import clean_claims
from claimlake.plans.pipeline import run
from claimlake.session import checkpoint_dir
from claimlake.sources import writers as W
from claimlake.sources.fixture import raw_claims
from conftest import SF_SMALL

CLOCKS = ("_cleaned_at", "_ingested_at")


@pytest.mark.parametrize("passes", [1, 3])
def test_silver_is_that_of_one_cleaning(spark, monkeypatch, passes):
    seen, cluster = [], W.clustered
    monkeypatch.setattr(W, "clustered", lambda df, cols: seen.append(df.columns) or cluster(df, cols))
    raw, out = raw_claims(spark, SF_SMALL), os.path.join(checkpoint_dir(spark).removeprefix("file:"), f"sp-{uuid.uuid4().hex}")
    run(spark, raw.limit(10), out, batch_id="a")  # its months and lines go
    seen.clear()
    status = {r["table"]: (r["status"], r["rows"]) for r in run(spark, raw, out, batch_id="b", silver_passes=passes).collect()}
    assert len(seen) == passes and all("is_valid" not in columns and len(columns) == len(raw.columns) + 2 for columns in seen)
    want = clean_claims(raw, batch_id="b")
    assert status["silver"] == ("SUCCESS", want.count())
    columns = [c for c in want.columns if c not in CLOCKS]
    got = spark.read.schema(want.schema).parquet(out + "/silver").select(*columns)
    total = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    assert total(got) == total(want.select(*columns))
    for layer in ("bronze", "silver", "gold/fact_claims", "gold/dim_member"):
        files = glob.glob(f"{out}/{layer}/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)
