"""Batches of a job: lines derived once, facts written from clustered Silver."""

from claimlake import registry
from claimlake.registry import streaming as J
from claimlake.sources import writers as W
from conftest import SF_SMALL


def test_batches_are_cut_from_written_lines(spark, monkeypatch):
    seen, clustered, run, cluster = [], [], J.run, W.clustered
    monkeypatch.setattr(J, "run", lambda s, raw, *a, **k: seen.append(raw._jdf.queryExecution().toString()) or run(s, raw, *a, **k))
    monkeypatch.setattr(W, "clustered", lambda df, cols: clustered.extend(cols) or cluster(df, cols))
    registry.queries()["pipeline_two_batches"](spark, SF_SMALL).collect()
    assert len(seen) == 3 and not any("l_orderkey" in p for p in seen)
    assert set(clustered) == {"year", "month"}  # Silver alone is dealt out by month
