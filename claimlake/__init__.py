"""claimlake: a Spark-native medallion engine for medical-claims analytics.

Raw claim lines (all text) -> Silver (typed, parsed, flagged) -> Gold star
schema -> reporting views, analyst queries, marts and data-quality reports.
Every step is a pure ``DataFrame -> DataFrame`` function built from Spark
SQL built-ins, so Catalyst sees one plan from scan to sink.
"""

from claimlake.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
