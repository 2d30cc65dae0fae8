"""A table that follows a change feed, whatever the order of delivery.

Every key keeps the sequence number of its last change, and a deleted key a tombstone, so an older
change that comes later is known to be older, and a change that comes twice changes nothing. The
table is kept as runs in hash buckets of the key (``streaming.runs``): a micro-batch adds files to
the buckets of its keys and rewrites none; now and then the buckets that gathered many runs
are compacted.

Tombstones are kept for good, as no bound on the lateness of a change is known; their number is
that of the deleted keys. Rows without a key are known by their whole content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.streaming.runs import BUCKETS, MOST_RUNS, Runs, last_by

SEQ, GONE, KEY = "_seq", "_gone", "_key"


class ChangeTable:
    """``schema``: the table's columns; ``key``: one of them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.schema, self.key = schema, key
        whole = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(SEQ, T.LongType()), T.StructField(GONE, T.BooleanType()), *schema.fields])
        columns = [SEQ, GONE, *schema.names]
        self.runs = Runs(spark, path, whole, [KEY], lambda: last_by(F.col(SEQ), columns), buckets, sparse=True)

    def _keyed(self, changes: DataFrame, seq: Column, gone: Column) -> DataFrame:
        content = F.sha2(F.to_json(F.struct(*sorted(self.schema.names))), 256)
        key = F.coalesce(F.concat(F.lit("k"), F.col(self.key).cast("string")), F.concat(F.lit("row"), content))
        return changes.select(key.alias(KEY), seq.cast("long").alias(SEQ), F.coalesce(gone, F.lit(False)).alias(GONE), *self.schema.names)

    def load(self, rows: DataFrame) -> None:
        """The state before the feed: older than any change."""
        self.runs.append(self._keyed(rows, F.lit(-(1 << 63)), F.lit(False)), cluster=False)

    def apply(self, changes: DataFrame, op: str = "op", seq: str = "seq", compact_from: int = MOST_RUNS) -> list[str]:
        """Takes in a batch of changes (``op`` "D" deletes). Returns the compacted buckets."""
        self.runs.append(self._keyed(changes, F.coalesce(F.col(seq), F.lit(-(1 << 63) + 1)), F.col(op) == "D"))
        return self.runs.compact(compact_from)

    def current(self) -> DataFrame:
        """The table after all changes so far."""
        return self.runs.read().where(~F.col(GONE)).select(*self.schema.names)


def follow(table: ChangeTable, feed: DataFrame, checkpoint: str, interval: str, op: str = "op", seq: str = "seq",
           available_now: bool = False, compact_from: int = MOST_RUNS) -> StreamingQuery:
    """A streaming feed of changes taken into the table."""
    w = feed.writeStream.foreachBatch(lambda batch, _epoch: table.apply(batch, op, seq, compact_from) and None).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
