"""A register of keys seen so far: uniqueness over batches (D9, D11) and late deliveries.

The register keeps, for every key, how many rows had it and the batch that brought it first, as
runs in hash buckets of the key (``streaming.runs``). A batch counts its own keys, adds
them as a run and reads the buckets of its keys only; rows of earlier batches are
never read again. A batch sent again under its name replaces its run.

State of a stream is not used, so memory does not grow with the keys or with the delay that a
delivery may have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.session import give_up_shuffles
from claimlake.streaming.runs import BUCKETS, MOST_RUNS, MOST_SENT, Runs, repeated_hashes, split

KEY, ROWS, FIRST = "_key", "_rows", "_first"
_SCHEMA = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(ROWS, T.LongType()), T.StructField(FIRST, T.StringType())])


def batch_name(number: int) -> str:
    """A name that sorts as the number does."""
    return f"{number:020d}"


class KeyRegister:
    """Keys as text; a null key counts as a value, as it does for the uniqueness rule."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        merge = lambda: [F.sum(ROWS).alias(ROWS), F.min(FIRST).alias(FIRST)]
        self.spark, self.runs = spark, Runs(spark, path, _SCHEMA, [KEY], merge, buckets)

    def _counted(self, rows: DataFrame, key: str, batch: str) -> DataFrame:
        return rows.groupBy(F.col(key).cast("string").alias(KEY)).agg(F.count(F.lit(1)).alias(ROWS)).withColumn(FIRST, F.lit(batch))

    def add(self, rows: DataFrame, key: str, batch: str, most: int = MOST_RUNS) -> None:
        """Takes in a batch. Batches are named in the order they come; runs of earlier batches
        only are compacted, as a batch may still be sent again until the next one comes."""
        self.runs.append(self._counted(rows, key, batch), batch, cluster=False)  # counted keys come in few tasks
        self.runs.compact(most, before=batch)

    def known(self, rows: DataFrame, key: str, batch: str) -> DataFrame:
        """The register's keys of earlier batches in the buckets of ``rows``."""
        buckets = self.runs.touched(rows.select(F.col(key).cast("string").alias(KEY)))
        return self.runs.read(buckets, without=batch).where(F.col(FIRST) < batch)

    def report(self) -> DataFrame:
        """(is_unique, duplicate_count) over all batches: rows beyond the first of a key. Buckets
        of one run are added up where they stand; only keys are read."""
        more = F.coalesce(F.sum(F.col(ROWS) - 1), F.lit(0))
        return self.runs.read().agg((more == 0).alias("is_unique"), more.alias("duplicate_count"))

    def new_duplicates(self, rows: DataFrame, key: str, batch: str) -> DataFrame:
        """Keys of ``rows`` that repeat in the batch or stand in an earlier one: (key, rows in
        the batch, rows before)."""
        own = self._counted(rows, key, batch).select(KEY, F.col(ROWS).alias("batch_rows"))
        before = self.known(rows, key, batch).select(F.col(KEY).alias("_known"), F.col(ROWS).alias("_before"))
        joined = own.join(before, F.col(KEY).eqNullSafe(F.col("_known")), "left")
        counts = joined.select(F.col(KEY).alias("key"), "batch_rows", F.coalesce("_before", F.lit(0)).alias("earlier_rows"))
        return counts.where((F.col("batch_rows") > 1) | (F.col("earlier_rows") > 0))

    def first_deliveries(self, rows: DataFrame, key: str, batch: str) -> DataFrame:
        """Rows whose key no earlier batch held, one per key (the one whose columns, as text one
        after the other, come first); rows without a key are no deliveries of one another and
        all stay. As a rule few keys repeat within a batch: hashes of the keys tell which, and only
        their rows are gathered by key."""
        keyed = rows.where(F.col(key).isNotNull())
        row = F.struct(*rows.columns)
        content = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
        name = F.col(key).cast("string").alias(KEY)
        repeated, found = repeated_hashes(keyed, F.xxhash64(F.col(key).cast("string")))
        one = keyed.select(name, row.alias("_row"))
        if found:
            alone, several = split(keyed, F.xxhash64(F.col(key).cast("string")), repeated, found, MOST_SENT)
            several = several.select(name, row.alias("_row"), content.alias("_content"))
            one = alone.select(name, row.alias("_row")).unionByName(several.groupBy(KEY).agg(F.min_by("_row", "_content").alias("_row")))
        if any(r != batch for runs in self.runs.layout().values() for r in runs):  # else nothing is known, and no row need be moved to find it
            known = self.known(rows, key, batch).where(F.col(KEY).isNotNull()).select(F.col(KEY).alias("_known"))
            one = one.join(known, F.col(KEY) == F.col("_known"), "left_anti")
        new = one.select("_row.*")
        return new.unionByName(rows.where(F.col(key).isNull()))


def silver_once(spark: SparkSession, bronze_dir: str, silver_dir: str, register_dir: str, checkpoint: str, interval: str,
                available_now: bool = False, buckets: int = BUCKETS, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Streaming Silver in which a line counts once however late it is sent again.

    Each micro-batch keeps the lines whose id the register does not know from earlier batches,
    writes them under its own number (``batch=``; a batch run again replaces what it wrote), and then
    adds its ids to the register."""
    from claimlake.operators.cleaning import clean_claims
    from claimlake.schema import RAW_COLUMNS

    register = KeyRegister(spark, register_dir, buckets)
    reader = spark.readStream.schema(spark.read.parquet(bronze_dir).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    bronze = reader.parquet(bronze_dir)

    def take(batch: DataFrame, epoch: int) -> None:
        name = batch_name(epoch)
        fresh = register.first_deliveries(batch.select(*RAW_COLUMNS), "claim_item_id", name)
        silver = clean_claims(fresh, batch_id="stream").withColumn("batch", F.lit(name))
        silver.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd").partitionBy("batch").parquet(silver_dir)
        give_up_shuffles(spark)
        register.add(batch, "claim_item_id", name)

    w = bronze.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def read_silver(spark: SparkSession, silver_dir: str) -> DataFrame:
    return spark.read.parquet(silver_dir).drop("batch")
