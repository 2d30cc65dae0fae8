"""Structured Streaming for continuously arriving claims.

Two queries, each with its own checkpoint:

1. ``raw_to_bronze``: a file source of JSON claim records (every field
   text, explicit schema: no inference on a stream) appended to Bronze as
   Parquet partitioned by ``run_date``. The trigger is a 60-second
   processing-time trigger in production, ``availableNow`` in tests.
2. ``bronze_to_silver``: the same ``clean_claims`` as batch, applied to a
   streaming read of Bronze, with duplicate deliveries of a
   ``claim_item_id`` dropped: either inside a watermark on the ingest time (the
   dedup state holds only keys seen within the watermark delay), or, if the keys
   seen are kept in a register on the shared disk, however late they come and
   without a line being moved that is the only one of its key.

``json_payload`` parses a text payload column (e.g. a message value) into
the raw claim columns with ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.operators.cleaning import clean_claims
from claimlake.schema import RAW_COLUMNS, RAW_SCHEMA
from claimlake.session import give_up_shuffles
from claimlake.streaming.changes import ChangeTable, follow
from claimlake.streaming.register import KeyRegister, batch_name

BUFFER_INTERVAL = "60 seconds"   # stream buffer interval of the Bronze hop
SILVER_INTERVAL = "15 minutes"   # micro-batch interval of the Silver hop
DEDUP_WATERMARK = "1 hour"
READ_BYTES = "32m"               # of packed lines a task reads to write Silver


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def json_payload(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Text payload -> the 20 raw columns (T1 for message-style sources)."""
    parsed = F.from_json(F.col(value_col).cast("string"), RAW_SCHEMA)
    return df.select(parsed.alias("r")).select("r.*")


def read_claim_stream(spark: SparkSession, source_dir: str, fmt: str = "json",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of claim records with the raw (all-text) schema."""
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.format(fmt).load(source_dir)


def raw_to_bronze(spark: SparkSession, source_dir: str, bronze_dir: str, checkpoint: str,
                  available_now: bool = False, fmt: str = "json") -> StreamingQuery:
    """Buffered append of raw records to Bronze."""
    stream = (read_claim_stream(spark, source_dir, fmt)
              .withColumn("_ingested_at", F.current_timestamp())
              .withColumn("run_date", F.date_format(F.col("_ingested_at"), "yyyyMMdd")))
    w = (stream.writeStream.format("parquet").options(checkpointLocation=checkpoint, compression="zstd")
         .partitionBy("run_date").outputMode("append"))
    return _trigger(w, available_now, BUFFER_INTERVAL).start(bronze_dir)


def dedup_stream(df: DataFrame, keys, ts_col: str, watermark: str, register: KeyRegister | None = None,
                 batch: str | None = None) -> DataFrame:
    """Drop repeated deliveries of a key within ``watermark`` of ``ts_col``.
    State holds each key only until the watermark passes it, so memory is
    bounded by the keys seen within the delay, not by the stream's history.
    A ``timestamp_ntz`` event time is read as a session-zone timestamp
    (watermarks need TIMESTAMP).

    ``register``: ``df`` is the micro-batch named ``batch``, and the keys of earlier ones are those of the register (of
    one key column). Stream state moves every row to its key and keeps every key beside the others in memory or
    in a local database; the register moves hashes, and rows only of keys that repeat."""
    if register is not None:
        (key,) = keys
        return register.first_deliveries(df, key, batch)
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    df = df.withWatermark(ts_col, watermark)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # rows without a key are no deliveries of one another: all of them stay
    return df.where(known).dropDuplicatesWithinWatermark(list(keys)).unionByName(df.where(~known))


def silver_stream(bronze: DataFrame, profile: str = "lambda", watermark: str = DEDUP_WATERMARK,
                  score: bool = True, register: KeyRegister | None = None, batch: str | None = None) -> DataFrame:
    """Streaming Silver: keyed dedup within the watermark (or by ``register``), cleaning and
    (optionally) the per-record quality score of the Silver rules."""
    from claimlake.operators.quality import SILVER_RULES, score_records

    deduped = dedup_stream(bronze, ["claim_item_id"], "_ingested_at", watermark, register, batch)
    out = clean_claims(deduped.select(*RAW_COLUMNS, "_ingested_at"), profile=profile, batch_id="stream")
    return score_records(out, SILVER_RULES) if score else out


def bronze_to_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, checkpoint: str,
                     available_now: bool = False, register_dir: str | None = None, buckets: int = 8) -> StreamingQuery:
    """Micro-batch Silver from streaming Bronze, by year and month as batch Silver. ``register_dir``: keys seen
    are kept there instead of in the stream's state; each micro-batch then stands under its number
    (``batch=``), and one run again replaces what it wrote."""
    bronze_schema = spark.read.parquet(bronze_dir).schema
    bronze = spark.readStream.schema(bronze_schema).parquet(bronze_dir)
    if register_dir:
        register = KeyRegister(spark, register_dir, buckets)

        def take(rows: DataFrame, epoch: int) -> None:
            name = batch_name(epoch)
            # the stream's own session: cleaned lines are many times as wide as packed ones, and tasks sort theirs by month
            rows.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", READ_BYTES)
            lines = rows.select(*RAW_COLUMNS, "_ingested_at")
            out = silver_stream(lines, register=register, batch=name).withColumn("batch", F.lit(name))
            (out.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
                .partitionBy("batch", "year", "month").parquet(silver_dir))
            give_up_shuffles(spark)
            register.add(rows, "claim_item_id", name)

        w = bronze.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        return _trigger(w, available_now, SILVER_INTERVAL).start()
    out = silver_stream(bronze)
    w = (out.writeStream.format("parquet").options(checkpointLocation=checkpoint, compression="zstd")
         .partitionBy("year", "month").outputMode("append"))
    return _trigger(w, available_now, SILVER_INTERVAL).start(silver_dir)


def silver_to_fact(spark: SparkSession, silver_dir: str, fact_dir: str, checkpoint: str,
                   available_now: bool = False) -> StreamingQuery:
    """T3 -> T4: each Silver micro-batch becomes fact rows upserted by
    ``claim_item_id`` into the month-partitioned fact (``foreachBatch``;
    the upsert is idempotent, so a replayed batch changes nothing)."""
    from claimlake.operators.star import fact_claims
    from claimlake.streaming.incremental import upsert

    schema = spark.read.parquet(silver_dir).schema
    stream = spark.readStream.schema(schema).parquet(silver_dir)

    def merge(batch: DataFrame, _epoch: int) -> None:
        upsert(batch.sparkSession, fact_dir, fact_claims(batch).drop("_loaded_at"))

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, SILVER_INTERVAL).start()


def read_change_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of changed claims (JSON with ``op`` I/U/D and ``seq``)."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("op", T.StringType()), T.StructField("seq", T.LongType())])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(source_dir)


def change_feed(spark: SparkSession, source_dir: str, table: ChangeTable, checkpoint: str,
                available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """A feed of changed claims taken into a table of runs: the change of the highest
    ``seq`` of a key counts, in whatever order and however often changes arrive."""
    feed = read_change_stream(spark, source_dir, max_files_per_trigger)
    return follow(table, feed, checkpoint, SILVER_INTERVAL, available_now=available_now)


def run_available_now(spark: SparkSession, source_dir: str, work_dir: str) -> str:
    """Drive both hops to completion over what is available (tests, backfills).
    Returns the Silver folder."""
    import os
    bronze, silver = os.path.join(work_dir, "bronze"), os.path.join(work_dir, "silver")
    q1 = raw_to_bronze(spark, source_dir, bronze, os.path.join(work_dir, "_ckpt_bronze"), available_now=True)
    q1.awaitTermination()
    give_up_shuffles(spark)
    q2 = bronze_to_silver(spark, bronze, silver, os.path.join(work_dir, "_ckpt_silver"), available_now=True,
                          register_dir=os.path.join(work_dir, "register"))
    q2.awaitTermination()
    return silver
