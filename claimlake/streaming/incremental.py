"""Incremental loads without a table format.

``upsert`` merges new rows into a Parquet table by key and rewrites only the files that
hold one of the batch's keys, which a key-to-file index (``streaming.file_index``) names. The batch is
written once, as new files beside the table dealt out by partition; if keys repeat in it, files that hold one
are written again with its last row. Files of which the batch replaces every row are not read for the merge; the other rows of
the others are written as new files too, and only rows that may have a key of the batch are moved to find
out. The swap is noted before the new files are moved into place and the old ones
deleted, so a job that ends in between is finished by the next merge; a plain reader may see
rows twice for the length of these moves. A table has one writer at a time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimlake.session import give_up_shuffles
from claimlake.sources import writers as W
from claimlake.sources.readers import path_exists
from claimlake.streaming import file_index as X
from claimlake.streaming.runs import repeated_hashes, split, written_hashes


def select_new(existing: DataFrame, new: DataFrame, date_col: str = "received_date") -> DataFrame:
    """The literal incremental filter: rows newer than the table's newest date
    (a scalar subquery; late rows with older dates are left out)."""
    newest = existing.select(F.max(date_col)).scalar()
    return new.where(F.col(date_col) > newest)


def _merge_key(columns: list[str], key: str) -> Column:
    """The key as text; a row without one is known by its whole content, so that sending
    it again changes nothing and no two different rows are taken for one."""
    content = F.sha2(F.to_json(F.struct(*sorted(columns))), 256)
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("row"), content))


@dataclass
class Upsert:
    """What a merge did: files rewritten (by their paths under the table; none if the batch was
    merged before), and, if asked for, the changed rows: old images with ``_sign`` -1, new
    ones with +1."""

    path: str
    rewritten: list[str]
    changes: DataFrame | None = None


def merge_batch(spark: SparkSession, path: str, new: DataFrame, key: str = "claim_item_id",
                partition_col: str | None = "service_month", mode: str = "key", order_col: str | None = None,
                deleted: Column | None = None, helper_cols: tuple[str, ...] = (), images: str | None = None,
                image_of: Callable[[DataFrame], DataFrame] | None = None) -> Upsert:
    """Merge ``new`` into the Parquet table at ``path``.

    ``mode="key"``: insert-or-replace by key; re-running a batch changes nothing. Of
    several rows of a key the last by ``order_col`` counts (else the largest). Rows
    for which ``deleted`` holds remove their key. ``helper_cols`` of the batch (an
    operation, a sequence number) do not go into the table. ``mode="literal"``: only rows newer
    than the table's newest ``received_date`` are inserted, as the documented
    incremental model does. ``images``: a folder of this batch's own for the changed rows' old and new
    images; if the batch is sent again after it was merged, these are returned as they were. ``image_of``:
    what is kept of them, such as sums, if not the rows as they are.

    A partition that loses its last row is deleted. Columns that the table lacks are added, and
    read as NULL from files that are not rewritten."""
    X.finish(spark, path)
    columns = [c for c in new.columns if c not in helper_cols]
    schema = new.select(*columns).schema
    image_of = image_of or (lambda rows: rows)
    signed = T.StructType([*schema.fields, T.StructField("_sign", T.IntegerType())])
    kept = image_of(spark.createDataFrame([], signed)).schema if images else None
    if images and path_exists(spark, os.path.join(images, "merged")):
        return Upsert(path, [], spark.read.schema(kept).parquet(os.path.join(images, "rows")))
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    if mode == "literal" and path_exists(spark, path):
        # read with the incoming schema: a 'yyyy-MM' partition value must stay text
        new = select_new(spark.read.schema(schema).parquet(path), new)

    def keyed(df: DataFrame) -> DataFrame:
        missing = {c: F.lit(None).cast(schema[c].dataType) for c in columns if c not in df.columns}
        return df.withColumns(missing).withColumn("_k", _merge_key(columns, key))

    root = os.path.join(path, "_index", f"new-{uuid.uuid4().hex}")
    h, by = X.key_hash("_k"), [partition_col] if partition_col else []

    def write(rows: DataFrame, to: str, cluster: bool = True) -> None:
        out = W.clustered(rows, by) if cluster else rows
        (out.write.mode("append").options(compression="zstd", maxRecordsPerFile=W.MAX_RECORDS_PER_FILE)
            .partitionBy("_gone", *by).parquet(to))
        give_up_shuffles(spark)

    staged = os.path.join(root, "batch")
    order = [] if order_col is None else [F.col(order_col).alias("_order")]
    _write_last(write, keyed, new.select(*columns, *order, gone.alias("_gone")), staged, columns)
    incoming = keyed(spark.read.schema(T.StructType([*schema.fields, T.StructField("_gone", T.BooleanType())])).parquet(staged))
    keys, new_images = incoming.select("_k"), incoming.where(~F.col("_gone")).select(*columns)

    index = X.FileIndex(spark, path)
    read = lambda df: keyed(df.select("_file", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns]))
    here = index.update(read)
    replaced, mixed = index.touched(keys, here, read) if here else ([], [])
    old = [X.read_files(spark, path, replaced, schema).select(*columns)] if replaced else []
    stay = []
    if mixed:
        held = keyed(X.read_files(spark, path, mixed, schema))
        met, found = written_hashes(index.common(keys, mixed))
        (others, perhaps), own = split(held, h, met, found), split(keys, h, met, found)[1]
        old.append(perhaps.join(own, "_k", "left_semi").select(*columns))
        stay = [others.select(*columns), perhaps.join(own, "_k", "left_anti").select(*columns)]
    changes = None
    if images:
        both = new_images.withColumn("_sign", F.lit(1))
        for rows in old:
            both = both.unionByName(rows.withColumn("_sign", F.lit(-1)))
        W.write_table(image_of(both), os.path.join(images, "rows"))
        give_up_shuffles(spark)
        changes = spark.read.schema(kept).parquet(os.path.join(images, "rows"))
    if stay:
        stay = [rows.withColumn("_gone", F.lit(False)) for rows in stay]
        if held.count() + incoming.count() <= W.MAX_RECORDS_PER_FILE:  # from the footers: a small batch leaves no small files
            staged = os.path.join(root, "merged")
            write(stay[0].unionByName(stay[1]).unionByName(new_images.withColumn("_gone", F.lit(False))), staged)
        else:
            write(stay[0], staged, cluster=False)  # as read from files of a partition each
            write(stay[1], staged)
    X.swap_files(spark, path, os.path.join(staged, "_gone=false"), sorted([*replaced, *mixed]), done=images and os.path.join(images, "merged"), root=root)
    return Upsert(path, sorted([*replaced, *mixed]), changes)


def _write_last(write, keyed, rows: DataFrame, path: str, columns: list[str]) -> None:
    """Writes a batch, each key's last row alone (by ``_order``, if there, else the largest). Rows are written as
    they come; of keys that have several, the files that hold them are then written again."""
    write(rows, path)
    spark, h, order = rows.sparkSession, X.key_hash("_k"), [c for c in rows.columns if c not in (*columns, "_gone")]

    def read(files: list[str]) -> DataFrame:
        found = spark.read.schema(rows.schema).option("basePath", path).parquet(*[os.path.join(path, unquote(f)) for f in files])
        return keyed(found.withColumn("_file", X.file_name()))

    files = X.present(spark, path)
    if not files:
        return
    repeated, found = repeated_hashes(read(files), h)
    if not order and found:
        files = [r[0] for r in split(read(files), h, repeated, found)[1].select("_file").distinct().collect()]  # one name a file
    if not (order or found):
        return
    row = F.struct(*[F.col(c) for c in columns], "_gone")
    alone, several = split(read(files), h, repeated, found)
    last = several.groupBy("_k").agg(F.max(F.struct(*order, row.alias("_r"))).alias("_last"))
    write(alone.select(*columns, "_gone"), path, cluster=False)  # files of a partition each
    write(last.select("_last._r.*"), path)
    X._delete(spark, path, files)


def upsert(spark: SparkSession, path: str, new: DataFrame, key: str = "claim_item_id",
           partition_col: str | None = "service_month", mode: str = "key", order_col: str | None = None,
           deleted: Column | None = None, helper_cols: tuple[str, ...] = ()) -> str:
    """``merge_batch``, returning the table's path."""
    return merge_batch(spark, path, new, key, partition_col, mode, order_col, deleted, helper_cols).path


def latest_changes(changes: DataFrame, key: str, seq_col: str = "seq") -> DataFrame:
    """The last change per key (``max_by`` is a partial aggregate, so a
    key with many changes is combined map-side)."""
    cols = [c for c in changes.columns if c != key]
    last = F.max_by(F.struct(*cols), F.col(seq_col))
    return changes.groupBy(key).agg(last.alias("_c")).select(key, "_c.*")


def apply_changes(target: DataFrame, changes: DataFrame, key: str, seq_col: str = "seq",
                  op_col: str = "op") -> DataFrame:
    """Apply a change feed (op I/U/D, ordered by ``seq_col``) to a table:
    untouched target rows + the last non-delete image of every changed key."""
    last = latest_changes(changes, key, seq_col)
    keys = last.select(F.col(key).alias("_k"))
    untouched = target.join(keys, F.col(key) == F.col("_k"), "left_anti")
    images = last.where(F.col(op_col) != "D").select(*target.columns)
    return untouched.unionByName(images)
