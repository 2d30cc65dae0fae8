"""Tables kept as runs: a batch adds a run, reading merges, compaction follows later.

A table is a folder ``bucket=<b>/run=<r>/`` of Parquet files. A row's bucket comes from its key
(a hash, or a column such as the service month), so all rows of a key stand in one bucket.
``append`` writes a batch, already merged by key, as a new run in the buckets it touches; no earlier
file is read or written. ``read`` returns one row per key: buckets of a single run are read as
they are, without a shuffle, the others are merged by key. ``compact`` writes the merged rows
of buckets with many runs as one run and then deletes the runs it read, so a reader
always finds every row, a failure in between only leaves rows that merge to the same, and
the work of a batch is in proportion to the batch.

Tables of wide rows of which few stand in several runs (``sparse``) merge in two steps: the hashes of
the keys that stand more than once are found from the key columns alone, and only the rows of these are
gathered by key; the others are taken as they stand. A batch is then written aside first, files in which a
key of it repeats are written again merged, and all are moved into place. A load, which is large and comes once, is
written by the tasks that have its rows, without a shuffle.

How rows of a key merge is the table's ``merge``, a list of aggregates that may be taken
again over their own results: a last value by sequence number, a sum, a minimum.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimlake.operators.dedup import with_bits
from claimlake.session import checkpoint_dir, give_up_shuffles
from claimlake.sources.readers import _folder, partition_folders, path_exists
from claimlake.streaming import file_index as X

BUCKETS = 64
#: Runs from which a bucket is compacted.
MOST_RUNS = 8
#: Hashes of keys up to which they are sent to every task (some 100 MB); of more, a table of bits is.
MOST_SENT = 4_000_000


def written_hashes(hashes: DataFrame) -> tuple[DataFrame, int]:
    """``hashes`` (column ``_h``), written to the shared folder, and their number."""
    spark, path = hashes.sparkSession, os.path.join(checkpoint_dir(hashes.sparkSession), f"hashes-{uuid.uuid4().hex}")
    hashes.write.parquet(path)
    hashes = spark.read.schema("_h long").parquet(path)
    return hashes, hashes.count()  # from the footers


def repeated_hashes(rows: DataFrame, h: Column) -> tuple[DataFrame, int]:
    """The hashes ``h`` that occur more than once in rows read from files, and their number."""
    return written_hashes(rows.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"))


def split(rows: DataFrame, h: Column, hashes: DataFrame, found: int, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash ``h`` is none of the ``found`` ``hashes``, the others); no row is moved. Of many
    hashes only bits are sent to the tasks, and some rows of other hashes are among the others."""
    if found <= (MOST_SENT if most is None else most):
        hashed = rows.withColumn("_h", h)
        return tuple(hashed.join(F.broadcast(hashes), "_h", how).select(*rows.columns) for how in ("left_anti", "left_semi"))
    marked = with_bits(rows, h, hashes, "_hit")
    return tuple(marked.where(which).select(*rows.columns) for which in (~F.col("_hit"), F.col("_hit")))


@dataclass
class Runs:
    """``key``: the columns a row is known by. ``merge``: column -> aggregate over the column's own
    values. ``bucket``: an expression of the key's bucket (a hash of the key if not given), the same at
    every use of the table. ``sparse``: rows are wide and few keys stand in several runs."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: list[str]
    merge: Callable[[], list[Column]]
    buckets: int = BUCKETS
    bucket: Column | None = None
    sparse: bool = False

    def _bucket(self) -> Column:
        known = self.bucket if self.bucket is not None else F.pmod(F.xxhash64(*self.key), F.lit(self.buckets))
        return known.cast("string")

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row per key; both steps of the aggregation combine before the shuffle, whatever a key's share."""
        return rows.groupBy(*self.key).agg(*self.merge()).select(*self.schema.names)

    def _gathered(self, rows: DataFrame) -> DataFrame:
        """``merged`` for rows read from files: of a sparse table only the rows of repeated keys meet."""
        if not self.sparse:
            return self.merged(rows)
        rows, h = rows.select(*self.schema.names), F.xxhash64(*self.key)
        repeated, found = repeated_hashes(rows, h)
        if not found:
            return rows
        alone, several = split(rows, h, repeated, found)
        return alone.unionByName(self.merged(several))

    def _write(self, rows: DataFrame, run: str | Column, path: str, cluster: bool = True, mode: str = "overwrite") -> None:
        out = rows.withColumns({"bucket": self._bucket(), "run": F.lit(run) if isinstance(run, str) else run})
        out = out.hint("rebalance", "bucket") if cluster else out
        out.write.mode(mode).options(partitionOverwriteMode="dynamic", compression="zstd").partitionBy("bucket", "run").parquet(path)
        give_up_shuffles(self.spark)

    def append(self, rows: DataFrame, run: str | None = None, cluster: bool = True) -> str:
        """Adds ``rows``, merged by key, as a run. A run of the same name is replaced in the
        buckets that both hold, so a batch sent again under its name changes nothing. ``cluster=False``: rows
        are not dealt out by bucket first; each task writes a file per bucket."""
        run = run or uuid.uuid4().hex
        if self.sparse:
            self._append_aside(rows, run, cluster)
        else:
            self._write(self.merged(rows), run, self.path, cluster)
        return run

    def _append_aside(self, rows: DataFrame, run: str, cluster: bool) -> None:
        """The rows are written once, as they come; files that hold a repeated key are then written again, merged."""
        staged = os.path.join(self.path, "_new", uuid.uuid4().hex)  # hidden from readers of the table
        self._write(rows.select(*self.schema.names), run, staged, cluster)
        if X.present(self.spark, staged):
            self._merge_files(staged, run)
            for b, folder in partition_folders(self.spark, staged, "bucket").items():
                fs, source = _folder(self.spark, os.path.join(folder, f"run={run}"))
                _, target = _folder(self.spark, os.path.join(self.path, f"bucket={b}", f"run={run}"))
                fs.delete(target, True)
                fs.mkdirs(target.getParent())
                if not fs.rename(source, target):
                    raise OSError(f"{source} was not moved to {target}")
        fs, p = _folder(self.spark, staged)
        fs.delete(p, True)

    def _merge_files(self, staged: str, run: str) -> None:
        h = F.xxhash64(*self.key)
        repeated, found = repeated_hashes(self.spark.read.schema(self.schema).parquet(staged), h)
        if not found:
            return
        held = self.spark.read.schema(self.schema).parquet(staged).select(*self.schema.names, X.file_name().alias("_file"))
        files = [r[0] for r in split(held, h, repeated, found)[1].select("_file").distinct().collect()]  # one name a file
        alone, several = split(X.read_files(self.spark, staged, files, self.schema).select(*self.schema.names), h, repeated, found)
        self._write(alone, run, staged, cluster=False, mode="append")  # files of a bucket each
        self._write(self.merged(several), run, staged, mode="append")
        X._delete(self.spark, staged, files)

    def layout(self) -> dict[str, list[str]]:
        """bucket -> names of its runs, from the folders; no file is opened."""
        if not path_exists(self.spark, self.path):
            return {}
        found = {b: list(partition_folders(self.spark, folder, "run")) for b, folder in partition_folders(self.spark, self.path, "bucket").items()}
        return {b: runs for b, runs in found.items() if runs}

    def _rows(self, buckets: list[str], runs: dict[str, list[str]]) -> DataFrame:
        folders = [os.path.join(self.path, f"bucket={b}", f"run={r}") for b in buckets for r in runs[b]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # without a base path the two folder levels are no columns
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, buckets: list[str] | None = None, without: str | None = None) -> DataFrame:
        """One row per key. ``buckets``: only these; ``without``: leave a run out."""
        runs = {b: [r for r in rs if r != without] for b, rs in self.layout().items() if buckets is None or b in buckets}
        single = [b for b, rs in runs.items() if len(rs) == 1]
        several = [b for b, rs in runs.items() if len(rs) > 1]
        parts = [self._rows(single, runs)] if single or not several else []
        if several:
            parts.append(self._gathered(self._rows(several, runs)))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def touched(self, rows: DataFrame) -> list[str]:
        """The buckets of ``rows``: at most as many values as the table has buckets."""
        return [r[0] for r in rows.select(self._bucket()).distinct().collect()]

    def compact(self, most: int = MOST_RUNS, before: str | None = None) -> list[str]:
        """Buckets of more than ``most`` runs become one run each; returns these buckets.
        ``before``: only runs whose name sorts before it."""
        runs = {b: sorted(r for r in rs if before is None or r < before) for b, rs in self.layout().items()}
        full = [b for b, rs in runs.items() if len(rs) > most]
        if not full:
            return []
        # sorts where its last run did, so "before" keeps its meaning
        name = F.create_map(*[x for b in full for x in (F.lit(b), F.lit(f"{runs[b][-1]}-{uuid.uuid4().hex[:8]}"))])
        self._write(self._gathered(self._rows(full, runs)), name[self._bucket()], self.path)
        for b in full:
            for r in runs[b]:
                fs, p = _folder(self.spark, os.path.join(self.path, f"bucket={b}", f"run={r}"))
                fs.delete(p, True)
        return full


def last_by(order: Column, columns: list[str]) -> list[Column]:
    """The columns of the row that comes last in ``order``; of equal ones the row of the largest
    content, so that the result does not hang on the order of arrival."""
    row = F.struct(*columns)
    return [F.max_by(row, F.struct(order, F.to_json(row))).getField(c).alias(c) for c in columns]
