"""Which files of a Parquet table hold a key: the 64-bit hash of every key, by file.

The index stands beside the data, in ``_index`` (hidden from readers of the table): ``named``
has a row per data file with the file's number (a hash of its name), ``held`` the file's number and key
hash of every row. Only new files are read to index them, without a shuffle: those on disk that ``named``
does not have, be it that the table had no index, that another job wrote them, or that a job ended
between writing and indexing. Entries of files that are gone are left out when looked up.

Looking up keys is one join of ``held`` with the hashes of the keys, so its work is in proportion to
the rows and the keys, whatever the number of files or partitions: a small batch is sent to the
index's tasks, a large one meets it in a shuffle of two numbers a row. No row of the table is read, but the
keys of files that seem to hold keys of the batch alone. A file is named in error only if two keys share their hash. Files are named by their path
under the table, as ``_metadata.file_path`` has it.
"""

from __future__ import annotations

import json
import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimlake.sources.readers import _folder, path_exists

_NAMED = T.StructType([T.StructField("file", T.StringType()), T.StructField("number", T.LongType())])
_HELD = T.StructType([T.StructField("number", T.LongType()), T.StructField("hash", T.LongType())])


def key_hash(key: str | Column) -> Column:
    return F.xxhash64(key)


def _second_hash(key: str | Column) -> Column:
    """Another one, which tells keys of one hash apart."""
    return F.xxhash64(F.lit("second"), key)


def file_name() -> Column:
    """A row's file: its path under the table (partition folders and name)."""
    # tried at the path's slashes only: a search from every letter takes longer than reading the row
    return F.regexp_extract(F.col("_metadata.file_path"), r"^.*?/((?:[^/=]+=[^/]*/)*[^/]+)$", 1)


def _relative(files: list[str], path: str) -> list[str]:
    mark = path.rstrip("/").split(":")[-1].lstrip("/") + "/"
    return [f.split(mark, 1)[1] for f in files]


def present(spark: SparkSession, path: str) -> list[str]:
    """The table's data files, from the folder listing."""
    # a schema of any kind spares reading a footer, and serves a folder without files
    return _relative(spark.read.schema("_ string").parquet(path).inputFiles(), path) if path_exists(spark, path) else []


def read_files(spark: SparkSession, path: str, files: list[str], schema: T.StructType) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    return spark.read.schema(schema).option("basePath", path).parquet(*[os.path.join(path, unquote(f)) for f in files])


def _delete(spark: SparkSession, path: str, files: list[str]) -> None:
    """Deletes data files, and partition folders that held nothing else."""
    folders = set()
    for f in files:
        fs, p = _folder(spark, os.path.join(path, unquote(f)))
        fs.delete(p, False)
        if "/" in f:
            folders.add(p.getParent().toString())
    for folder in folders:
        fs, p = _folder(spark, folder)
        if fs.exists(p) and not any(not s.getPath().getName().startswith((".", "_")) for s in fs.listStatus(p)):
            fs.delete(p, True)


def _intent(path: str) -> str:
    return os.path.join(path, "_index", "intent.json")


def finish(spark: SparkSession, path: str) -> None:
    """Carries out a swap that was noted and perhaps cut off: moves the new files that are not yet in
    place, then deletes the old ones. Every step may be taken twice."""
    if not path_exists(spark, _intent(path)):
        return
    swap = json.loads(spark.read.text(_intent(path), wholetext=True).first()[0])
    for f in swap["new"]:
        fs, source = _folder(spark, os.path.join(swap["staged"], unquote(f)))
        _, target = _folder(spark, os.path.join(path, unquote(f)))
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            fs.rename(source, target)
    _delete(spark, path, swap["old"])
    if swap["done"]:
        fs, p = _folder(spark, swap["done"])
        fs.create(p, True).close()
    fs, p = _folder(spark, swap.get("root", swap["staged"]))
    fs.delete(p, True)
    fs, p = _folder(spark, _intent(path))
    fs.delete(p, False)


def swap_files(spark: SparkSession, path: str, staged: str, old: list[str], done: str | None = None, root: str | None = None) -> None:
    """Puts the files written under ``staged`` (a folder in the table's ``_index``) in place of ``old``,
    then makes an empty file ``done`` and deletes ``root``, the folder that ``staged`` is part of. What is to be done is noted first, in one rename;
    ``finish`` does it, now or when the next merge finds the note."""
    note = json.dumps({"staged": staged, "new": present(spark, staged), "old": old, "done": done, "root": root or staged})
    fs, draft = _folder(spark, _intent(path) + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(note.encode()))
    out.close()
    fs.rename(draft, _folder(spark, _intent(path))[1])
    finish(spark, path)


class FileIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._named, self._held = os.path.join(path, "_index", "named"), os.path.join(path, "_index", "held")

    def files(self) -> DataFrame:
        if not path_exists(self.spark, self._named):
            return self.spark.createDataFrame([], _NAMED)
        return self.spark.read.schema(_NAMED).parquet(self._named)

    def update(self, keyed) -> list[str]:
        """Indexes the files that are not yet; ``keyed`` adds the key as text, ``_k``, to rows
        read from them. Returns all files present."""
        here = present(self.spark, self.path)
        if not here:
            return here
        known = {r["file"] for r in self.files().select("file").collect()}  # one name a file
        new = [f for f in here if f not in known]
        if new:
            rows = keyed(self.spark.read.option("basePath", self.path).parquet(*[os.path.join(self.path, unquote(f)) for f in new]).withColumn("_file", file_name()))
            rows.select(F.xxhash64("_file").alias("number"), key_hash("_k").alias("hash")).write.mode("append").parquet(self._held)
            names = self.spark.createDataFrame([(f,) for f in new], "file string").coalesce(1).withColumn("number", F.xxhash64("file"))
            names.write.mode("append").parquet(self._named)  # last: a file counts as indexed from here on
        return here

    def candidates(self, keys: DataFrame, here: list[str]) -> list[str]:
        """Files, of those ``here``, that hold one of ``keys`` (column ``_k``)."""
        return sorted(self._hits(keys, here))

    def _entries(self) -> DataFrame:
        return self.spark.read.schema(_HELD).parquet(self._held)

    def _hits(self, keys: DataFrame, here: list[str]) -> dict[str, tuple[int, int, int]]:
        """file -> (its number, how many of its rows have the hash of a key, the second hashes of these keys, summed bit by bit)."""
        known = keys.select(key_hash("_k").alias("hash"), _second_hash("_k").alias("_second"))
        hits = self._entries().join(known, "hash").groupBy("number").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("_second").alias("second"))
        found, live = {r["number"]: tuple(r) for r in hits.collect()}, set(here)  # one a file
        return {r["file"]: found[r["number"]] for r in self.files().collect() if r["number"] in found and r["file"] in live}

    def touched(self, keys: DataFrame, here: list[str], keyed) -> tuple[list[str], list[str]]:
        """(files that hold rows of ``keys`` alone, files that hold others too); ``keys`` has each key once.
        A file is of the first kind if as many hashes of keys meet it as it has rows, and the second hashes
        of these and of the file's own keys agree: the keys of such files are read, but not moved."""
        hits = self._hits(keys, here)
        rows = {r["number"]: r["count"] for r in self._entries().groupBy("number").count().collect()} if hits else {}
        full = [f for f, (number, met, _) in hits.items() if met == rows[number]]
        if full:
            own = keyed(self.spark.read.option("basePath", self.path).parquet(*[os.path.join(self.path, unquote(f)) for f in full]).withColumn("_file", file_name()))
            own = own.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(_second_hash("_k")).alias("second"))
            full = [r["_file"] for r in own.collect() if (r["rows"], r["second"]) == hits[r["_file"]][1:]]
        return sorted(full), sorted(set(hits) - set(full))

    def common(self, keys: DataFrame, files: list[str]) -> DataFrame:
        """Hashes (``_h``) of ``keys`` that stand in ``files``."""
        wanted = set(files)
        numbers = [r["number"] for r in self.files().collect() if r["file"] in wanted]
        held = self._entries().where(F.col("number").isin(numbers))
        return held.join(keys.select(key_hash("_k").alias("hash")), "hash", "left_semi").select(F.col("hash").alias("_h"))
