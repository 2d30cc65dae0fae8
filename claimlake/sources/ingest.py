"""Raw ingest that keeps a trace of what could not be read.

``ingest_checked`` parses CSV or JSON text once, all columns as text, and routes every record: readable ones
to Bronze, the others, as they stand in the file, with file and reason to a sink. Nothing is
turned into NULL columns in silence, and both routes together hold every record.

Deliveries may differ in their columns: CSV files are read by their own headers (files of one header
together) and JSON by the names that occur; columns are then merged by name, and one that only
later files have is NULL in the earlier ones.
"""

from __future__ import annotations

import csv
import os
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimlake.operators.cleaning import normalize_columns
from claimlake.session import checkpoint_dir
from claimlake.sources import writers as W
from claimlake.sources.readers import _folder, path_exists

RECORD = "_unread"
_BAD = T.StructType([T.StructField("file", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("record", T.StringType())])


@dataclass
class Ingest:
    """``rows``: the readable records (text columns); ``unread``: file, reason and record of the others;
    ``staged``: the folder that holds both, by route."""

    rows: DataFrame
    unread: DataFrame
    staged: str


def _first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    fs, p = _folder(spark, path)
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, encoding))
        return (reader.readLine() or "").lstrip("﻿")
    finally:
        stream.close()


def _headers(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """header -> files; one line of each file is read."""
    found: dict[tuple[str, ...], list[str]] = {}
    for f in map(unquote, spark.read.schema("value string").text(path).inputFiles()):
        names = tuple(next(csv.reader([_first_line(spark, f)], delimiter=sep), []))
        if names:
            found.setdefault(names, []).append(f)
    return found


def _text_schema(names: list[str] | tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, RECORD]])


def _csv_reason(width: int, sep: str) -> Column:
    fields = F.size(F.split(RECORD, "\\" + sep))
    return F.when(fields < width, F.lit("fewer fields than columns")).when(fields > width, F.lit("more fields than columns")).otherwise(F.lit("unreadable"))


def _parsed(df: DataFrame, reason: Column) -> DataFrame:
    """All columns as text, and file and reason of a record that was not read."""
    names = [c for c in df.columns if c != RECORD]
    bad = F.col(RECORD).isNotNull()
    out = df.select("*", F.col("_metadata.file_path").alias("_file"))
    return out.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names], RECORD, F.when(bad, F.col("_file")).alias("_file"), F.when(bad, reason).alias("_reason"))


def ingest_checked(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None, sep: str = ",", header: bool = True,
                   **options) -> Ingest:
    """Reads ``path`` once into the shared folder, by route. ``schema``: the columns of files without a
    header, or of JSON whose other columns are not wanted."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, **options}
    if fmt == "csv":
        groups = _headers(spark, path, sep) if header else {tuple(schema.names): [path]}
        parts = [_parsed(spark.read.schema(_text_schema(names)).options(header=header, sep=sep, enforceSchema=True, **options).csv(files), _csv_reason(len(names), sep))
                 for names, files in groups.items()]
    elif fmt == "json":
        names = schema.names if schema is not None else [c for c in spark.read.options(primitivesAsString=True, **options).json(path).columns if c != RECORD]
        parts = [_parsed(spark.read.schema(_text_schema(names)).options(primitivesAsString=True, **options).json(path), F.lit("no JSON object"))]
    else:
        raise ValueError(f"no checked ingest for {fmt!r}")
    if not parts:
        parts = [spark.createDataFrame([], T.StructType([*(schema.fields if schema is not None else []), *[T.StructField(c, T.StringType()) for c in (RECORD, "_file", "_reason")]]))]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    staged = os.path.join(checkpoint_dir(spark), f"ingest-{uuid.uuid4().hex}")
    route = F.when(F.col(RECORD).isNull(), F.lit("rows")).otherwise(F.lit("unread"))
    whole.withColumn("_route", route).write.partitionBy("_route").parquet(staged)
    held = spark.read.schema(T.StructType([*whole.schema.fields, T.StructField("_route", T.StringType())])).parquet(staged)
    rows = held.where(F.col("_route") == "rows").drop(RECORD, "_file", "_reason", "_route")
    unread = held.where(F.col("_route") == "unread").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col(RECORD).alias("record"))
    return Ingest(normalize_columns(rows), unread, staged)


def write_unread(unread: DataFrame, path: str, run_date: str) -> str:
    """S15 for records that were not read: the audit folder, by batch."""
    return W.write_bronze(unread.select(*_BAD.names), path, run_date)


def ingest_batch(spark: SparkSession, path: str, bronze: str, audit: str, run_date: str, fmt: str = "csv", **options) -> Ingest:
    """A delivery into Bronze and the audit folder, under one batch id. The staged copy goes
    when both are written; what is returned is read from them."""
    found = ingest_checked(spark, path, fmt, **options)
    W.write_bronze(found.rows, bronze, run_date)
    write_unread(found.unread, audit, run_date)

    def written(df: DataFrame, route: str, folder: str) -> DataFrame:
        # a route without records left no folder, and an earlier batch of that id is not this one's
        if not path_exists(spark, os.path.join(found.staged, f"_route={route}")):
            return spark.createDataFrame([], df.schema)
        return spark.read.schema(df.schema).parquet(os.path.join(folder, f"run_date={run_date}"))

    rows, unread = written(found.rows, "rows", bronze), written(found.unread, "unread", audit)
    fs, p = _folder(spark, found.staged)
    fs.delete(p, True)
    return Ingest(rows, unread, found.staged)
