"""Sources: raw ingest as text, Parquet layers, latest run, one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from claimlake.operators.cleaning import normalize_columns


def ingest_raw(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None,
               **options) -> DataFrame:
    """Read a raw claim table with every column as text.

    CSV is read without type inference, JSON with primitives as strings and
    Parquet is cast to string, so no value is coerced before Silver."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.options(header=True, inferSchema=False, **options).csv(path)
    elif fmt == "json":
        df = reader.options(primitivesAsString=True, **options).json(path)
    elif fmt == "parquet":
        df = reader.options(**options).parquet(path)
    else:
        df = reader.format(fmt).options(**options).load(path)
    df = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return normalize_columns(df)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet layer, optionally with a declared schema
    (columns resolved by name; missing ones read as NULL)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_run(spark: SparkSession, path: str, run_date: str, col: str = "run_date") -> DataFrame:
    """One batch partition (a partition filter: only its files are listed)."""
    # compared as text: partition inference may read 20240101 back as a number
    return spark.read.parquet(path).where(F.col(col).cast("string") == F.lit(str(run_date))).drop(col)


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, by the path's own scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other fault (rights, network) is raised."""
    fs, p = _folder(spark, path)
    return fs.exists(p)


def partition_folders(spark: SparkSession, path: str, col: str) -> dict[str, str]:
    """value -> folder of the partitions ``col=value`` right under ``path``, as escaped
    in the folder's name; no file is opened."""
    fs, p = _folder(spark, path)
    names = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    return {n.getName().partition("=")[2]: n.toString() for n in names if n.getName().startswith(f"{col}=")}


def latest_run(spark: SparkSession, path: str, col: str = "run_date") -> str | None:
    """Newest partition value of a run-partitioned layer, from the folder names."""
    return max(partition_folders(spark, path, col), default=None)


def read_latest(spark: SparkSession, path: str, col: str = "run_date",
                schema: T.StructType | None = None) -> DataFrame:
    """S3: the newest run of a layer, or an empty DataFrame with ``schema`` if the folder
    does not exist or holds no run. Any other fault is raised.

    The newest run is a partition value, so the read is pruned to that
    partition instead of filtering every file."""
    run = latest_run(spark, path, col) if path_exists(spark, path) else None
    if run is None:
        if schema is None:
            raise FileNotFoundError(f"no runs under {path}")
        return spark.createDataFrame([], schema)
    return read_run(spark, path, run, col)


def newest_file_rows(df: DataFrame) -> DataFrame:
    """S3 (file form): rows of the most recently modified file of an
    unpartitioned folder, via the hidden ``_metadata`` column."""
    mtime = F.col("_metadata.file_modification_time")
    newest = df.select(F.max(mtime)).scalar()
    return df.where(mtime == newest)
