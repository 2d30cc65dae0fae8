"""Whitening of embeddings with distributed block matrices (Spark MLlib).

Vectors become whole numbers x = floor(1024 c) + 100000, so that their number n and their
sums S per dimension are exact. The rows, centred by S / n, are numbered and
laid out as a block matrix X; X transposed times X is their scatter, of which every task makes
the share of a few blocks. Its d x d values come to the driver, which takes the
eigenvectors (``eigh``); d is the length of a vector and does not grow with the rows. X times
the whitening matrix (eigenvectors over the roots of their eigenvalues, for up to 8
components) projects the rows, again block by block.

Spark's multiplication sends all blocks that meet in one block of the product to one task.
As the scatter is one block, the shared dimension is split (``numMidDimSplits``, which the JVM
class offers and its Python wrapper leaves out), so that a task holds ``SPLIT_BLOCKS``
blocks. The driver holds the block numbers of X, one for ``BLOCK_ROWS`` rows.

Rows: a vector that is null, empty, or holds null, NaN or infinite entries takes no part, nor does
one with an entry of 2^40 or more, whose whole number is not safe. If lengths differ,
the vectors of the most frequent length (the longer one of two as frequent) take part.
Rows that repeat an id, or have none, are rows like others and are returned as often as they
stand there. Directions without variance (an eigenvalue of zero to double precision) are no
components; so an empty table, a single row or equal rows give no result. An exact deviation beyond
38 digits is null. Other columns than id and vector are left out, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from claimlake.llm.common import parts, stage, table, tidy

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
#: Rows of a block, and blocks that one task multiplies.
BLOCK_ROWS = 4096
SPLIT_BLOCKS = 16

_LARGEST = float(1 << 40)
_LONG = (1 << 63) - 1


@dataclass
class Fit:
    """n vectors of len(sums) dimensions with these sums; up to ``COMPONENTS`` eigenvectors (as
    columns) of their covariance with falling eigenvalues; the covariance's trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, dims and x (array of long) of the rows whose vector takes part."""
    kept = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            batch = batch.filter(batch.column(1).is_valid())
            sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            whole = np.abs(flat) < _LARGEST  # NaN, as which nulls come, compares false
            fine = (np.bincount(row[~whole], minlength=len(sizes)) == 0) & (sizes > 0)
            x = np.floor(np.where(whole, flat, 0) * SCALE).astype(np.int64) + SHIFT
            at = np.concatenate([[0], np.cumsum(sizes[fine])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(x[fine[row]]))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fine)), pa.array(sizes[fine].astype(np.int32)), lists], ["id", "dims", "x"])

    return kept.mapInArrow(tidy(run), f"id {kept.schema['id'].dataType.simpleString()}, dims int, x array<long>")


def numbered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows``, written once, with a number ``index`` from 0 on, by part and place in the part
    as written. Only one row per part is ordered."""
    placed = stage(spark, rows.withColumn("at", F.monotonically_increasing_id()), "vectors")
    part = F.shiftright("at", 33)
    lengths = placed.groupBy(part.alias("part")).agg(F.max(F.col("at").bitwiseAND((1 << 33) - 1)).alias("last"))
    before = F.sum(F.col("last") + 1).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = lengths.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    starts = stage(spark, starts, "starts")
    return placed.withColumn("part", part).join(starts, "part").withColumn("index", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "at", "start")


def _shape(x: DataFrame) -> int:
    first = x.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    return first["dims"] if first else 0


def _sums(x: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, object)
        for batch in parts(batches):
            rows = batch.column(0).flatten().to_numpy().reshape(-1, dims)
            n += len(rows)
            sums += rows.sum(0).astype(object)  # below 2^63: 1,024 rows of 2^51
        at = pa.array(range(-1, dims), pa.int32())
        yield pa.RecordBatch.from_arrays([at, pa.array([n, *sums.tolist()], pa.decimal128(38, 0))], ["dim", "total"])

    found = x.select("x").mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    totals = {r["dim"]: int(r["total"]) for r in found}
    return totals.get(-1, 0), [totals.get(i, 0) for i in range(dims)]


def centred(x: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """index, id, ``deviation`` (the exact sum of (n x - S)^2) and ``vector`` (x - S / n)."""
    dims = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows = batch.column(2).flatten().to_numpy().reshape(-1, dims)
            largest = int(np.abs(rows).max(initial=0))
            small = n * largest + max(map(abs, sums)) <= _LONG
            away = rows * n - np.array(sums, np.int64) if small else rows.astype(object) * n - np.array(sums, object)
            most = max((abs(int(v)) for v in (away.min(), away.max())), default=0) if away.size else 0
            squares = (away if most * most * dims <= _LONG else away.astype(object)) ** 2
            exact = [int(v) if abs(int(v)) < 10**38 else None for v in squares.sum(1)]
            values = (away / n).astype(np.float64).ravel()
            at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dims)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(exact, pa.decimal128(38, 0)), pa.ListArray.from_arrays(at, pa.array(values))], ["index", "id", "deviation", "vector"])

    return x.select("index", "id", "x").mapInArrow(tidy(run), f"index long, id {x.schema['id'].dataType.simpleString()}, deviation decimal(38,0), vector array<double>")


def block_matrix(rows: DataFrame, height: int, width: int) -> BlockMatrix:
    """Rows (index, vector) as a block matrix; indices that are not there are rows of zeros."""
    indexed = rows.select("index", array_to_vector("vector").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(indexed, "vector"), height, width).toBlockMatrix(BLOCK_ROWS, width)


def scatter(x: BlockMatrix) -> np.ndarray:
    """X transposed times X, the shared dimension split."""
    splits = max(1, -(-x.numRowBlocks // SPLIT_BLOCKS))
    product = x.transpose()._java_matrix_wrapper.call("multiply", x._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, x.colsPerBlock, x.colsPerBlock).toLocalMatrix().toArray()


def project(spark: SparkSession, x: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """index and ``whitened`` of X times a small matrix."""
    d, k = matrix.shape
    small = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, matrix.ravel(order="F").tolist()))], 1), x.colsPerBlock, k, d, k)
    blocks = x.multiply(small).blocks.map(lambda b: (b[0][0], np.ascontiguousarray(b[1].toArray()).tobytes()))
    frame = spark.createDataFrame(blocks, "block long, data binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            values = np.frombuffer(batch.column(1)[0].as_py(), np.float64)
            rows = len(values) // k
            index = batch.column(0)[0].as_py() * BLOCK_ROWS + np.arange(rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * k), pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array(index), lists], ["index", "whitened"])

    return frame.mapInArrow(tidy(run), "index long, whitened array<double>")


def whiten(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[Fit | None, DataFrame | None]:
    """The fit, and per row that takes part: index, id, deviation (decimal) and ``whitened``
    (array of double, one per component). (None, None) if there is no component."""
    x = whole_numbers(vectors, key, vector)
    x = numbered(spark, x)
    dims = _shape(x)
    if not dims:
        return None, None
    x = x.where(F.col("dims") == dims)
    n, sums = _sums(x, dims)
    height = x.agg(F.max("index")).first()[0] + 1
    rows = stage(spark, centred(x, n, sums), "centred")
    matrix = block_matrix(rows, height, dims)
    covariance = scatter(matrix) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    order = [i for i in np.argsort(values)[::-1][:COMPONENTS] if values[i] > dims * np.finfo(float).eps * max(values[-1], 0)]
    if not order:
        return None, None
    axes = axes[:, order]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), range(len(order))])
    fit = Fit(n, sums, values[order], axes, float(np.trace(covariance)))
    projected = project(spark, matrix, fit.matrix)
    return fit, stage(spark, rows.drop("vector").join(projected, "index"), "whitened")


def identity_error(rows: DataFrame, fit: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(fit.values)
    found = rows.agg(F.max("index").alias("last"), *[F.avg(F.col("whitened")[i]).alias(f"m{i}") for i in range(k)]).first()
    moved = F.array(*[F.col("whitened")[i] - F.lit(found[f"m{i}"]) for i in range(k)])
    matrix = block_matrix(rows.select("index", moved.alias("vector")), found["last"] + 1, k)
    return float(np.abs(scatter(matrix) / fit.n - np.eye(k)).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    fit, rows = whiten(spark, vectors)
    if fit is None:
        return spark.createDataFrame([], f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(rows, fit)
    shares = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    out = rows.select(F.col("id").alias("vec_id"), F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
