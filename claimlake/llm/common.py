"""Helpers shared by the corpus operators: tables, staged results, byte views
of Arrow columns and word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that one numpy pass handles; the passes hold about 60 bytes per byte.
PASS_BYTES = 1 << 19

#: Rows of an Arrow batch in staged jobs.
BATCH_ROWS = 1024

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder in ``spark.checkpoint.dir``. Where that is unset, a temporary
    folder serves a local master (tests); any other master is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of BATCH_ROWS rows for the jobs run meanwhile: rows hold whole texts,
    and a batch is held several times over on its way to Python and back. The
    session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def keep_batches_small(spark: SparkSession) -> None:
    """As ``small_batches``, for what the session runs from here on: a lazy result is
    computed by whoever writes it, when ``small_batches`` has ended. A smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_up_shuffles(spark: SparkSession) -> None:
    """Spark removes the shuffle files of finished jobs once the driver's JVM collects
    their handles; asking for that after a step keeps disks at one step's shuffles."""
    spark.sparkContext._jvm.System.gc()


def stage(spark: SparkSession, df: DataFrame, label: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and a
    lost executor costs no recomputation. The shuffle files of what led there are not
    needed any more. ``paths`` notes the folder, for ``discard``."""
    path = shared_path(spark, label)
    if paths is not None:
        paths.append(path)
    with small_batches(spark):
        df.write.parquet(path)
    give_up_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing reads any more: call it when what was made of
    them is itself staged. Empties the list."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(settings).delete(path, True)


def tidy(job):
    """A mapInArrow function that hands its freed memory back to the system when a task
    ends: Python workers live on between tasks, side by side with the JVM."""

    def run(batches):
        try:
            yield from job(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches cut to ``rows`` rows, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string or binary Arrow array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def passes(offsets: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (multiply and xor-shift)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(29))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base & _MASK))
    out[0] = _U(1)
    return np.cumprod(out, dtype=np.uint64)


class ByteHash:
    """Polynomial hashes modulo 2^64 of any byte range, over random byte values."""

    def __init__(self, n: int = PASS_BYTES + 1, seed: int = 7):
        self.values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
        self.up = _powers(_MULT, n)
        self.down = _powers(pow(_MULT, -1, 1 << 64), n)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self.up):
            self.__init__(2 * len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.down[starts])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_hash: ByteHash | None = None


def byte_hash() -> ByteHash:
    global _hash
    if _hash is None:
        _hash = ByteHash()
    return _hash


def _words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = _LOWER[data]
    inside = ~gap[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] |= inside[heads]
    last[tails] |= inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    h = byte_hash()
    return h.ranges(h.sums(data), starts, ends), starts, ends


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, rows' offsets into them) of the words between bytes of
    ``gap`` (white space x20, x09 to x0D if not given), with A-Z lower-cased for the
    hash. A long row is cut at gaps, so that memory stays bounded by its longest word
    and some bytes per word."""
    found, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in passes(offsets):
        base = int(offsets[i])
        part, at = data[base : offsets[j]], offsets[i : j + 1] - base
        if len(part) <= PASS_BYTES:
            h, starts, ends = _words(part, at, gap)
            found.append((h, starts + base, ends + base))
            counts[i:j] = np.diff(np.searchsorted(starts, at))
            continue
        begin = 0
        while begin < len(part):
            stop = min(begin + PASS_BYTES, len(part))
            while stop < len(part):
                gaps = np.flatnonzero(gap[part[begin:stop]])
                if len(gaps):
                    stop = begin + int(gaps[-1]) + 1
                    break
                stop = min(stop + PASS_BYTES, len(part))
            h, starts, ends = _words(part[begin:stop], np.array([0, stop - begin]), gap)
            found.append((h, starts + (base + begin), ends + (base + begin)))
            counts[i] += len(h)
            begin = stop
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=at[1:])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), at
    h, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
    return h, starts, ends, at


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each row, and the rows' offsets."""
    h, _, _, at = word_spans(data, offsets)
    return h, at


_COEFFICIENTS = mix(np.arange(1, 65, dtype=np.uint64)) | _U(1)


def shingle_positions(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row, the hashes of its k-word shingles in order, and its word hashes.
    Fewer words make one shingle, none an empty list."""
    for i, j in passes(offsets):
        words, at = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        n = len(words)
        whole = np.zeros(0, np.uint64)
        if n >= k:
            total = np.zeros(n - k + 1, np.uint64)
            for d in range(k):
                total += words[d : n - k + 1 + d] * _COEFFICIENTS[d]
            whole = mix(total + _U(k))
        for r in range(j - i):
            a, b = int(at[r]), int(at[r + 1])
            if b - a >= k:
                yield whole[a : b - k + 1], words[a:b]
            elif b > a:
                yield mix((words[a:b] * _COEFFICIENTS[: b - a]).sum(dtype=np.uint64, keepdims=True) + _U(b - a)), words[a:b]
            else:
                yield np.zeros(0, np.uint64), words[a:b]


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct hashes of its k-word shingles."""
    for s, _ in shingle_positions(data, offsets, k):
        yield np.unique(s)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


#: Bits of an id filter (see ``id_filter``); a fixed size, whatever the input.
FILTER_BITS = 25


def slot(column: str) -> Column:
    """The bit of an id in the filter."""
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))


def id_filter(ids: DataFrame, column: str | Column) -> bytes:
    """A bit table of fixed size (4 MB) with a bit set for the hash of every id. It only
    spares shuffling rows that have no partner; an exact join follows it. column: the id,
    or an expression of its bit."""
    slots = ids.select((slot(column) if isinstance(column, str) else column).alias("s")).select((F.col("s") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(pmod(s, 64) AS int))").alias("bit"))
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in slots.groupBy("w").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        bits[r["w"]] = r["bits"]
    return bits.tobytes()


def in_filter(held: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (held[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def maybe_in(rows: DataFrame, column: str, packed: bytes, inside: bool = True) -> DataFrame:
    """Rows whose id may be in the filter; with ``inside`` false those that are not in it."""

    def run(batches):
        held = np.frombuffer(packed, np.uint8)
        for batch in parts(batches):
            n = batch.num_columns - 1
            yield batch.filter(pa.array(in_filter(held, batch.column(n).to_numpy()) == inside)).select(list(range(n)))

    return rows.withColumn("__slot", slot(column)).mapInArrow(tidy(run), rows.schema)
