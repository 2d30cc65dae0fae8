"""Benchmark decontamination: documents that hold a passage within a small edit
distance of a benchmark item.

Texts are compared as lower-cased words (a-z, 0-9 and all beyond ASCII) joined by single
spaces. The item's passage may stand anywhere in a document: the distance is that of the
item to the nearest substring in characters, and an item leaks where it is at most
``1 - similarity`` times the item's length (0.9: one edit in ten characters).

1. Item-sized windows. An item of n characters has the size class W, the largest power
   of two with 2 W - 1 <= n. Over every whole text windows of W characters begin at every
   W-th character, for each class that has items; of an item all windows that begin in
   its first W characters are kept. Wherever a passage stands, one window of the text
   begins at one of these.
2. CGK embedding. A window walks over its characters for W steps, and at every step a
   random bit, drawn for the step and the character under it, says whether to move on.
   Windows at a small edit distance soon walk in step again, so their outputs differ in
   few places. A walk may also stay out of step for long, so WALKS independent ones are
   taken.
3. Bit-sampling LSH. Each table reads SAMPLES places of a walk's output, half of the
   tables from its first half (16 steps at least). A window and an item that agree in any
   table meet; equal windows always do.
4. Few tables agree where edits are many, so items are also cut into one piece more than
   the edits allowed, of which a passage within that distance holds one unchanged beside
   half of its neighbour; text and item meet wherever these stand. This makes the recall
   1, for any item and any place of the edits; items under 2 * SIZES[0] - 1 characters
   rest on it alone.
5. Exact edit verification by dynamic programming over the passage with a margin on
   either side, of every pair that met but those whose passage holds fewer of the item's
   runs of GRAM characters than the edits allowed would leave.

One narrow pass: no shuffle, nothing gathered, whole texts of any length. The benchmark
goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one pass per block; a
Python worker builds a block's tables once.

Null and empty texts leak nothing; null or empty items, and those without a letter or
digit, match nothing. Items of one or two words are found like all others, inside longer
words as well. Equal items are reported each by its own id, repeated rows each by itself.
Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import parts, passes, table, text_views, tidy

SIMILARITY = 0.9
#: Independent walks, tables per walk and sampled places per table.
WALKS, TABLES, SAMPLES = 8, 4, 12
#: Window sizes; the smallest is the least that leaves a choice of places.
SIZES = tuple(1 << k for k in range(4, 31))
#: Benchmark text that a task holds at a time (its tables take some 500 bytes a byte).
BLOCK_BYTES = 1 << 18
#: Characters of a piece that are looked up, and those in line that passages are ruled out by.
PIECE, GRAM = 10, 4
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_PLAIN = bytes(32 if _GAP[b] else (b + 32 if 65 <= b < 91 else b) for b in range(256))


def normal(raw: bytes) -> bytes:
    return b" ".join(raw.translate(_PLAIN).split())


def _codes(text: str | bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8).astype(np.uint32) if isinstance(text, bytes) else np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _folded(codes: np.ndarray) -> np.ndarray:
    """Characters as bytes, which may coincide for rare ones: the walk's alphabet."""
    return (codes ^ (codes >> 8)).astype(np.uint8)


class Known:
    """Sorted keys behind a filter of some 16 slots a key, small enough to stay near the
    processor."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.shift = _U(64 - max(10, (16 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << int(_U(64) - self.shift), bool)
        self.slots[(keys * _BASE) >> self.shift] = True

    def equal(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the known key, place in ``keys``) of all that are equal."""
        i = np.flatnonzero(self.slots.take(((keys * _BASE) >> self.shift).view(np.int64)))
        lo = np.searchsorted(self.keys, keys[i], "left")
        met = self.keys.take(lo, mode="clip") == keys[i]  # most that pass the filter are not known
        i, lo = i[met], lo[met]
        n = np.searchsorted(self.keys, keys[i], "right") - lo
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.order[entry], np.repeat(i, n)


class Walk:
    """The random bits and sampled places of one window size."""

    def __init__(self, size: int, walk: int):
        rng = np.random.default_rng([size, walk])
        self.bits = rng.integers(0, 2, (size, 256))
        self.places = [np.sort(rng.choice(max(SIZES[0], size >> (r % 2)), SAMPLES, replace=False)) for r in range(TABLES)]

    def keys(self, letters: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """Each table's keys of the windows that begin at places of a text."""
        steps = int(max(p[-1] for p in self.places)) + 1
        sampled = {int(x) for p in self.places for x in p}
        at, read = at.copy(), {}
        for t in range(steps):
            c = letters.take(at)
            if t in sampled:
                read[t] = c.astype(np.uint64)
            at += self.bits[t].take(c)
        for places in self.places:
            key = read[int(places[0])].copy()
            for x in places[1:].tolist():
                key *= _BASE
                key += read[x]
            yield key


class Tables:
    """The LSH tables of the items of one window size."""

    def __init__(self, size: int, items: list[int], codes: list[np.ndarray]):
        self.size = size
        self.walks = [Walk(size, w) for w in range(WALKS)]
        letters = _folded(np.concatenate([codes[x] for x in items]))
        begin = np.concatenate([[0], np.cumsum([len(codes[x]) for x in items])[:-1]])
        at = (begin[:, None] + np.arange(size)).ravel()
        self.item, self.offset = np.repeat(np.array(items), size), np.tile(np.arange(size), len(items))
        self.known = [[Known(k) for k in w.keys(letters, at)] for w in self.walks]

    def met(self, letters: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(item, place of the window, place in the item) of those that agree in any table."""
        many = np.maximum(-(-(ends - begins) // self.size), 0)
        first = np.cumsum(many) - many
        at = np.repeat(begins - first * self.size, many) + np.arange(int(many.sum())) * self.size
        items, places, offsets = [], [], []
        for walk, tables in zip(self.walks, self.known, strict=True):
            for keys, known in zip(walk.keys(letters, at), tables, strict=True):
                entry, i = known.equal(keys)
                items.append(self.item[entry])
                places.append(at[i])
                offsets.append(self.offset[entry])
        return np.concatenate(items), np.concatenate(places), np.concatenate(offsets)


def _grams(codes: np.ndarray, most: int) -> np.ndarray:
    """Keys of the 1, 2, ... ``most`` characters from each place on, one row each."""
    n, wide = len(codes) - most + 1, codes.astype(np.uint64)
    out = np.empty((most, n), np.uint64)
    out[0] = wide[:n]
    for k in range(1, most):
        np.multiply(out[k - 1], _BASE, out=out[k])
        out[k] += wide[k : k + n]
    return out


class Pieces:
    """Items cut into one piece more than the edits allowed, and taken in pairs. Of a
    passage within that distance some pair holds at most one edit (a last one alone
    none): one piece stands unchanged, and of its neighbour the half beside it does, or
    the far half, moved by one character at most."""

    def __init__(self, texts: list[str], edits: list[int]):
        known: dict[int, list[tuple[int, ...]]] = {}  # by characters looked up
        self.reach = 2 * PIECE  # characters looked at on either side
        for x, (text, e) in enumerate(zip(texts, edits, strict=True)):
            edges = [k * len(text) // (e + 1) for k in range(e + 2)]
            codes = _codes(text)

            def key(a: int, b: int, codes=codes) -> tuple[int, int]:
                q = min(PIECE, b - a)
                return q, int(_grams(codes[a : a + q], q)[-1][0])

            for k in range(e + 1):
                a, b = edges[k], edges[k + 1]
                low, high = (edges[k - 1], a) if k % 2 else (b, edges[min(k + 2, e + 1)])
                half = (high - low) // 2
                beside, far = ((high - half, high), (low, high - half)) if k % 2 else ((low, low + half), (low + half, high))
                if b > a:
                    # no neighbour, or one too short to tell: nothing to see beside it
                    more = (*key(*beside), beside[0] - a, *key(*far), far[0] - a) if half else (0,) * 6
                    q, own = key(a, b)
                    known.setdefault(q, []).append((own, x, a, *more))
                    self.reach = max(self.reach, high - a + PIECE, a - low + PIECE)
        self.at = {}
        for q, own in known.items():
            keys, halves = (np.array([[o[k] for k in part] for o in own], np.uint64) for part in ((0,), (4, 7)))
            places = np.array([[o[k] for k in (1, 2, 3, 5, 6, 8)] for o in own], np.int64)
            self.at[q] = Known(keys[:, 0]), halves, places

    def met(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """(item, place of the piece, place in the item) wherever a piece's first
        characters stand beside its neighbour in a text of ``n`` characters."""
        out = []
        side = np.zeros(self.reach, np.uint32)
        codes = np.concatenate([side, codes[:n], side, side])
        for begin in range(0, n, 1 << 15):
            end = min(n, begin + (1 << 15))
            grams = _grams(codes[begin : end + 2 * self.reach + PIECE], PIECE)
            for q, (known, halves, places) in self.at.items():
                entry, i = known.equal(grams[q - 1, self.reach : self.reach + end - begin])
                item, offset, q1, at1, q2, at2 = places[entry].T
                at = i + self.reach
                ok = (q1 == 0) | (grams[q1 - 1, at + at1] == halves[entry, 0])
                for moved in (-1, 0, 1):
                    ok |= grams[q2 - 1, at + at2 + moved] == halves[entry, 1]
                out.append((item[ok], begin + i[ok], offset[ok]))
        return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))


class Shares:
    """Sets of the items' GRAM characters in line (by 12 bits of a hash). Every edit
    costs a passage at most GRAM of its item's, so one that holds fewer is ruled out."""

    def __init__(self, texts: list[str], edits: list[int]):
        self.length, self.edits = np.array([len(t) for t in texts], np.int64), np.array(edits, np.int64)
        self.has = np.zeros((len(texts), 1 << 12), bool)
        for x, t in enumerate(texts):
            if len(t) >= GRAM:
                self.has[x, self.slots(_codes(t))] = True
        self.has = self.has.ravel()
        self.least = self.length - GRAM + 1 - GRAM * self.edits

    @staticmethod
    def slots(codes: np.ndarray) -> np.ndarray:
        return ((_grams(codes, GRAM)[-1] * _BASE) >> _U(52)).astype(np.int32)

    def likely(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Which of the items may lie in the passages from ``low`` up to ``high``."""
        out = np.ones(len(item), bool)
        size = np.maximum(high - low - GRAM + 1, 1)
        ends = np.cumsum(size)
        low, base = low.astype(np.int32), (item << 12).astype(np.int32)
        k = 0
        while k < len(item):  # some 2 MB of places at a time
            j = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + (1 << 18), side="right")))
            n = size[k:j]
            before = np.cumsum(n) - n
            at = np.arange(int(n.sum()), dtype=np.int32) + np.repeat(low[k:j] - before.astype(np.int32), n)
            held = self.has.take(slots.take(at) + np.repeat(base[k:j], n)).view(np.uint8)
            out[k:j] = np.add.reduceat(held, before, dtype=np.int32) >= self.least[item[k:j]]
            k = j
        return out


def infix_distances(items: list[str] | list[bytes], windows: list[str] | list[bytes]) -> np.ndarray:
    """Edit distance of each item to the nearest substring of its window."""
    rows, cols = [_codes(x) for x in items], [_codes(x) for x in windows]
    length, n, m = np.array([len(x) for x in rows]), max(map(len, rows)), max(map(len, cols))
    a, b = np.zeros((len(rows), n), np.uint32), np.full((len(cols), m), 1, np.uint32)
    for k, (x, y) in enumerate(zip(rows, cols, strict=True)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    kind = np.int16 if n + m < 32_000 else np.int64  # no value is beyond n + m
    step = np.arange(m + 1, dtype=kind)
    row = np.zeros((len(items), m + 1), kind)
    out = np.where(length == 0, 0, 1 << 30)
    for i in range(n):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (a[:, i : i + 1] != b), out=new[:, 1:])
        new = np.minimum.accumulate(new - step, axis=1) + step  # insertions from the left
        row = new
        done = length == i + 1
        if done.any():
            out[done] = row[done].min(axis=1)
    return out


class Block:
    """Some items with their LSH tables and pieces. Only the items travel; what is made
    of them is built where it is first used."""

    def __init__(self, items: list[tuple[int, str]], similarity: float):
        self.similarity, self.token = similarity, uuid.uuid4().hex
        own = [(i, normal(t.encode("utf-8")).decode("utf-8")) for i, t in items]
        own = [(i, t) for i, t in own if t]
        self.ids, self.texts = [i for i, _ in own], [t for _, t in own]
        self.edits = [int((1 - similarity) * len(t) + 1e-9) for t in self.texts]

    def index(self) -> tuple[list[Tables], Pieces, Shares]:
        if self.token not in _built:
            _built.clear()  # a worker holds one block's tables
            codes, classes = [_codes(t) for t in self.texts], {}
            for x, t in enumerate(self.texts):
                fits = [w for w in SIZES if 2 * w - 1 <= len(t)]
                if fits:
                    classes.setdefault(fits[-1], []).append(x)
            tables = [Tables(w, x, codes) for w, x in sorted(classes.items())]
            _built[self.token] = tables, Pieces(self.texts, self.edits), Shares(self.texts, self.edits)
        return _built[self.token]

    def candidates(self, rows: list[str], pieces: bool = True) -> list[tuple[int, int, str]]:
        """(row, item, passage with a margin) of all that met and may be near."""
        tables, cut, shares = self.index()
        text = "\0".join(rows)  # no text or item holds a zero
        size = np.array([len(r) for r in rows], np.int64)
        begin = (np.cumsum(size + 1) - size - 1).astype(np.int64)
        pad = max([PIECE, *(t.size for t in tables)])
        codes = np.concatenate([_codes(text), np.zeros(pad, np.uint32)])
        letters, slots = _folded(codes), shares.slots(codes)
        met = [t.met(letters, begin, begin + size) for t in tables]
        if pieces:
            met.append(cut.met(codes, len(text)))
        if not met:
            return []
        item, at, offset = (np.concatenate([m[k] for m in met]) for k in range(3))
        row, place = np.searchsorted(begin, at, side="right") - 1, at - offset
        order = np.lexsort((place, item, row))
        row, item, place = row[order], item[order], place[order]
        new = np.ones(len(item), bool)  # the same place, met more than once
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1])
        row, item, place = row[new], item[new], place[new]
        margin = shares.edits[item]
        low = np.maximum(place - margin, begin[row])
        high = np.minimum(place + shares.length[item] + margin, begin[row] + size[row])
        near = shares.likely(item, low, high, slots)
        out: list[tuple[int, int, int, int]] = []
        for r, x, a, b in zip(row[near].tolist(), item[near].tolist(), low[near].tolist(), high[near].tolist(), strict=True):
            if out and out[-1][:2] == (r, x) and a <= out[-1][3] and b - out[-1][2] <= 5 * len(self.texts[x]):
                out[-1] = (r, x, out[-1][2], b)
            else:
                out.append((r, x, a, b))
        return [(r, x, text[a:b]) for r, x, a, b in out]

    def found(self, data: np.ndarray, at: np.ndarray, pieces: bool = True) -> list[tuple[int, int, int]]:
        """(row, item's index, distance) of the leaks in rows of text."""
        rows = [normal(data[a:b].tobytes()).decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        best: dict[tuple[int, int], int] = {}
        todo = []
        for r, x, wide in self.candidates(rows, pieces):
            if self.texts[x] in wide:
                best[r, x] = 0
            else:
                todo.append((r, x, wide))
        todo = sorted((t for t in todo if best.get(t[:2]) != 0), key=lambda t: len(t[2]))
        for k in range(0, len(todo), 128):
            group = todo[k : k + 128]
            d = infix_distances([self.texts[x] for _, x, _ in group], [w for *_, w in group])
            for (r, x, _), v in zip(group, d.tolist(), strict=True):
                if v <= self.edits[x]:
                    best[r, x] = min(v, best.get((r, x), 1 << 30))
        return [(r, x, d) for (r, x), d in best.items()]


#: Tables of the block in use, one per Python worker.
_built: dict[str, tuple[list[Tables], Pieces, Shares]] = {}


def blocks(benchmark: DataFrame, similarity: float, id: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of bounded size."""
    held: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select(F.col(f"`{id}`").cast("long").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL").toLocalIterator():
        held.append((r["i"], r["t"]))
        size += len(r["t"].encode())
        if size >= BLOCK_BYTES:
            yield Block(held, similarity)
            held, size = [], 0
    if held:
        yield Block(held, similarity)


def _leaks(batch: pa.RecordBatch, column: int, block: Block) -> list[tuple[int, int, int]]:
    data, at = text_views(batch.column(column))
    return [(i + r, *rest) for i, j in passes(at) for r, *rest in block.found(data[at[i] : at[j]], at[i : j + 1] - at[i])]


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, item, distance, item_chars): every document and benchmark item that it holds
    (the least distance found); documents without a leak give no row."""
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    kinds = "doc long, item long, distance long, item_chars long"
    out = None
    for block in blocks(benchmark, similarity):

        def run(batches, block=block):
            for batch in parts(batches, 4096):
                found = sorted(_leaks(batch, 1, block))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r for r, _, _ in found], pa.int64())),
                        pa.array([block.ids[x] for _, x, _ in found], pa.int64()),
                        pa.array([d for *_, d in found], pa.int64()),
                        pa.array([len(block.texts[x]) for _, x, _ in found], pa.int64()),
                    ],
                    ["doc", "item", "distance", "item_chars"],
                )

        part = docs.mapInArrow(tidy(run), kinds)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], kinds) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    column = docs.columns.index(text)
    for block in blocks(benchmark, similarity):

        def run(batches, block=block):
            for batch in parts(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, _, _ in _leaks(batch, column, block)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "distance", "item_chars")
