"""Jaccard self-join of documents on word n-grams, with prefix, length, positional
and suffix filters.

1. Frequencies: the words and the shingles of every document are counted in two tables
   of 2**SKETCH_BITS buckets. A shingle's frequency is estimated by its words' shares,
   or by what its bucket holds beyond the usual load if that is more (passages that
   many documents share). Shingles are ordered rare first by that estimate and then by
   their hash. Any total order keeps the join exact; the counts only make prefixes
   selective, so the tables need no more room at scale.
2. Documents of equal shingle sets are one class; its smallest document stands for it.
3. Prefix filter: sets x and y with 100 * |x & y| >= p * |x | y| share a shingle among
   the first |x| - ceil(p |x| / 100) + 1 of x and likewise of y. Only prefixes are
   shuffled, and of those only the rows go on that have a partner by the length filter
   (100 |x| >= p |y|) and the positional filter (1 + what is left after the shared
   shingle in both sets reaches the overlap needed).
4. The task that holds a shingle's group applies the suffix filter (overlap bounded by
   the two sets' counts in 128 hash ranges) to its pairs, so that only likely pairs
   leave it. At first each document meets only its likeliest partner among the NEAR
   before it and the first of its group; groups of more than CHUNK are salted.
5. Links found so far give components. What is left are pairs of a group that lie in
   different components. Groups of more than CHUNK are dealt out in chunks that meet
   two by two; those of one component do not meet.
   a. A posting with at most FEW partners before it by the counts names them. Those
      with more go on, with these partners, and their documents get a sketch: the
      parities of the counts in some eight hash ranges a shingle. The places where two
      sketches differ are at most the shingles that only one set has, so a pair that
      the sketches rule out is no link.
   b. Of those that go on, each names one pair, its likeliest partner in another
      component; what the pairs of a and b link is one component from here on.
   c. All pairs still in different components that the sketches allow are verified,
      once per pair. Pairs inside a component need no check, so no link between
      components is lost. Only pairs close to the threshold are left to name.

Verification rules candidates out by their sketches and joins the texts of the others: a
document meets its partners in groups of bounded size, and the sets are intersected
exactly (64-bit shingle hashes).

Null and empty texts have no shingles and no links; equal texts are linked. Rows without
an id take no part. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import discard, give_up_shuffles, id_filter, maybe_in, parts, passes, shingle_positions, shingles, signed, small_batches, stage, table, text_views, tidy
from claimlake.llm.components import components

SKETCH_BITS = 20
_SKETCH_PARTS = 64
#: Members that one task compares with a hub before the hub is copied to another.
MEMBERS_PER_SALT = 512
#: Postings of a shingle that one task lets meet; larger groups are dealt out in chunks.
CHUNK = 4096
#: Postings before it that one is compared with when the likely copies are linked.
NEAR = 32
#: Partners that a posting names itself; with more, sketches are compared first.
FEW = 4
_RANGES = 128
#: Bits of a sketch, at most (2 KB); sets of more than 2,048 shingles have a coarser one.
SKETCH_MOST = 1 << 14
_U = np.uint64
_KEY_BITS = 58


def _positions(batch: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, at = text_views(batch.column(1))
    return shingle_positions(data, at, k)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - SKETCH_BITS)).astype(np.int64)


def frequencies(docs: DataFrame, k: int) -> tuple[bytes, bytes]:
    """Two tables of 2**SKETCH_BITS bytes, from the counts over all documents: the
    logarithm of a word bucket's share of all words, and that of the shingles that a
    shingle bucket holds beyond the usual load. Both are sums of tables of fixed
    size, whatever the input."""
    size = 1 << SKETCH_BITS
    part = 2 * size // _SKETCH_PARTS

    def count(batches):
        total = np.zeros(2 * size, np.int64)
        held: list[np.ndarray] = []
        room = 0
        for batch in batches:
            for s, w in _positions(batch, k):
                held += [_bucket(w), _bucket(np.unique(s)) + size]
                room += len(w)
                if room > size:
                    total += np.bincount(np.concatenate(held), minlength=2 * size)
                    held, room = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=2 * size)
        wide = total.astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_SKETCH_PARTS), pa.int32()), pa.array([wide[i * part : (i + 1) * part].tobytes() for i in range(_SKETCH_PARTS)], pa.binary())], ["part", "counts"]
        )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(c.as_buffer(), np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])

    counted = docs.mapInArrow(tidy(count), "part int, counts binary").repartition(_SKETCH_PARTS // 4, "part").mapInArrow(tidy(add), "part int, counts binary")
    total = np.zeros(2 * size, np.int64)
    with small_batches(docs.sparkSession):
        rows = counted.collect()  # 64 rows, 8 bytes a bucket in all: 16 MB
    give_up_shuffles(docs.sparkSession)
    for r in rows:
        total[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["counts"], np.int64)
    words, grams = total[:size], total[size:]
    rare = np.log2(max(1, words.sum()) / np.maximum(words, 1))
    many = np.log2(np.maximum(1, grams - 1.5 * grams.mean()))
    return np.clip(np.round(4 * rare), 0, 255).astype(np.uint8).tobytes(), np.clip(np.round(4 * many), 0, 255).astype(np.uint8).tobytes()


class Order:
    """Rare-first order of shingles: the class (0 to 63) of a shingle grows with the
    larger of two estimates of its frequency, the product of its words' shares and
    what its bucket was seen to hold beyond the usual load."""

    def __init__(self, words: bytes, grams: bytes, k: int):
        self.words, self.grams, self.k = np.frombuffer(words, np.uint8), np.frombuffer(grams, np.uint8), k
        self.most = 4 * 40.0  # quarter bits; a trillion words

    def keys(self, shingles_: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The distinct shingles as sorted keys, class first."""
        if not len(shingles_):
            return shingles_
        share = np.concatenate([[0], np.cumsum(self.words[_bucket(words)], dtype=np.int64)])
        k = min(self.k, len(words))
        product = self.most - (share[k:] - share[:-k])  # of the expected count
        estimate = np.maximum(product, self.grams[_bucket(shingles_)])
        level = np.clip(np.round((estimate + 480) / 10), 0, 63).astype(np.uint64)
        return np.unique((level << _U(_KEY_BITS)) | (shingles_ & _U((1 << _KEY_BITS) - 1)))


def _needed(nx, ny, percent: int):
    """The overlap that 100 * |x & y| >= percent * |x | y| asks for."""
    return -((-percent * (nx + ny)) // (100 + percent))


def shingle_sets(docs: DataFrame, tables: tuple[bytes, bytes], k: int, percent: int, keys_only: bool = False) -> DataFrame:
    """(doc, n, h1, h2, prefix, ranges): set size, 128-bit digest of the set, prefix keys
    and counts of the keys in 128 hash ranges (these two are left empty if ``keys_only``).
    One row per document."""

    def run(batches):
        order = Order(*tables, k)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield _sets(batch.slice(at, 512), order)

    def _sets(batch, order):
        n, h1, h2, prefix, ranges = [], [], [], [], []
        for s, w in _positions(batch, k):
            keys = order.keys(s, w)
            m = len(keys)
            n.append(m)
            total = np.array([keys.sum(dtype=np.uint64), (keys ^ (keys >> _U(31)) * _U(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)], np.uint64)
            a, b = signed(total)
            h1.append(int(a))
            h2.append(int(b))
            if keys_only:
                prefix.append(b"")
                ranges.append(b"")
                continue
            p = m - (-(-percent * m // 100)) + 1 if m else 0
            prefix.append(keys[:p].tobytes())
            ranges.append(np.minimum(np.bincount((keys & _U(_RANGES - 1)).astype(np.int64), minlength=_RANGES), 255).astype(np.uint8).tobytes() if m else b"")
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(prefix, pa.binary()), pa.array(ranges, pa.binary())],
            ["doc", "n", "h1", "h2", "prefix", "ranges"],
        )

    return docs.mapInArrow(tidy(run), "doc long, n long, h1 long, h2 long, prefix binary, ranges binary")


def _postings(classes_: DataFrame) -> DataFrame:
    """(key, at, doc): a row for each prefix key of each class; at packs set size
    and position, so that a group sorts by size."""

    def run(batches):
        for batch in batches:
            docs, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, at = text_views(batch.column(2))
            for i, j in passes(at):
                keys = np.frombuffer(data[at[i] : at[j]].tobytes(), np.int64)
                sizes = np.diff(at[i : j + 1]) // 8
                first = np.repeat((at[i:j] - at[i]) // 8, sizes)
                pos = np.arange(len(keys)) - first
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array((np.repeat(n[i:j], sizes) << 32) | pos), pa.array(np.repeat(docs[i:j], sizes))], ["key", "at", "doc"])

    return classes_.select("doc", "n", "prefix").mapInArrow(tidy(run), "key long, at long, doc long")


def _allowed(a, b, percent: int):
    """Length and positional filter for packed (size, position) values, |a| <= |b|."""
    na, nb, pa_, pb = a >> 32, b >> 32, a & 0xFFFFFFFF, b & 0xFFFFFFFF
    return (100 * na >= percent * nb) & (np.minimum(na - pa_, nb - pb) >= _needed(na, nb, percent))


def _partnered(key: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Which sorted postings have a partner: another of the same shingle that the length
    and positional filters allow. Of the postings of one size only the two with most
    shingles left can matter to others; whether one of those will do is a question for
    the maximum of a range of sizes, so a group is not walked pair by pair."""
    n = at >> 32
    left = n - (at & 0xFFFFFFFF)
    place = (np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) << 33) | n
    seq = np.arange(len(key))
    rank = seq - np.searchsorted(place, place)
    heads = np.flatnonzero(rank < 2)
    # 100 |x & y| >= percent |x | y| asks both to have left * (100 + percent) >= percent * (nx + ny)
    best = [(100 + percent) * left[heads] - percent * n[heads]]
    while 2 << (len(best) - 1) <= len(heads):
        half = 1 << (len(best) - 1)
        best.append(np.maximum(best[-1][:-half], best[-1][half:]))
    group = place >> 33 << 33
    most = np.minimum(100 * n // percent, ((100 + percent) * left - percent * n) // percent)
    low = np.searchsorted(place[heads], group | -(-percent * n // 100), "left")
    high = np.searchsorted(place[heads], group | np.maximum(most, 0), "right")
    own = np.searchsorted(heads, seq)  # a head's own place; another's is past its size's heads
    is_head = rank < 2
    keep = np.zeros(len(key), bool)
    for a, b in ((low, np.where(is_head, np.minimum(high, own), high)), (np.where(is_head, np.maximum(low, own + 1), high), high)):
        j = np.flatnonzero(a < b)
        level = np.frexp((b[j] - a[j]).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            i = j[level == k]
            keep[i] |= np.maximum(best[k][a[i]], best[k][b[i] - (1 << k)]) >= percent * n[i]
    return keep


def _meetings(key: np.ndarray, at: np.ndarray, percent: int, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places (i, j), i < j, of sorted postings of one shingle that the length
    and positional filters allow, a distance at a time (up to ``most``). A posting is
    followed back only as far as the sizes allow."""
    first = np.searchsorted(key, key)
    live, lag = np.arange(len(key)), 1
    while most is None or lag <= most:
        live = live[live - lag >= first[live]]
        live = live[100 * (at[live - lag] >> 32) >= percent * (at[live] >> 32)]
        if not len(live):
            return
        j = live[_allowed(at[live - lag], at[live], percent)]
        if len(j):
            yield j - lag, j
        lag += 1


def _groups(batches: Iterator[pa.RecordBatch], columns) -> Iterator[list[np.ndarray]]:
    """Sorted batches as column lists that end where a group (first column) ends."""
    held: list[list[np.ndarray]] = []  # parts of one group
    join = lambda x: [np.concatenate(c) for c in zip(*x, strict=True)]
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = columns(batch)
        if held and held[0][0][0] == cols[0][-1]:
            held.append(cols)
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1]))  # this group may go on
        if held or last:
            yield join([*held, [c[:last] for c in cols]])
        held = [[c[last:] for c in cols]]
    if held:
        yield join(held)


def _shared(postings: DataFrame, percent: int) -> DataFrame:
    """The postings that have a partner: another of the same shingle that the length and
    positional filters allow beside it."""

    def run(batches):
        for key, at, doc in _groups(batches, lambda b: [b.column(i).to_numpy() for i in range(3)]):
            keep = _partnered(key, at, percent)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, at, doc)], ["key", "at", "doc"])

    return postings.repartition("key").sortWithinPartitions("key", "at", "doc").mapInArrow(tidy(run), postings.schema)


def _bound(na, nb, ra, rb):
    """Largest overlap that the counts by hash range allow; what full ranges hold
    beyond 255 is not known by range."""
    return np.minimum(ra, rb).sum(axis=1, dtype=np.int64) + np.minimum(na - ra.sum(axis=1, dtype=np.int64), nb - rb.sum(axis=1, dtype=np.int64))


def _sketch(keys: np.ndarray) -> bytes:
    """Parities of the counts of a set's shingles in some eight hash ranges a shingle."""
    width = min(max(256, 8 << len(keys).bit_length()), SKETCH_MOST)
    return np.packbits(np.bincount((keys & _U(width - 1)).astype(np.int64), minlength=width) & 1 == 1, bitorder="little").tobytes()


class Sketches:
    """Packed sketches of several widths, to be compared pair by pair."""

    def __init__(self, packed: np.ndarray):
        self.width = np.array([len(x) for x in packed], np.int64)
        self.place, self.rows = np.zeros(len(packed), np.int64), {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == w)
            self.place[own] = np.arange(len(own))
            self.rows[w] = np.frombuffer(b"".join(packed[own]), np.uint64).reshape(-1, w // 8)

    def _folded(self, of: np.ndarray, width: int, to: int) -> np.ndarray:
        x = self.rows[width][self.place[of]]
        while x.shape[1] > to // 8:  # two ranges become one, and their parities add up
            half = x.shape[1] // 2
            x = x[:, :half] ^ x[:, half:]
        return x

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """At most the number of shingles that only one set of each pair (i, j) has."""
        out = np.zeros(len(i), np.int64)
        for v in self.rows:
            for w in self.rows:
                k = np.flatnonzero((self.width[i] == v) & (self.width[j] == w))
                step = max(1, (8 << 20) // max(v, w))
                for b in range(0, len(k), step):
                    p = k[b : b + step]
                    differ = self._folded(i[p], v, min(v, w)) ^ self._folded(j[p], w, min(v, w))
                    out[p] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        return out


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc, n, sketch) of documents (doc, text); those without shingles give no row."""

    def run(batches):
        for batch in parts(batches, 256):
            data, at = text_views(batch.column(1))
            sets = list(shingles(data, at, k))
            some = pa.array([len(s) > 0 for s in sets], pa.bool_())
            n, packed = pa.array([len(s) for s in sets], pa.int64()), pa.array([_sketch(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(some), n.filter(some), packed.filter(some)], ["doc", "n", "sketch"])

    return docs.select("doc", "text").mapInArrow(tidy(run), "doc long, n long, sketch binary")


def _passing(i, j, at, features: np.ndarray | Sketches, percent: int):
    """(i, j, overlap possible beyond the one needed) of the pairs that pass the suffix
    filter (counts by range, or sketches), in bounded pieces."""
    for k in range(0, len(i), 8192):
        p, q = i[k : k + 8192], j[k : k + 8192]
        na, nb = at[p] >> 32, at[q] >> 32
        most = (na + nb - features.apart(p, q)) // 2 if isinstance(features, Sketches) else _bound(na, nb, features[p], features[q])
        over = most - _needed(na, nb, percent)
        ok = over >= 0
        yield p[ok], q[ok], over[ok]


def _nearest(key: np.ndarray, at: np.ndarray, ranges: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join a group's likely copies: each posting's likeliest partner among the
    NEAR before it, and the first of its group; linear in the group."""
    best, top, low = (np.full(len(key), -1) for _ in range(3))
    for i, j in _meetings(key, at, percent, NEAR):
        for p, q, over in _passing(i, j, at, ranges, percent):
            more = over >= top[q]
            best[q[more]], top[q[more]] = p[more], over[more]
            low[q] = p
    place = (np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) << 33) | (at >> 32)
    i = np.searchsorted(place, (place >> 33 << 33) | -(-percent * (at >> 32) // 100))
    j = np.flatnonzero(i < np.arange(len(key)) - NEAR)
    j = j[_allowed(at[i[j]], at[j], percent)]
    for p, q, _ in _passing(i[j], j, at, ranges, percent):
        low[q] = p
    j = np.flatnonzero(best >= 0)
    return np.concatenate([best[j], low[j]]), np.concatenate([j, j])


def _crossing(key, at, comp, side, features, percent: int):
    """(i, j, overlap possible beyond the one needed) of a part's pairs that lie in
    different components, not on one side (0: not divided), and pass the filters."""
    for i, j in _meetings(key, at, percent):
        other = (comp[i] != comp[j]) & ((side[i] != side[j]) | (side[i] == 0))
        yield from _passing(i[other], j[other], at, features, percent)


def _part_columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    """part, at, doc, comp, side, key, and the counts by range or packed sketches."""
    packed = batch.column(6)
    if batch.schema.names[6] == "ranges":
        return [batch.column(i).to_numpy() for i in range(6)] + [text_views(packed)[0].reshape(-1, _RANGES)]
    last = np.empty(batch.num_rows, object)
    last[:] = packed.to_pylist()
    return [batch.column(i).to_numpy() for i in range(6)] + [last]


def _by_part(pairs: DataFrame) -> DataFrame:
    last = "ranges" if "ranges" in pairs.columns else "sketch"
    return pairs.select("part", "at", "doc", "comp", "side", "key", last).repartition("part").sortWithinPartitions("part", "at", "doc")


def _named(pairs: DataFrame, which: str, percent: int) -> DataFrame:
    """(a, b) of a part's pairs. ``near``: those of ``_nearest``. ``best``: each posting's
    likeliest partner in another component. ``all``: all pairs of ``_crossing``. A task
    names a pair once for all its parts (of each million)."""

    def found_in(cols):
        key, at, doc, comp, side, _, features = cols
        if features.dtype == object:
            features = Sketches(features)
        if which == "near":
            i, j = _nearest(key, at, features, percent)
            yield np.stack([doc[i], doc[j]], axis=1)
        elif which == "best":
            top, best = np.full(len(key), -1), np.full(len(key), -1)
            for i, j, over in _crossing(key, at, comp, side, features, percent):
                for p, q in ((i, j), (j, i)):  # a place occurs once in each
                    more = over > top[p]
                    top[p[more]], best[p[more]] = over[more], q[more]
            j = np.flatnonzero(best >= 0)
            yield np.stack([doc[np.minimum(j, best[j])], doc[np.maximum(j, best[j])]], axis=1)
        else:
            for i, j, _ in _crossing(key, at, comp, side, features, percent):
                yield np.stack([doc[i], doc[j]], axis=1)

    def named(found):
        ab = np.unique(np.sort(np.concatenate(found), axis=1) if which == "best" else np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(ab[:, 0])), pa.array(np.ascontiguousarray(ab[:, 1]))], ["a", "b"])

    def run(batches):
        found, size = [], 0
        for cols in _groups(batches, _part_columns):
            for ab in found_in(cols):
                found.append(ab)
                size += len(ab)
                if size > 1_000_000 or len(found) > 10_000:
                    yield named(found)
                    found, size = [], 0
        if found:
            yield named(found)

    return _by_part(pairs).mapInArrow(tidy(run), "a long, b long")


def _crossed(pairs: DataFrame, percent: int) -> DataFrame:
    """(key, at, doc, comp, other): of the pairs of ``_crossing``, those whose later posting
    has at most FEW as (null, null, a, null, b), and the postings of the others with
    other null. All pairs are among the named ones or between such postings."""

    def batch_of(key, at, doc, comp, other):
        columns = [pa.array(x, pa.int64()) if x is not None else pa.nulls(len(doc), pa.int64()) for x in (key, at, doc, comp, other)]
        return pa.RecordBatch.from_arrays(columns, ["key", "at", "doc", "comp", "other"])

    def named(found):
        ab = np.unique(np.concatenate(found), axis=0)
        return batch_of(None, None, np.ascontiguousarray(ab[:, 0]), None, np.ascontiguousarray(ab[:, 1]))

    def run(batches):
        found, size = [], 0
        for key, at, doc, comp, side, own, features in _groups(batches, _part_columns):
            keep, count, early = np.zeros(len(key), bool), np.zeros(len(key), np.int64), []
            for i, j, _ in _crossing(key, at, comp, side, features, percent):
                count[j] += 1  # a place occurs once
                few = count[j] <= FEW
                early.append(np.stack([i[few], j[few]]))
                keep[i[~few]] = keep[j[~few]] = True
            i, j = np.concatenate([np.zeros((2, 0), np.int64), *early], axis=1)
            few = count[j] <= FEW
            keep[i[~few]] = keep[j[~few]] = True
            yield batch_of(own[keep], at[keep], doc[keep], comp[keep], None)
            found.append(np.stack([doc[i[few]], doc[j[few]]], axis=1))
            size += int(few.sum())
            if size > 1_000_000 or len(found) > 10_000:
                yield named(found)
                found, size = [], 0
        if found:
            yield named(found)

    return _by_part(pairs).mapInArrow(tidy(run), "key long, at long, doc long, comp long, other long")


def _likely_pairs(members: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """Pairs that are likely copies (see ``_nearest``). A key of more than CHUNK postings is
    salted, by document and key: copies share many keys, and meet others in each."""
    hot = stage(members.sparkSession, members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK), "hot")
    salt = F.coalesce(F.pmod(F.xxhash64("doc", "key"), F.ceil(F.col("n") / CHUNK)), F.lit(0))
    dealt = members.withColumn("n", F.lit(None).cast("long")) if hot.isEmpty() else members.join(hot, "key", "left")
    part = F.when(F.col("n").isNull(), F.col("key")).otherwise(F.xxhash64("key", salt))
    return _named(dealt.select(part.alias("part"), "at", "doc", F.col("doc").alias("comp"), F.lit(0).alias("side"), "key").join(features, "doc"), "near", percent)


def _cross_parts(members: DataFrame) -> DataFrame:
    """(part, at, doc, comp, side, key) from postings (key, at, doc, comp), such that the
    pairs of a group that lie in different components meet in a part. A key of more than
    CHUNK postings is dealt out in chunks of about that many, and a part is two chunks
    that meet or one by itself. A component of more than CHUNK postings has chunks of its
    own, which do not meet."""
    tally = stage(members.sparkSession, members.groupBy("key", "comp").agg(F.count("*").alias("n")), "tally")
    big = tally.groupBy("key").agg(F.sum("n").alias("all")).where(F.col("all") > CHUNK)
    plain = members.select(F.col("key").alias("part"), "at", "doc", "comp", F.lit(0).alias("side"), "key")
    if big.isEmpty():
        return plain
    big = stage(members.sparkSession, big, "big")
    own = F.col("n") > CHUNK
    bins = tally.join(big, "key").select("key", "comp", "n", own.alias("own"), F.when(own, F.col("comp")).otherwise(F.pmod(F.xxhash64("comp"), F.ceil(F.col("all") / CHUNK))).alias("bin"))
    sizes = bins.groupBy("key", "own", "bin").agg(F.ceil(F.sum("n") / CHUNK).alias("subs"))
    chunks = sizes.select("key", F.expr("explode(sequence(0L, subs - 1))").alias("sub"), "own", "bin").select("key", F.struct("own", "bin", "sub").alias("c"))
    met = chunks.withColumnRenamed("c", "l").join(chunks.withColumnRenamed("c", "r"), "key").where("l <= r AND NOT (l.own AND r.own AND l.bin = r.bin)")
    met = met.select("key", "l", "r", F.xxhash64("key", "l", "r").alias("part"))
    duties = met.select("key", F.col("l").alias("c"), "part", F.expr("CASE WHEN l = r THEN 0 ELSE 1 END").alias("side")).union(met.where("l != r").select("key", "r", "part", F.lit(2)))
    placed = members.join(bins.select("key", "comp", "own", "bin"), ["key", "comp"]).join(sizes, ["key", "own", "bin"])
    placed = placed.select("key", "at", "doc", "comp", F.struct("own", "bin", F.expr("pmod(xxhash64(doc), subs)").alias("sub")).alias("c"))
    dealt = placed.join(duties, ["key", "c"]).select("part", "at", "doc", "comp", "side", "key")
    return plain.join(big.select("key"), "key", "left_anti").select(*dealt.columns).union(dealt)


def _cross_pairs(members: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """Every pair (a, b) of a group that lies in different components and passes the
    filters. members: key, at, doc, comp; features: doc and ranges or sketch."""
    return _named(_cross_parts(members).join(features, "doc"), "all", percent)


def _possible(pairs: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out."""
    left = sketched.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    right = sketched.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))

    def run(batches):
        for batch in parts(batches):
            n, (a, b, na, nb) = batch.num_rows, (batch.column(i).to_numpy() for i in range(4))
            packed = np.empty(2 * n, object)
            packed[:] = batch.column(4).to_pylist() + batch.column(5).to_pylist()
            at = np.concatenate([na, nb]) << 32
            for i, _, _ in _passing(np.arange(n), np.arange(n) + n, at, Sketches(packed), percent):
                yield pa.RecordBatch.from_arrays([pa.array(a[i]), pa.array(b[i])], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "x", "y").mapInArrow(tidy(run), "a long, b long").distinct()


def verify(spark: SparkSession, pairs: DataFrame, docs: DataFrame, k: int, percent: int, old: list[str], sketched: bool = False) -> DataFrame:
    """(a, b) for the pairs (columns a, b) whose shingle sets reach the threshold. Each
    pair is compared once, if the sketches allow it (``sketched``: they do for all). A document's partners are dealt out
    by MEMBERS_PER_SALT, and its text goes to each of these groups once. ``old`` notes the
    tables that are not needed once the result is staged."""
    wanted = pairs.select(F.col("a").alias("doc")).union(pairs.select("b"))
    texts = stage(spark, maybe_in(docs, "doc", id_filter(wanted, "doc")), "texts", old)
    if not sketched:
        pairs = stage(spark, _possible(pairs, sketches(texts, k), percent), "possible", old)
    ranked = pairs.selectExpr("a", "b", "row_number() OVER (PARTITION BY a ORDER BY b) - 1 AS nth")
    ranked = ranked.select("a", "b", F.expr(f"nth div {MEMBERS_PER_SALT}").alias("salt"), F.expr(f"nth % {MEMBERS_PER_SALT}").alias("nth"))
    hubs = ranked.where("nth = 0").join(texts, F.col("a") == F.col("doc")).select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    members = ranked.join(texts, F.col("b") == F.col("doc")).select("a", "salt", "b", "text")

    def run(batches):
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, at = text_views(batch.column(2))
            left, right = [], []
            for x, y, s in zip(a, b, shingles(data, at, k), strict=True):
                if y is None:
                    hub, own = x, s
                    continue
                assert hub == x
                small, large = (s, own) if len(s) < len(own) else (own, s)
                if not len(small):
                    continue
                spot = np.minimum(np.searchsorted(large, small), len(large) - 1)
                if int((large[spot] == small).sum()) >= _needed(len(s), len(own), percent):
                    left.append(x)
                    right.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    dealt = hubs.union(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "text").mapInArrow(tidy(run), "a long, b long")


def ngram_join(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, links, groups): ``sets`` has doc, n and rep for every document (rep: the
    smallest document of equal set; a document without shingles is its own), ``links``
    verified pairs (a, b) of representatives that hold every component together, and
    ``groups`` doc, n and component, the smallest id reachable by links of at least
    ``percent`` % Jaccard similarity."""
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).where("doc IS NOT NULL")
    tables = frequencies(docs, k)
    # read twice: the prefixes of all documents need not be kept on disk
    sets = stage(spark, shingle_sets(docs, tables, k, percent, keys_only=True).select("doc", "n", "h1", "h2"), "sets")
    same = shingle_sets(docs, tables, k, percent).where("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.struct("doc", "prefix", "ranges")).alias("first"))
    old: list[str] = []
    whole = stage(spark, same.select("first.doc", "n", "first.prefix", "first.ranges", "h1", "h2"), "whole", old)
    members = stage(spark, _shared(_postings(whole), percent), "shared")
    reps = stage(spark, whole.drop("prefix"), "reps")
    discard(spark, old)
    features = reps.select("doc", "ranges")

    first = stage(spark, _likely_pairs(members, features, percent).distinct(), "likely")
    found = stage(spark, verify(spark, first, docs, k, percent, old), "found")
    discard(spark, old)
    comps = components(spark, found).withColumnRenamed("vertex", "doc")
    members = stage(spark, members.join(comps, "doc", "left").select("key", "at", "doc", F.coalesce("component", "doc").alias("comp")), "members")
    open_ = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("key")
    parts_ = _cross_parts(members.join(open_, "key", "left_semi"))
    crossed = stage(spark, _crossed(parts_.join(features, "doc"), percent).distinct(), "crossed")
    alive = crossed.where("other IS NULL").select("key", "at", "doc", "comp")
    wide = stage(spark, sketches(maybe_in(docs, "doc", id_filter(alive, "doc")), k), "sketches").select("doc", "sketch")
    best = _named(_cross_parts(alive).join(wide, "doc"), "best", percent)
    best = crossed.where("other IS NOT NULL").select(F.col("doc").alias("a"), F.col("other").alias("b")).union(best).distinct()
    best = stage(spark, best.join(first, ["a", "b"], "left_anti"), "best")
    found = found.union(stage(spark, verify(spark, best, docs, k, percent, old), "found"))
    discard(spark, old)
    comps = components(spark, found).withColumnRenamed("vertex", "doc")
    alive = alive.join(comps, "doc", "left").select("key", "at", "doc", F.coalesce("component", "comp").alias("comp"))
    rest = _cross_pairs(alive, wide, percent).distinct().join(first.union(best), ["a", "b"], "left_anti")
    links = stage(spark, found.union(verify(spark, stage(spark, rest, "rest"), docs, k, percent, old, sketched=True)), "links")
    discard(spark, old)
    joined = components(spark, links).withColumnRenamed("vertex", "rep")
    rep = reps.select(F.col("doc").alias("rep"), "h1", "h2", "n")
    all_sets = sets.join(rep, ["h1", "h2", "n"], "left").select("doc", "n", F.coalesce("rep", "doc").alias("rep"))
    groups = all_sets.join(joined, "rep", "left").select("doc", "n", F.coalesce("component", "rep").alias("component"))
    return all_sets, links, groups


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, groups = ngram_join(spark, table(spark, sf_dir, "documents"), k=4, percent=85)
    return groups.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


#: Brute force over all pairs that share a shingle, components by recursion.
OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
  FROM words),
reps AS (SELECT min(doc_id) AS doc_id, any_value(len(s)) AS n, any_value(s) AS s FROM sets GROUP BY md5(array_to_string(list_sort(s), chr(10)))),
grams AS (SELECT doc_id, n, hash(unnest(s)) AS g FROM reps),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY ALL),
near AS (SELECT a, b FROM shared WHERE 100 * o >= 85 * (na + nb - o)),
edges AS (
  SELECT a, b FROM near UNION SELECT b, a FROM near
  UNION SELECT r.doc_id, s.doc_id FROM sets s JOIN reps r ON len(s.s) > 0 AND len(s.s) = r.n AND md5(array_to_string(list_sort(s.s), chr(10))) = md5(array_to_string(list_sort(r.s), chr(10))) AND s.doc_id <> r.doc_id),
sym AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT doc_id AS v, doc_id AS c FROM sets UNION SELECT sym.b, reach.c FROM reach JOIN sym ON reach.v = sym.a WHERE reach.c < sym.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM sets s JOIN reach r ON r.v = s.doc_id GROUP BY s.doc_id, len(s.s)
"""
