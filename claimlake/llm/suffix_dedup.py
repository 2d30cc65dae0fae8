"""Removal of repeated byte strings across a corpus, by suffix arrays.

A suffix array over all texts does not fit one machine, so the suffixes are dealt out
by content first. Each window of ``length`` bytes is keyed by the smallest hash of its
24-byte grams; windows that are equal have equal keys, and neighbouring windows mostly
share theirs, so a text falls into runs of some 190 positions. All places where a
repeated string starts are runs of one key.

Runs of equal key and equal text are one class: it is sorted once, with its number of
places. A class whose key occurs in one place, with the key's gram in it once, cannot
repeat and ends here. The texts of the
others are brought together by key and a task builds the suffix array of some megabytes
of them in two stages: suffixes that are smaller than their successors are sorted
directly, the rest follow by scanning the buckets of first bytes in order, each entry
putting its predecessor behind what its bucket holds. Neighbours in the array with a
common prefix of ``length`` bytes are repeats; so is a class with two places or more.

A key with very many classes (a passage that a third of the documents quote, each
followed by something else) is cut further: its windows are keyed anew by their offset
from the key's gram, in steps of 16, and the bytes that all windows of a step share.

Null and empty texts and texts below ``length`` bytes lose nothing. Texts are judged as
they came in: all copies of a repeated string go. Rows are known by a number given to each when
the texts are written once at the start, not by their ids: rows without an id, or that
repeat one, are documents of their own, and every row is returned with the id it has. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import PASS_BYTES, byte_hash, id_filter, in_filter, maybe_in, mix, passes, shingle_positions, signed, slot, stage, table, text_views, tidy

GRAM = 24
#: Positions of a run at most; longer ones (periodic texts) are cut.
RUN = 512
#: Classes of a key that are sorted as they are; beyond, the key is cut further.
CLASSES_PER_KEY = 2048
STEP = 16
#: Words of a run that name it, hashed in parts of so many words (see ``shared_passages``).
LEAST, PARTS = 30, 10
#: Bytes of class texts that go into one suffix array, if a key has no more.
BLOCK_BYTES = 1 << 18
_U = np.uint64
_NONE = np.zeros(0, np.uint64)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by running minima within blocks of w."""
    n = len(x) - w + 1
    pad = -len(x) % w
    blocks = np.concatenate([x, np.full(pad, ~_U(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the gram at each position, hash sums of the bytes)."""
    h = byte_hash()
    sums = h.sums(data)
    at = np.arange(len(data) - GRAM + 1)
    return h.ranges(sums, at, at + GRAM), sums


def _runs_of(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start, positions, key, digest, again) of the runs of windows that lie in one
    row; again: the key's gram stands there twice, so the run may repeat itself."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams, sums = _grams(data)
    width = length - GRAM + 1
    keys = _sliding_min(grams, width)
    inside = np.zeros(len(data) + 1, np.int64)
    big = np.diff(at) >= length
    np.add.at(inside, at[:-1][big], 1)
    np.add.at(inside, at[1:][big] - length + 1, -1)
    inside = np.cumsum(inside)[: len(keys)] > 0
    new = inside.copy()
    new[1:] &= (keys[1:] != keys[:-1]) | ~inside[:-1]
    new[at[:-1][big]] = True
    starts = np.flatnonzero(new)
    stops = inside & np.concatenate([new[1:] | ~inside[1:], [True]])
    ends = np.flatnonzero(stops) + 1
    pieces = -(-(ends - starts) // RUN)
    first = np.repeat(starts, pieces)
    k = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    s = first + k * RUN
    e = np.minimum(s + RUN, np.repeat(ends, pieces))
    row = np.searchsorted(at, s, side="right") - 1
    digest = mix(byte_hash().ranges(sums, s, e + length - 1) + (e - s).astype(np.uint64))
    again = np.array([np.count_nonzero(grams[a : b + width - 1] == k) > 1 for a, b, k in zip(s.tolist(), e.tolist(), keys[s], strict=True)], bool)
    return row, s - at[row], e - s, keys[s], digest, again


def window_runs(docs: DataFrame, length: int) -> DataFrame:
    """(key, digest, size, doc, start, again): the runs of every text. A long text is handled
    in overlapping parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, at = text_views(batch.column(1))
            for i, j in passes(at):
                lo, hi = int(at[i]), int(at[j])
                for begin in range(lo, max(hi - length + 1, lo + 1), PASS_BYTES if j == i + 1 else hi - lo + 1):
                    end = min(hi, begin + PASS_BYTES + length - 1) if j == i + 1 else hi
                    rows = at[i : j + 1] - lo if j > i + 1 else np.array([0, end - begin])
                    row, s, size, key, digest, again = _runs_of(data[begin:end], rows, length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(key)), pa.array(signed(digest)), pa.array(size.astype(np.int32)), pa.array(ids[i + row].astype(np.int64)), pa.array((s + (begin - lo)).astype(np.int64)), pa.array(again.astype(bool))],
                        ["key", "digest", "size", "doc", "start", "again"],
                    )

    return docs.mapInArrow(tidy(run), "key long, digest long, size int, doc long, start long, again boolean")


def _direct(words: np.ndarray, pos: np.ndarray, same: np.ndarray, depth: int) -> np.ndarray:
    """``pos`` in the order of the first ``depth`` bytes there, 32 bytes at a time.
    same: equal for positions that agree in all of them; such ties are left."""
    seq = np.arange(len(pos))
    act, group = seq.copy(), np.zeros(len(pos), np.int64)
    for d in range(0, depth, 32):
        sub = seq[act]
        at = pos[sub] + d
        cols = [words[at + 8 * q].astype(np.uint64) for q in range(4)]
        o = np.lexsort((same[sub], *cols[::-1], group))
        sub, group, cols = sub[o], group[o], [c[o] for c in cols]
        seq[act] = sub
        new = np.ones(len(sub), bool)
        new[1:] = group[1:] != group[:-1]
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        group = np.cumsum(new) - 1
        differ = np.zeros(len(sub), bool)
        differ[1:] = (same[sub][1:] != same[sub][:-1]) & ~new[1:]
        open_ = np.bincount(group[differ], minlength=int(group[-1]) + 1 if len(group) else 0) > 0
        keep = open_[group]
        act, group = act[keep], group[keep]
        if not len(act):
            break
    return pos[seq]


def suffix_order(text: np.ndarray, want: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes, exact for the first
    ``depth`` bytes: two-stage sorting."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 40, np.uint8)])
    words = np.ndarray((n + depth + 32,), dtype=">u8", buffer=padded.tobytes(), strides=(1,))
    index = np.arange(n)
    turn = np.minimum.accumulate(np.concatenate([np.where(text[:-1] != text[1:], index[:-1], n), [n]])[::-1])[::-1]
    small = (turn < n) & (padded[turn] < padded[np.minimum(turn + 1, n)])  # smaller than its successor
    small[turn == n] = False
    next_small = np.minimum.accumulate(np.where(small, index, n)[::-1])[::-1]
    # what is induced needs the suffixes up to the next directly sorted one
    span = np.zeros(n + 2, np.int64)
    wanted = np.flatnonzero(want)
    np.add.at(span, wanted, 1)
    np.add.at(span, np.minimum(next_small[wanted] + 1, n), -1)
    used = np.cumsum(span)[:n] > 0
    direct = np.flatnonzero(used & small)
    h = byte_hash()
    direct = _direct(words, direct, h.ranges(h.sums(padded), direct, direct + depth), depth)
    cut = np.searchsorted(text[direct], np.arange(257))
    induced = used & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and induced[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))  # its successor is the empty suffix
    out = []
    for c in range(256):
        parts = waiting[c]
        wave = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        parts = []
        while len(wave):
            parts.append(wave)
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (text[before] == c)]
        entries = np.concatenate([*parts, direct[cut[c] : cut[c + 1]]])
        if not len(entries):
            continue
        out.append(entries)
        before = entries[entries > 0] - 1
        before = before[induced[before]]
        before = before[text[before] > c]
        if len(before):
            chars = text[before]
            o = np.argsort(chars, kind="stable")
            before, chars = before[o], chars[o]
            edges = np.flatnonzero(np.diff(chars)) + 1
            for part in np.split(before, edges):
                waiting[text[part[0]]].append(part)
    order = np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)
    return order[want[order]]


def repeated(text: np.ndarray, want: np.ndarray, length: int) -> np.ndarray:
    """Mask of the wanted positions whose next ``length`` bytes also start at another
    wanted position: neighbours in suffix order with a common prefix that long."""
    order = suffix_order(text, want, length)
    a, b = order[:-1], order[1:]
    words = np.ndarray((max(len(text) - 7, 0),), dtype=">u8", buffer=text.tobytes(), strides=(1,)) if len(text) >= 8 else np.zeros(0, ">u8")
    for d in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length > 8 else [])]:
        alive = words[a + d] == words[b + d]
        a, b = a[alive], b[alive]
    out = np.zeros(len(text), bool)
    out[a] = True
    out[b] = True
    return out


def _judge(rows: list[tuple], length: int) -> pa.RecordBatch:
    """(key, digest, size, spans) of the classes among rows (key, digest, size, places,
    text) that hold a repeat; spans as starts and ends within the class's text."""
    text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])])
    want = np.zeros(len(text), bool)
    for r, s in zip(rows, at[:-1], strict=True):
        want[s : s + r[2]] = True
    found = repeated(text, want, length)
    out = []
    for r, s in zip(rows, at[:-1], strict=True):
        mask = np.ones(r[2], bool) if r[3] > 1 else found[s : s + r[2]]
        if mask.any():
            d = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
            out.append((*r[:3], np.flatnonzero(d == 1).tolist(), (np.flatnonzero(d == -1) + length - 1).tolist()))
    cols = list(zip(*out, strict=True)) or [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["key", "digest", "size", "heads", "tails"])


_MARKS = "key long, digest long, size int, heads array<long>, tails array<long>"


def _sorted_marks(texts: DataFrame, length: int) -> DataFrame:
    """Marks of the classes (group, key, digest, size, places, text): suffix arrays over
    whole groups."""

    def run(batches):
        rows: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for group, *r in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if size >= BLOCK_BYTES and group != last:
                    yield _judge(rows, length)
                    rows, size = [], 0
                rows.append(tuple(r))
                size += len(r[4])
                last = group
        if rows:
            yield _judge(rows, length)

    return texts.select("group", "key", "digest", "size", "places", "text").repartition("group").sortWithinPartitions("group").mapInArrow(tidy(run), _MARKS)


def _class_texts(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """The classes (key, digest, size, places, doc, start) with the bytes they stand for."""
    own = classes.groupBy("doc").agg(F.collect_list(F.struct("start", "key", "digest", "size", "places", "hot")).alias("own"))
    near = maybe_in(docs, "doc", id_filter(classes, "doc"))

    def run(batches):
        for whole in batches:
            for k in range(whole.num_rows):
                batch = whole.slice(k, 1)
                text = (batch.column(0)[0].as_py() or "").encode("utf-8")
                items = batch.column(1)[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["key"] for x in items], pa.int64()),
                        pa.array([x["digest"] for x in items], pa.int64()),
                        pa.array([x["size"] for x in items], pa.int32()),
                        pa.array([x["places"] for x in items], pa.int64()),
                        pa.array([x["hot"] for x in items], pa.bool_()),
                        pa.array([text[x["start"] : x["start"] + x["size"] + length - 1] for x in items], pa.binary()),
                    ],
                    ["key", "digest", "size", "places", "hot", "text"],
                )

    return near.join(own, "doc").select("text", "own").mapInArrow(tidy(run), "key long, digest long, size int, places long, hot boolean, text binary")


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """The windows of hot classes in steps of their offset from the key's gram:
    (group, key, digest, size, places, text, up_key, up_digest, up_size, shift). Equal
    windows fall into equal groups, as a group is named by bytes they all hold."""

    def run(batches):
        for batch in batches:
            for key, digest, size, places, text in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                data = np.frombuffer(text, np.uint8)
                h = byte_hash()
                sums = h.sums(data)
                at = np.arange(len(data) - GRAM + 1)
                hashes = h.ranges(sums, at, at + GRAM)
                hit = np.flatnonzero(hashes == np.array([key], np.int64).view(np.uint64)[0])
                pos = np.arange(size)
                gram = hit[np.searchsorted(hit, pos)]  # leftmost in each window
                step = (gram - pos) // STEP
                head = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (step[1:] != step[:-1])]))
                tail = np.concatenate([head[1:], [size]])
                # the bytes that every window of the step holds
                core = gram[head] - step[head] * STEP
                name = mix(h.ranges(sums, core, core + length - STEP + 1) + step[head].astype(np.uint64))
                own = mix(h.ranges(sums, head, tail + length - 1) + (tail - head).astype(np.uint64))
                m = len(head)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(name)),
                        pa.array(signed(own)),
                        pa.array((tail - head).astype(np.int32)),
                        pa.array(np.full(m, places)),
                        pa.array([text[a : b + length - 1] for a, b in zip(head, tail, strict=True)], pa.binary()),
                        pa.array(np.full(m, key)),
                        pa.array(np.full(m, digest)),
                        pa.array(np.full(m, size, np.int32)),
                        pa.array(head.astype(np.int64)),
                    ],
                    ["key", "digest", "size", "places", "text", "up_key", "up_digest", "up_size", "shift"],
                )

    kinds = "key long, digest long, size int, places long, text binary, up_key long, up_digest long, up_size int, shift long"
    return texts.select("key", "digest", "size", "places", "text").mapInArrow(tidy(run), kinds)


def repeat_marks(spark: SparkSession, docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Marks (key, digest, size, heads, tails) of the classes of ``runs`` with repeats."""
    classes = stage(spark, runs.groupBy("key", "digest", "size").agg(F.count("*").alias("places"), F.min(F.struct("doc", "start")).alias("at"), F.max("again").alias("again")), "classes")
    keys = classes.groupBy("key").agg(F.sum("places").alias("all"), F.count("*").alias("kinds"), F.max("again").alias("again")).where("all > 1 OR again").select("key", (F.col("kinds") > CLASSES_PER_KEY).alias("hot"))
    wanted = stage(spark, classes.join(keys, "key").select("key", "digest", "size", "places", "at.doc", "at.start", "hot"), "wanted")
    texts = _class_texts(docs, wanted, length)
    hot = wanted.where("hot")
    if hot.isEmpty():
        return _sorted_marks(texts.withColumn("group", F.col("key")), length)
    plain = _sorted_marks(_class_texts(docs, wanted.where("NOT hot"), length).withColumn("group", F.col("key")), length)
    parts = stage(spark, _cut(_class_texts(docs, hot, length), length), "parts")
    same = parts.groupBy("key", "digest", "size").agg(F.sum("places").alias("places"), F.min("text").alias("text"))
    marks = _sorted_marks(same.withColumn("group", F.col("key")), length)
    up = parts.select("key", "digest", "size", "up_key", "up_digest", "up_size", "shift").join(marks, ["key", "digest", "size"])
    up = up.select("up_key", "up_digest", "up_size", F.transform("heads", lambda x: x + F.col("shift")).alias("heads"), F.transform("tails", lambda x: x + F.col("shift")).alias("tails"))
    up = up.groupBy("up_key", "up_digest", "up_size").agg(F.flatten(F.collect_list("heads")).alias("heads"), F.flatten(F.collect_list("tails")).alias("tails"))
    return plain.union(up.select(F.col("up_key").alias("key"), F.col("up_digest").alias("digest"), F.col("up_size").alias("size"), "heads", "tails"))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _passages(data: np.ndarray, at: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each row, the distinct hashes of LEAST words that are the smallest of their run of ``words`` words."""
    for grams, own in shingle_positions(data, at, PARTS):
        n = len(own) - LEAST + 1
        if len(own) < words:
            yield _NONE
            continue
        total = np.zeros(n, np.uint64)
        for d in range(0, LEAST, PARTS):
            total = mix(total * _U(0x9E3779B97F4A7C15) + grams[d : d + n])
        yield np.unique(_sliding_min(total, words - LEAST + 1))


def shared_passages(spark: SparkSession, docs: DataFrame, words: int) -> DataFrame:
    """Numbers (doc) of all documents that hold a run of ``words`` words of another one, A-Z lower-cased, by 64-bit
    hashes. Equal runs have the same smallest hash of LEAST words, so these alone are gathered; documents
    that share fewer words, but LEAST or more, may be among the found."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, at = text_views(batch.column(1))
            for i, j in passes(at):
                found = list(_passages(data[at[i] : at[j]], at[i : j + 1] - at[i], words))
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found))), pa.array(np.repeat(ids[i:j], [len(f) for f in found]).astype(np.int64))], ["passage", "doc"])

    found = stage(spark, docs.select("doc", "text").mapInArrow(tidy(run), "passage long, doc long"), "passages")
    held = found.groupBy("passage").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("passage")
    return stage(spark, found.join(held, "passage", "left_semi").select("doc").distinct(), "shared")


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 400, id: str = "doc_id", text: str = "text", words: int | None = None) -> DataFrame:
    """(doc, n_bytes, spans, kept) for every document: byte spans removed, as maximal
    [start, end) pairs, and the remaining bytes. ``words``: also ``shared``, true if another document holds a
    run of that many of its words, however few bytes these are (see ``shared_passages``); nothing is removed for that."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    if words is not None and words < LEAST:
        raise ValueError(f"words must be at least {LEAST}")
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    docs = stage(spark, docs.withColumn("doc", F.monotonically_increasing_id()), "docs")
    shared = shared_passages(spark, docs, words) if words is not None else None
    runs = stage(spark, window_runs(docs.select("doc", "text"), length), "runs")
    marks = stage(spark, repeat_marks(spark, docs, runs, length), "marks")
    places = runs.join(marks, ["key", "digest", "size"])
    spans = places.select("doc", F.transform("heads", lambda x: x + F.col("start")).alias("heads"), F.transform("tails", lambda x: x + F.col("start")).alias("tails"), F.lit(False).alias("shared"))
    if shared is not None:
        none = F.array().cast("array<long>")
        spans = spans.union(shared.select("doc", none, none, F.lit(True)))
    spans = stage(spark, spans.groupBy("doc").agg(F.flatten(F.collect_list("heads")).alias("heads"), F.flatten(F.collect_list("tails")).alias("tails"), F.max("shared").alias("shared")), "spans")

    bits = id_filter(spans, "doc")

    def untouched(batches):  # the others are joined with their spans
        held = np.frombuffer(bits, np.uint8)
        for whole in batches:
            for k in range(0, max(1, whole.num_rows), 64):
                batch = whole.slice(k, 64)
                batch = batch.filter(pa.array(~in_filter(held, batch.column(2).to_numpy())))
                none = [[]] * batch.num_rows
                yield _kept(batch, none, none, [False] * batch.num_rows)

    def cut(batches):
        for whole in batches:
            for k in range(0, max(1, whole.num_rows), 64):
                batch = whole.slice(k, 64)
                yield _kept(batch, *(batch.column(i).to_pylist() for i in (2, 3, 4)))

    kinds = "doc long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary, shared boolean"
    clean = docs.select("id", "text", slot("doc").alias("slot")).mapInArrow(tidy(untouched), kinds)
    hit = maybe_in(docs, "doc", bits).join(spans, "doc", "left").select("id", "text", "heads", "tails", "shared").mapInArrow(tidy(cut), kinds)
    out = clean.union(hit)
    return out if words is not None else out.drop("shared")


def _kept(batch: pa.RecordBatch, heads: list, tails: list, shared: list) -> pa.RecordBatch:
    """(doc, n_bytes, spans, kept, shared) of rows (id, text, ...), their raw spans and marks."""
    n, found, kept = [], [], []
    for t, h, e in zip(batch.column(1).to_pylist(), heads, tails, strict=True):
        raw = (t or "").encode("utf-8")
        own = _merge(list(zip(h or [], e or [], strict=True)))
        edges = [0, *[x for s in own for x in s], len(raw)]
        n.append(len(raw))
        found.append([{"start": a, "end": b} for a, b in own])
        kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
    spans = pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), spans, pa.array(kept, pa.binary()), pa.array([x is True for x in shared], pa.bool_())], ["doc", "n_bytes", "spans", "kept", "shared"])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark, table(spark, sf_dir, "documents"), words=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return out.select(F.col("doc").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("removed"), F.col("shared").alias("shares_passage"))
