"""Language identification of mixed texts.

Words are runs of letters (a-z and all bytes above 127). A word's script, read off its
UTF-8 bytes by fixed ranges, narrows the candidates to the languages that were seen in
that script. Each candidate scores the word by its byte trigrams (the word's ends
count) and by the whole word, as log probabilities from counts over all training
documents. Viterbi then labels the words of a whole text, with a penalty for every
switch, so that short foreign words do not break a span. Texts are cut into segments of
SEGMENT words that are solved side by side and joined exactly (each segment's best path
for every first and last label).

A document's language is the one that labels most of its letters (bytes), ties to the
first in order; its score is that language's share of them.

Counts are kept in tables of fixed size, by hash, one column per language.

Null texts and texts without a letter are ``und`` with score 0. Without training
documents every other text is ``und`` too. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import passes, small_batches, table, text_views, tidy, word_spans

UNDETERMINED = "und"
TRIGRAM_BITS = 16
WORD_BITS = 17
#: Cost of a switch, in natural log units.
SWITCH = 12.0
SEGMENT = 128
#: Least share of a language's words for a script to count as its own.
SCRIPT_SHARE = 0.001
_PARTS = 16
_U = np.uint64

_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Scripts by the first byte of a UTF-8 letter; 0 is Latin, for a-z, its
# extensions and bytes inside a letter.
SCRIPT_RANGES = (
    (0xCD, 0xCF, 1),  # Greek
    (0xD0, 0xD4, 2),  # Cyrillic
    (0xD5, 0xD5, 3),  # Armenian
    (0xD6, 0xD7, 4),  # Hebrew
    (0xD8, 0xDF, 5),  # Arabic and neighbours
    (0xE0, 0xE0, 6),  # Indic
    (0xE1, 0xE1, 7),  # Georgian, Ethiopic and others
    (0xE3, 0xE9, 8),  # Kana and ideographs
    (0xEA, 0xED, 9),  # Hangul
    (0xEE, 0xF7, 10),  # the rest
)
_SCRIPT = np.zeros(256, np.uint8)
for _a, _b, _s in SCRIPT_RANGES:
    _SCRIPT[_a : _b + 1] = _s
_SCRIPTS = 11


class Words:
    """The words of some rows, with their trigram and word buckets and scripts."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.hashes, self.starts, self.ends, self.own = word_spans(data, at, _GAP)
        plain = np.where(_GAP[data], np.uint8(32), _LOWER[data]).astype(np.uint32)
        inside = ~_GAP[data]
        edge = np.concatenate([[32], plain, [32]]).astype(np.uint32)
        left, right = edge[:-2].copy(), edge[2:].copy()
        left[self.starts], right[self.ends - 1] = 32, 32  # rows touch without a gap
        grams = (left << 16 | plain << 8 | right) * np.uint32(0x9E3779B1)
        self.grams = (grams >> np.uint32(32 - TRIGRAM_BITS))[inside].astype(np.int64)
        self.sizes = self.ends - self.starts
        self.heads = np.cumsum(self.sizes) - self.sizes  # words' places among the grams
        self.buckets = (self.hashes >> _U(64 - WORD_BITS)).astype(np.int64)
        self.scripts = np.maximum.reduceat(_SCRIPT[data[inside]], self.heads) if len(self.heads) else np.zeros(0, np.uint8)


def _parts(data: np.ndarray, at: np.ndarray):
    """Words of row ranges; a row that is long by itself comes in parts cut between
    words, to be put together by its row number."""
    for i, j in passes(at):
        lo = int(at[i])
        yield i, Words(data[lo : at[j]], at[i : j + 1] - lo), lo


class Model:
    """langs, log probabilities of trigram and word buckets, scripts' languages."""

    def __init__(self, langs: list[str], grams: np.ndarray, words: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        self.grams = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * len(grams))).astype(np.float32)
        self.words = np.log((words + 0.05) / (words.sum(axis=0) + 0.05 * len(words))).astype(np.float32)
        own = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0))
        own[~own.any(axis=1)] = True
        self.barred = np.where(own, 0, -1e6).astype(np.float32)

    def word_scores(self, w: Words) -> np.ndarray:
        """Rows of words by languages; the best of a row is 0."""
        s = np.add.reduceat(self.grams[w.grams], w.heads, axis=0) + self.words[w.buckets] if len(w.heads) else np.zeros((0, len(self.langs)), np.float32)
        s = s + self.barred[w.scripts]
        return s - s.max(axis=1, keepdims=True) if len(s) else s

    def labels(self, scores: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Viterbi labels of the words of each row (rows' offsets: own)."""
        n, k = scores.shape
        counts = np.diff(own)
        segments = -(-counts // SEGMENT)
        first = np.concatenate([[0], np.cumsum(segments)])
        total = int(first[-1])
        if not total:
            return np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(counts)), segments)
        nth = np.arange(total) - first[row]
        begin = own[row] + nth * SEGMENT
        size = np.minimum(SEGMENT, own[row + 1] - begin)
        place = begin[:, None] + np.arange(SEGMENT)
        inside = np.arange(SEGMENT) < size[:, None]
        s = np.where(inside[:, :, None], scores[np.where(inside, place, 0)], 0).astype(np.float32)

        # best path through a segment from each first to each last label
        through = np.where(np.eye(k, dtype=bool), s[:, 0, None, :], np.float32(-1e9))
        for t in range(1, SEGMENT):
            through = np.maximum(through, through.max(axis=2, keepdims=True) - np.float32(SWITCH)) + s[:, t, None, :]
        into = np.zeros((total, k), np.float32)
        out = np.zeros((total, k), np.float32)
        for q in range(int(segments.max())):
            now = first[:-1][segments > q] + q
            if q:
                before = out[now - 1]
                into[now] = np.maximum(before, before.max(axis=1, keepdims=True) - np.float32(SWITCH))
            out[now] = (into[now][:, :, None] + through[now]).max(axis=1)

        # the label before each word, for each label of the word
        kind = np.int8 if k < 128 else np.int32
        prior = np.zeros((SEGMENT, total, k), kind)
        v = into + s[:, 0]
        same = np.arange(k, dtype=kind)
        for t in range(1, SEGMENT):
            best = v.argmax(axis=1)
            top = v[np.arange(total), best][:, None] - np.float32(SWITCH)
            prior[t] = np.where(v >= top, same, best[:, None].astype(kind))
            v = np.maximum(v, top) + s[:, t]
        path = np.zeros((SEGMENT, total, k), kind)
        path[-1] = same
        for t in range(SEGMENT - 1, 0, -1):
            path[t - 1] = np.take_along_axis(prior[t], path[t].astype(np.int64), axis=1)
        last = v.argmax(axis=1)
        for q in range(int(segments.max()) - 2, -1, -1):
            now = first[:-1][segments > q + 1] + q
            head = path[0, now + 1, last[now + 1]].astype(np.int64)
            best = out[now].argmax(axis=1)
            stay = out[now, head] >= out[now, best] - np.float32(SWITCH)
            last[now] = np.where(stay, head, best)
        chosen = path[:, np.arange(total), last].T
        labels = np.zeros(n, np.int64)
        labels[place[inside]] = chosen[inside]
        return labels


def train(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model of all documents given that have a language; None without any."""
    docs = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    langs = sorted(r["lang"] for r in docs.select("lang").distinct().collect())  # a label set, not rows
    if not langs:
        return None
    k = len(langs)
    sizes = [(1 << TRIGRAM_BITS) * k, (1 << WORD_BITS) * k, _SCRIPTS * k]
    size = sum(sizes)
    part = -(-size // _PARTS)

    def count(batches):
        total = np.zeros(part * _PARTS, np.int64)
        number = {x: i for i, x in enumerate(langs)}
        for batch in batches:
            own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            data, at = text_views(batch.column(1))
            for i, w, _ in _parts(data, at):
                c = own[i + np.repeat(np.arange(len(w.own) - 1), np.diff(w.own))]
                for keys, col, off, m in (
                    (w.grams, np.repeat(c, w.sizes), 0, sizes[0]),
                    (w.buckets, c, sizes[0], sizes[1]),
                    (w.scripts.astype(np.int64), c, sizes[0] + sizes[1], sizes[2]),
                ):
                    total[off : off + m] += np.bincount(keys * k + col, minlength=m)
        yield _batch({q: total[q * part : (q + 1) * part] for q in range(_PARTS)})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for q, c in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[q] = sums.get(q, 0) + np.frombuffer(c.as_buffer(), np.int64)
        yield _batch(sums)

    def _batch(sums):
        return pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])

    kinds = "part int, counts binary"
    total = np.zeros(part * _PARTS, np.int64)
    with small_batches(spark):  # _PARTS rows, 8 bytes a cell in all
        rows = docs.mapInArrow(tidy(count), kinds).repartition(_PARTS, "part").mapInArrow(tidy(add), kinds).collect()
    for r in rows:
        total[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["counts"], np.int64)
    a, b = sizes[0], sizes[0] + sizes[1]
    return Model(langs, total[:a].reshape(-1, k), total[a:b].reshape(-1, k), total[b:size].reshape(-1, k))


def _identified(batch: pa.RecordBatch, model: Model, spans: bool) -> tuple[list, list, list]:
    """(languages, scores, spans) of a batch with the text in its second column."""
    n = batch.num_rows
    lang, share, found = [UNDETERMINED] * n, [0.0] * n, [[] for _ in range(n)]
    data, at = text_views(batch.column(1))
    for i, w, lo in _parts(data, at):
        labels = model.labels(model.word_scores(w), w.own)
        k = len(model.langs)
        row = np.repeat(np.arange(len(w.own) - 1), np.diff(w.own))
        letters = np.bincount(row * k + labels, w.sizes, minlength=(len(w.own) - 1) * k).reshape(-1, k)
        plain = np.concatenate([[0], np.cumsum(data[lo : at[i + len(w.own) - 1]] < 128)])
        for r in np.flatnonzero(letters.sum(axis=1) > 0).tolist():
            a, b = int(at[i + r] - lo), int(at[i + r + 1] - lo)
            own = slice(int(w.own[r]), int(w.own[r + 1]))
            if plain[b] - plain[a] == 0 or not (data[lo + w.starts[own]] < 128).any():
                if not any(c.isalpha() for c in batch.column(1)[i + r].as_py()):
                    continue  # signs above 127, but no letter
            best = int(letters[r].argmax())
            lang[i + r], share[i + r] = model.langs[best], float(letters[r, best] / letters[r].sum())
            if spans:
                y = labels[own]
                cuts = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]])).tolist()
                s, e = w.starts[own], w.ends[own]
                code = np.concatenate([[0], np.cumsum((data[lo + a : lo + b] & 0xC0) != 0x80)])
                for p, q in zip(cuts, [*cuts[1:], len(y)], strict=True):
                    found[i + r].append({"lang": model.langs[int(y[p])], "start": int(code[s[p] - a]), "end": int(code[e[q - 1] - a])})
    return lang, share, found


def identify(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text", spans: bool = True) -> DataFrame:
    """(doc, lang, score) for every document, and ``spans``: (lang, start, end) of its runs
    of one language, in code points."""
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            lang, share, found = _identified(batch, model, spans) if model else ([UNDETERMINED] * n, [0.0] * n, [[]] * n)
            cols = [batch.column(0), pa.array(lang, pa.string()), pa.array(share, pa.float64())]
            names = ["doc", "lang", "score"]
            if spans:
                cols.append(pa.array(found, kind))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(tidy(run), "doc long, lang string, score double" + ", spans array<struct<lang: string, start: long, end: long>>" * spans)


def held_out(id: str = "doc_id"):
    """The fold that training leaves out: crc32 of the id as text, modulo 4, is 2."""
    return F.pmod(F.crc32(F.col(id).cast("string")), F.lit(4)) == 2


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(spark, docs.where(~held_out())), spans=False).withColumnRenamed("doc", "doc_id")
    return found.select("doc_id", held_out().alias("held_out"), F.col("lang").alias("lang_pred"), "score")
