"""Toxicity scores by a counterfactually regularised linear classifier.

Features are present or absent in a text: its words (lower-cased runs of a-z, 0-9 and
all bytes above 127), and their beginnings and ends of 3 to 8 bytes, as 64-bit hashes.
Those most tied to label 1 are kept: of the features of toxic sample texts, the
FEATURES with the largest log-likelihood gain over the other sample texts.

Training minimises the logistic loss over the sample plus a penalty on every text that
mentions an identity term: the same text with the term swapped for each of a few others
of its kind should get the same score. A group's name then gains no weight of its own,
and neutral mentions of a group are not taken for attacks on it.

The sample is bounded: SAMPLE labelled documents of each class, the first by hash. The
classes are weighted back to their shares, so scores are probabilities. All documents
are scored, by whole texts, in one narrow pass.

Null and empty texts get the score of a text without features. Label rows that repeat a
document count once, with the largest label; null labels count not at all. Without any
label 1, or without label 0, the score is the same for all. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import byte_hash, parts, passes, signed, stage, table, text_views, tidy, word_spans

#: Labelled documents of each class that training reads at most.
SAMPLE = 4000
FEATURES = 3000
LEAST_TEXTS = 3
LEAST_GAIN = 10.0
PENALTY = 1.0
_SIDES = range(3, 9)
_FILTER_BITS = 20
#: Words whose features are hashed at a time.
_WORDS = 1 << 15
_U = np.uint64

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Terms that name groups of people, by kind; terms of a kind are swapped
# for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("africans", "europeans", "asians", "americans", "arabs"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("elderly", "young", "old"),
    ("blind", "deaf", "disabled", "autistic"),
    ("mujeres", "hombres"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
)


def _hashes(words: list[str]) -> list[int]:
    data = np.frombuffer(" ".join(words).encode("utf-8"), np.uint8)
    return word_spans(data, np.array([0, len(data)]), _GAP)[0].tolist() if words else []


def _part_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of words and of their ends, one row per word, 0 where a word is too short.
    A word, a beginning and an end of equal bytes are different features."""
    h = byte_hash()
    sums = h.sums(_LOWER[data])
    out = np.zeros((len(words), 1 + 2 * len(_SIDES)), np.uint64)
    out[:, 0] = words
    for k, n in enumerate(_SIDES):
        long = ends - starts > n
        out[long, 1 + 2 * k] = h.ranges(sums, starts[long], starts[long] + n) * _U(3)
        out[long, 2 + 2 * k] = h.ranges(sums, ends[long] - n, ends[long]) * _U(5)
    return out


class Features:
    """The hashes of a text's features, or which of a chosen set it has."""

    def __init__(self, chosen: np.ndarray | None = None):
        self.chosen = chosen
        if chosen is not None:
            self.sorted = np.sort(chosen.view(np.uint64))
            self.order = np.argsort(chosen.view(np.uint64), kind="stable")
            self.filter = np.zeros(1 << _FILTER_BITS, bool)
            self.filter[self.sorted >> _U(64 - _FILTER_BITS)] = True

    def rows(self, data: np.ndarray, at: np.ndarray):
        """For each row, the sorted distinct features: hashes, or places in the chosen
        set; and with a chosen set, nothing else is kept in memory. Long rows are read
        in parts."""
        for i, j in passes(at):
            lo = int(at[i])
            part, own = data[lo : at[j]], at[i : j + 1] - lo
            words, starts, ends, first = word_spans(part, own, _GAP)
            found, where = [], []
            for a in range(0, len(words), _WORDS):
                b = min(a + _WORDS, len(words))
                base, top = int(starts[a]), int(ends[b - 1])
                hashes = _part_hashes(part[base:top], starts[a:b] - base, ends[a:b] - base, words[a:b])
                row = np.repeat(np.searchsorted(first, np.arange(a, b), side="right") - 1, hashes.shape[1])
                flat = hashes.ravel()
                keep = flat != 0
                if self.chosen is not None:
                    keep &= self.filter[flat >> _U(64 - _FILTER_BITS)]
                flat, row = flat[keep], row[keep]
                if self.chosen is not None:
                    spot = np.minimum(np.searchsorted(self.sorted, flat), len(self.sorted) - 1)
                    keep = self.sorted[spot] == flat if len(self.sorted) else np.zeros(len(flat), bool)
                    flat, row = self.order[spot[keep]].astype(np.uint64), row[keep]
                found.append(flat)
                where.append(row)
            flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
            row = np.concatenate(where) if where else np.zeros(0, np.int64)
            cuts = np.searchsorted(row, np.arange(j - i + 1))
            for r in range(j - i):
                yield np.unique(flat[cuts[r] : cuts[r + 1]])


def _sums(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _counts(sample: DataFrame, chosen: np.ndarray | None = None) -> DataFrame:
    """(feature, texts): in how many sample texts each feature stands."""

    def run(batches):
        features = Features(chosen)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            data, at = text_views(batch.column(0))
            for f in features.rows(data, at):
                held.append(f if chosen is None else chosen.view(np.uint64)[f.astype(np.int64)])
                size += len(f)
                if size > 4_000_000:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    def _batch(held):
        k, n = _sums(held)
        return pa.RecordBatch.from_arrays([pa.array(signed(k)), pa.array(n.astype(np.int64))], ["feature", "texts"])

    return sample.select("text").mapInArrow(tidy(run), "feature long, texts long").groupBy("feature").agg(F.sum("texts").alias("texts"))


def _vectors(sample: DataFrame, chosen: np.ndarray) -> list:
    """(label, places of the text's chosen features, identity words in it) of the sample."""
    kinds = {h: k for k, words in enumerate(IDENTITY_TERMS) for h in _hashes(list(words))}

    def run(batches):
        features = Features(chosen)
        named = np.sort(np.array(list(kinds), np.uint64))
        for batch in parts(batches):
            data, at = text_views(batch.column(1))
            words, _, _, own = word_spans(data, at, _GAP)
            hit = np.flatnonzero(named[np.minimum(np.searchsorted(named, words), len(named) - 1)] == words)
            row = np.searchsorted(own, hit, side="right") - 1
            terms = [np.unique(words[hit[row == r]]) for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f.astype(np.int32) for f in features.rows(data, at)], pa.list_(pa.int32())),
                    pa.array([signed(t) for t in terms], pa.list_(pa.int64())),
                ],
                ["label", "places", "terms"],
            )

    return sample.select("label", "text").mapInArrow(tidy(run), "label int, places array<int>, terms array<long>").collect()


def _sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the entries of 0/1 vectors."""
    sizes = [len(r) for r in rows]
    return np.repeat(np.arange(len(rows)), sizes), (np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64))


def fit(labels: np.ndarray, weights: np.ndarray, rows: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]], size: int, penalty: float = PENALTY, steps: int = 300) -> np.ndarray:
    """Weights (the last one for every text). pairs: entries that a swap takes away and
    brings, whose scores should be equal."""
    row, place = _sparse(rows)
    gone, come = [_sparse([np.asarray(p[k]) for p in pairs]) for k in (0, 1)]
    w = np.zeros(size + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    n = weights.sum()
    share = float((weights * labels).sum() / n)
    w[-1] = np.log(share / (1 - share))
    for t in range(1, steps + 1):
        z = np.bincount(row, w[place], minlength=len(rows)) + w[-1]
        err = weights * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / n
        g = np.zeros_like(w)
        g[:-1] = np.bincount(place, err[row], minlength=size) + 1e-4 * w[:-1]
        g[-1] = err.sum()
        if pairs:
            gap = np.bincount(gone[0], w[gone[1]], minlength=len(pairs)) - np.bincount(come[0], w[come[1]], minlength=len(pairs))
            pull = 2 * penalty * gap / len(pairs)
            g[:-1] += np.bincount(gone[1], pull[gone[0]], minlength=size) - np.bincount(come[1], pull[come[0]], minlength=size)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


class Model:
    """Chosen features (hashes) and weights, the last one for every text."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray):
        self.chosen, self.weights = chosen, weights

    def scores(self, column: pa.Array) -> np.ndarray:
        data, at = text_views(column)
        out = [self.weights[f.astype(np.int64)].sum() for f in Features(self.chosen).rows(data, at)]
        return 1 / (1 + np.exp(-np.clip(np.array(out, np.float64) + self.weights[-1], -40, 40)))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled documents given (leave out what is held out)."""
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    marks = labels.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{label}`").cast("int").alias("label")).where("doc IS NOT NULL AND label IS NOT NULL")
    marks = marks.groupBy("doc").agg(F.max("label").alias("label"))
    totals = {int(r["label"] == 1): r["count"] for r in marks.select((F.col("label") == 1).cast("int").alias("label")).groupBy("label").count().collect()}
    if not totals.get(0) or not totals.get(1):
        share = 0.5 if not totals else float(bool(totals.get(1)))
        return Model(np.zeros(0, np.int64), np.array([np.log((share + 0.01) / (1.01 - share))]))
    some = [marks.where(f"(label = 1) = {k}").orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE) for k in ("true", "false")]
    # bounded: at most SAMPLE ids of each class
    few = F.broadcast(some[0].union(some[1]))
    sample = stage(spark, docs.join(few, "doc").select("doc", (F.col("label") == 1).cast("int").alias("label"), "text"), "labelled")
    toxic, other = sample.where("label = 1"), sample.where("label = 0")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Model(np.zeros(0, np.int64), np.array([np.log((totals[1] + 1) / (totals[0] + 1))]))

    often = _counts(toxic).where(F.col("texts") >= LEAST_TEXTS).orderBy(F.desc("texts"), "feature").limit(50 * FEATURES).toArrow()
    feature, hits = often.column(0).to_numpy(), often.column(1).to_numpy()
    else_ = _counts(other, np.ascontiguousarray(feature)).toArrow()
    order = np.argsort(feature, kind="stable")
    rest = np.zeros(len(feature), np.int64)
    if else_.num_rows:
        rest[order[np.searchsorted(feature[order], else_.column(0).to_numpy())]] = else_.column(1).to_numpy()
    gain = hits * np.log(((hits + 0.5) / sizes[1]) / ((rest + 0.5) / sizes[0]))
    best = np.lexsort((feature, -gain))[:FEATURES]
    chosen = np.ascontiguousarray(feature[best[gain[best] >= LEAST_GAIN]])

    rows = _vectors(sample, chosen)
    rows.sort(key=lambda r: (r["label"], r["places"], r["terms"]))
    y = np.array([r["label"] for r in rows], np.float64)
    weights = np.where(y == 1, totals[1] / sizes[1], totals[0] / sizes[0])
    return Model(chosen, fit(y, weights, [np.array(r["places"], np.int64) for r in rows], _swaps(rows, chosen), len(chosen)))


def _swaps(rows: list, chosen: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every identity term in a text and every other of its kind, the chosen features
    that the swap takes away and brings."""
    features = Features(chosen)

    def places(word: str) -> np.ndarray:
        data = np.frombuffer(word.encode("utf-8"), np.uint8)
        return next(iter(features.rows(data, np.array([0, len(data)])))).astype(np.int64)

    kind, own = {}, {}
    for words in IDENTITY_TERMS:
        for word, h in zip(words, _hashes(list(words)), strict=True):
            kind[h], own[h] = words, word
    out = []
    for r in rows:
        for t in r["terms"]:
            h = t % (1 << 64)
            for other in kind[h]:
                if other != own[h]:
                    out.append((places(own[h]), places(other)))
    return out


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, score) for every document."""

    def run(batches):
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(batch.column(1)))], ["doc", "score"])

    return docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(tidy(run), "doc long, score double")


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    column = docs.columns.index(text)

    def run(batches):
        for batch in parts(batches):
            yield batch.filter(pa.array(model.scores(batch.column(column)) < threshold))

    return docs.mapInArrow(tidy(run), docs.schema)


def held_out(id: str = "doc_id"):
    """The fold that training leaves out: crc32 of the id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.col(id).cast("string")), F.lit(5)) == 0


def model_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return train(spark, docs, table(spark, sf_dir, "labels").where(~held_out()))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, model_of(spark, docs, sf_dir)).withColumnRenamed("doc", "doc_id")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
