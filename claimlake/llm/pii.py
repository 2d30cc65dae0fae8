"""Personal data: fixed patterns for e-mail addresses, IP addresses, card and phone
numbers, and a character tagger that finds what they miss.

The tagger is a bidirectional LSTM with CRF transitions (``crf``), trained here: labelled
windows are cut around the patterns' matches, around other places with digits or "@",
and are varied (a phone number without its country code, a card number with dots, an
address with an accented name), so that it learns the look of the kinds beyond the
patterns. Training takes a bounded sample of windows, TRAIN_WINDOWS of each sort by
order of a hash; everything else covers all texts.

Detection: none of the kinds can do without a digit or "@", so the tagger reads the
surroundings of all of these, in windows of WINDOW characters that overlap by half. Each
window is decoded by Viterbi; spans that a window's edge cuts are left to its
neighbour. Over a whole text the spans found are reconciled by choosing the
non-overlapping set of the largest total posterior. The tagger's spans must look like
their kind (digits, Luhn sum, parts) and not touch a pattern's match; matches stay.

Null counts as empty. Texts may have any length: windows are handled in batches.
Positions are code points. Other columns keep out of the way, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import parts, passes, small_batches, table, text_views, tidy
from claimlake.llm.crf import Tagger, codes

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
#: Windows of each sort (four kinds, other places) that training reads at most.
TRAIN_WINDOWS = 400
TRAIN_STEPS = 300
#: Least posterior, over a span's characters, of what the tagger adds.
SURE = 0.8

# The patterns of the kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")  # no rescans of long runs
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SITE = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def _part(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) < 4 and int(p or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The patterns' matches, leftmost and not overlapping within a kind."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, 0, end))
            at = text.find("@", end)
        else:
            end = at + 1  # nothing before this sign can be a name for a later one
            at = text.find("@", end)
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(map(_part, four)):
                out.append((at, 1, at + size))
            at += size + 1
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def windows(text: str) -> list[int]:
    """Starts of the windows over the surroundings of digits and "@"."""
    out: list[int] = []
    half = WINDOW // 2
    for m in _SITE.finditer(text):
        for s in (((m.start() // half) - 1) * half, (m.start() // half) * half):
            if s >= 0 and (not out or s > out[-1]):
                out.append(s)
    return out


def _labelled(text: str, spans: list[Span], start: int) -> np.ndarray:
    """Tags 0 (none), 2k + 1 (first of kind k), 2k + 2 (inside) of a window."""
    y = np.zeros(WINDOW, np.int8)
    for a, kind, b in spans:
        lo, hi = max(a, start), min(b, start + WINDOW)
        if lo < hi:
            y[lo - start : hi - start] = 2 * kind + 2
            if a >= start:
                y[a - start] = 2 * kind + 1
    return y


def _varied(text: str, span: Span, pick: int) -> tuple[str, Span]:
    """A text with the span written another way."""
    a, kind, b = span
    s = text[a:b]
    if kind == 0:
        at = s.index("@")
        name = s[:at]
        s = (name[:-1] + "éüñ"[pick % 3] if pick % 2 else "é" + name) + s[at:]
    elif kind == 2:
        d = _digits(s)
        s = ("." if pick % 2 else "  ").join(d[i : i + 4] for i in range(0, len(d), 4))
    elif kind == 3:
        s = s.split(" ", 1)[1] if " " in s and len(_digits(s.split(" ", 1)[1])) >= 9 else s[1:]
    return text[:a] + s + text[b:], (a, kind, a + len(s))


def _examples(text: str, key: int) -> Iterator[tuple[int, int, str, bytes]]:
    """(sort, order, window text, tags): training windows of a text. At most two of each
    sort, so that a long text does not fill the sample."""
    spans = base_spans(text)
    sites = [m.start() for m in _SITE.finditer(text)]
    seen = [0] * (len(KINDS) + 1)
    order = lambda k: int.from_bytes(hashlib.blake2b(f"{key}:{k}".encode(), digest_size=7).digest(), "big")
    for a, kind, b in spans:
        if seen[kind] == 2:
            continue
        seen[kind] += 1
        pick = order(a)
        t, own = text, list(spans)
        if pick % 3 == 0:
            t, new = _varied(text, (a, kind, b), pick // 3)
            shift = new[2] - b
            own = [new if x == (a, kind, b) else x if x[2] <= a else (x[0] + shift, x[1], x[2] + shift) for x in spans if x == (a, kind, b) or x[2] <= a or x[0] >= b]
        start = max(0, a - pick // 7 % 40)
        yield kind, pick, t[start : start + WINDOW], _labelled(t, own, start).tobytes()
    for site in sites:
        if seen[-1] == 2:
            break
        if not any(a - WINDOW < site < b + WINDOW for a, _, b in spans):
            seen[-1] += 1
            pick = order(site)
            start = max(0, site - pick // 7 % 40)
            yield len(KINDS), pick, text[start : start + WINDOW], _labelled(text, spans, start).tobytes()


def _with_sites(batch: pa.RecordBatch, column: int) -> list[int]:
    """Rows whose text holds an ASCII digit or "@"."""
    data, at = text_views(batch.column(column))
    out: list[int] = []
    for i, j in passes(at):
        part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
        found = np.flatnonzero(((part >= 48) & (part < 58)) | (part == 64))
        out += (i + np.flatnonzero(np.diff(np.searchsorted(found, own)))).tolist()
    return out


def train(docs: DataFrame, id: str = "doc_id", text: str = "text") -> Tagger:
    """A tagger fitted to windows of these documents; without any match it is left
    untrained and adds nothing."""
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        best: list[list[tuple]] = [[] for _ in range(len(KINDS) + 1)]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for r in _with_sites(batch, 1):
                for sort, order, window, tags in _examples(batch.column(1)[r].as_py(), ids[r] or 0):
                    best[sort].append((order, window, tags))
                    if len(best[sort]) > 4 * TRAIN_WINDOWS:
                        best[sort] = sorted(best[sort])[:TRAIN_WINDOWS]
        rows = [(s, *x) for s, own in enumerate(best) for x in sorted(own)[:TRAIN_WINDOWS]]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int32(), pa.int64(), pa.string(), pa.binary()], strict=True)], ["sort", "place", "win", "tags"])

    found = docs.mapInArrow(tidy(run), "sort int, place long, win string, tags binary")
    ranked = found.selectExpr("*", "row_number() OVER (PARTITION BY sort ORDER BY place, win) AS rank").where(F.col("rank") <= TRAIN_WINDOWS)
    with small_batches(docs.sparkSession):
        rows = ranked.collect()  # TRAIN_WINDOWS of each sort at most
    rows = sorted(rows, key=lambda r: (r["sort"], r["place"], r["win"]))
    tagger = Tagger(2 * len(KINDS) + 1)
    if any(r["sort"] < len(KINDS) for r in rows):
        x = np.zeros((len(rows), WINDOW), np.uint8)
        for k, r in enumerate(rows):
            c = codes(r["win"])
            x[k, : len(c)] = c
        tagger.fit(x, np.stack([np.frombuffer(r["tags"], np.int8) for r in rows]).astype(np.int64), TRAIN_STEPS)
    else:
        tagger.p["bias"][0] = 1e3
    return tagger


def _plausible(kind: int, s: str) -> bool:
    digits = _digits(s)
    if kind == 0:
        name, _, host = s.rpartition("@")
        return bool(name) and "." in host.strip(".") and not re.search(r"\s", s)
    if kind == 1:
        parts = s.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _part(p) for p in parts)
    if re.search(r"[^0-9\s().+/-]", s):
        return False
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(re.search(r"[()\s.+-]", s))


def _reconciled(spans: list[tuple[int, int, int, float]]) -> list[Span]:
    """The non-overlapping spans (start, kind, end, weight) of the largest total weight."""
    spans = sorted(set(spans), key=lambda s: (s[2], s[0], s[1]))
    ends = [s[2] for s in spans]
    best = [0.0]
    link: list[int] = []
    for k, (a, _, _, w) in enumerate(spans):
        before = int(np.searchsorted(ends, a, side="right"))
        before = min(before, k)
        link.append(before if best[before] + w > best[k] else -1)
        best.append(max(best[k], best[before] + w))
    out, k = [], len(spans)
    while k:
        if link[k - 1] >= 0:
            out.append(spans[k - 1][:3])
            k = link[k - 1]
        else:
            k -= 1
    return sorted(out)


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """What the tagger finds in each text, whole texts, reconciled; not yet checked
    against the patterns."""
    where = [(r, s) for r, t in enumerate(texts) for s in windows(t)]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    for k in range(0, len(where), 2048):
        part = where[k : k + 2048]
        x = np.zeros((len(part), WINDOW), np.uint8)
        for q, (r, s) in enumerate(part):
            c = codes(texts[r][s : s + WINDOW])
            x[q, : len(c)] = c
        tags, sure = tagger.decode(x)
        for q in np.flatnonzero(tags.any(axis=1)).tolist():
            r, s = part[q]
            y = tags[q].tolist()
            a = 0
            while a < WINDOW:
                if not y[a]:
                    a += 1
                    continue
                kind, b = (y[a] - 1) // 2, a + 1
                while b < WINDOW and y[b] == 2 * kind + 2:
                    b += 1
                cut = (b == WINDOW and s + WINDOW < len(texts[r])) or (y[a] % 2 == 0)
                p = float(sure[q, a:b].min())
                if not cut and p >= SURE and s + b <= len(texts[r]):
                    found[r].append((s + a, kind, s + b, p))
                a = b
    return [_reconciled(x) for x in found]


def all_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(pattern matches, matches and the tagger's spans) of each text."""
    out = []
    for t, extra in zip(texts, tagged_spans(tagger, texts), strict=True):
        base = base_spans(t)
        more = [s for s in extra if _plausible(s[1], t[s[0] : s[2]]) and not any(a < s[2] and s[0] < b for a, _, b in base)]
        out.append((base, sorted(base + more)))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, tagger: Tagger, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, base, spans) for every document: arrays of (kind, start, end)."""
    docs = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in parts(batches):
            base: list[list] = [[] for _ in range(batch.num_rows)]
            every: list[list] = [[] for _ in range(batch.num_rows)]
            rows = _with_sites(batch, 1)
            for k in range(0, len(rows), 64):
                part = rows[k : k + 64]
                for r, (b, s) in zip(part, all_spans(tagger, [batch.column(1)[r].as_py() for r in part]), strict=True):
                    base[r] = [{"kind": KINDS[x[1]], "start": x[0], "end": x[2]} for x in b]
                    every[r] = [{"kind": KINDS[x[1]], "start": x[0], "end": x[2]} for x in s]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(every, kind)], ["doc", "base", "spans"])

    return docs.mapInArrow(tidy(run), "doc long, base array<struct<kind: string, start: long, end: long>>, spans array<struct<kind: string, start: long, end: long>>")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the first's kind
    in brackets."""
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """The documents with their personal data replaced; all columns stay."""
    column = docs.columns.index(text)

    def run(batches):
        for batch in parts(batches):
            new = batch.column(column).to_pylist()
            rows = _with_sites(batch, column)
            for k in range(0, len(rows), 64):
                part = rows[k : k + 64]
                for r, (_, s) in zip(part, all_spans(tagger, [new[r] for r in part]), strict=True):
                    new[r] = masked(new[r], s)
            cols = list(batch.columns)
            cols[column] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return docs.mapInArrow(tidy(run), docs.schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs))
    text = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in KINDS]
    return found.select(F.col("doc").alias("doc_id"), *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
