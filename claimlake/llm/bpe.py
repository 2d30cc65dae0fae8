"""BPE encoding and decoding with a vocabulary file of the ``tokenizers`` format.

Encoding finds, with one Aho-Corasick pass over a word, the longest token that
starts at each byte, and walks the word left to right. A token is appended only
if it may stand beside its predecessor, that is if merging the two tokens' bytes
by rank would again give these two; the pair table remembers each answer. Where
no token fits, the last one is taken back and shortened. A token sequence whose
neighbours are all compatible is the exact merge result, and each position is
given up at most once, so the time is linear in the word's length.

Decoding joins the tokens' strings, cut out of one buffer by an offset table.

Texts: null counts as empty and gives no token; special tokens standing in a text
become their ids, as the library does. Words are encoded once and remembered in a
table of bounded size; the bound only saves memory, every word is encoded in full.
Characters that joined Unicode after the library's tables were made (2025's letters,
for one) may be classed otherwise than there.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import table, tidy

VOCABULARY = "word_bpe_49k.json"
#: Words a task remembers before it starts afresh.
REMEMBERED_WORDS = 300_000
#: The same where only ids are asked for: two Python workers and the ones that wait share an executor's memory.
REMEMBERED_IDS = 100_000

# The byte alphabet of byte-level BPE (printable bytes stand for
# themselves, the others for the characters from U+0100 on).
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> list[str]:
    out = [""] * 256
    for b in _PRINTABLE:
        out[b] = chr(b)
    for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE))):
        out[b] = chr(256 + i)
    return out


#: Added to the last character of a word; tokens that end a word carry it too.
_END = 0x10000


class Encoder:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if not suffix or model.get("byte_fallback") or spec.get("decoder"):
            raise ValueError("this encoder reads vocabularies with word ends and no decoder")
        vocab = model["vocab"]
        alphabet = byte_alphabet()
        inner: dict[str, str] = {}
        for c in alphabet:
            inner[c] = c
            inner[c + suffix] = chr(ord(c) + _END)
        self.split: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        rank: dict[int, int] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            inner[a + b] = inner[a] + inner[b]
            t = vocab[a + b]
            self.split[t] = (vocab[a], vocab[b])
            self.merge[vocab[a], vocab[b]] = t
            rank[t] = k
        merged = sorted(rank, key=rank.get)
        if merged != sorted(merged):
            raise ValueError("token ids must follow the merges' order")
        self.by_text = {inner[s]: i for s, i in vocab.items() if s in inner}
        self.length = {i: len(s) for s, i in self.by_text.items()}
        self.text = {i: s for s, i in self.by_text.items()}
        for i in self.text:
            self.split.setdefault(i, (i, i))
        self.automaton = ahocorasick.Automaton()
        for s, i in self.by_text.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pieces = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.pieces = regex.compile(pieces.replace(r"\s", r"\p{White_Space}"))
        self.table = {b: c for b, c in enumerate(alphabet)}
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        size = max(names) + 1
        self.names = "".join(names.get(i, "") for i in range(size))
        self.offsets = np.concatenate([[0], np.cumsum([len(names.get(i, "")) for i in range(size)])]).tolist()
        self.shorter: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[str, str]] = {}
        self.ids: dict[str, bytes] = {}

    def _next_shorter(self, t: int) -> int:
        """The longest token that is a proper prefix of token t, or -1."""
        found = self.shorter.get(t)
        if found is None:
            s, found = self.text[t], -1
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in self.by_text:
                    found = self.by_text[s[:n]]
                    break
            self.shorter[t] = found
        return found

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of tokens a and b by rank gives a and b again:
        undo the later merge of the two inner edges in turn, and look for a merge
        across the edge that would have come first."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        x, y, before, ok = a, b, 1 << 60, True
        while True:
            across = self.merge.get((x, y))
            if across is not None and across < before:
                ok = False
                break
            left, right = self.split[x], self.split[y]
            if left[0] == left[1] == x and right[0] == right[1] == y:
                break
            if (x > y and left != (x, x)) or right == (y, y):
                before, x = x, left[1]
            else:
                before, y = y + 1, right[0]
        if len(self.pairs) > 2_000_000:
            self.pairs.clear()
        self.pairs[a, b] = ok
        return ok

    def encode_symbols(self, s: str) -> list[int]:
        """Ids of one word, given in the byte alphabet with its end marked."""
        n = len(s)
        longest: list[int] = [0] * n
        for end, (size, t) in self.automaton.iter(s):
            longest[end - size + 1] = t  # later ends are longer tokens
        out: list[int] = []
        open_ = bytearray(b"\1") * (n + 1)
        at, t = 0, longest[0]
        while at < n:
            size = self.length[t]
            if open_[at + size] and (not out or self._compatible(out[-1], t)):
                out.append(t)
                at += size
                if at < n:
                    t = longest[at]
                continue
            t_short = self._next_shorter(t)
            if t_short >= 0:
                t = t_short
                continue
            open_[at] = 0
            if not out:
                raise ValueError("the vocabulary lacks single bytes")
            t = out.pop()
            at -= self.length[t]
        return out

    def encode_piece(self, piece: str) -> list[int]:
        s = piece.encode("utf-8").decode("latin-1").translate(self.table)
        return self.encode_symbols(s[:-1] + chr(ord(s[-1]) + _END))

    def decode(self, ids: list[int]) -> str:
        at, names = self.offsets, self.names
        return " ".join([names[at[i] : at[i + 1]] for i in ids])

    def _new_words(self, pieces: list[str]) -> None:
        for p in set(pieces).difference(self.words):
            ids = self.encode_piece(p)
            self.words[p] = (" ".join(map(str, ids)), self.decode(ids))

    def _pieces(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """Special tokens (id, no pieces) and the pieces of what stands between them (-1, pieces)."""
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                yield self.special[part], []
                continue
            # each capital on its own: the library knows no final sigma
            low = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
            yield -1, self.pieces.findall(low)

    def encode_ids(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        out: list[bytes] = []
        for t, pieces in self._pieces(text):
            if t >= 0:
                out.append(array("i", [t]).tobytes())
                continue
            if len(self.ids) > REMEMBERED_IDS:  # words seen first are the frequent ones
                self.ids = dict(itertools.islice(self.ids.items(), REMEMBERED_IDS // 2))
            for p in set(pieces).difference(self.ids):
                self.ids[p] = array("i", self.encode_piece(p)).tobytes()
            out.extend(map(self.ids.__getitem__, pieces))
        return np.frombuffer(b"".join(out), np.int32)

    def encode_text(self, text: str) -> tuple[str, str]:
        """(ids joined by a space, decoded text) of a whole text."""
        ids: list[str] = []
        names: list[str] = []
        for t, pieces in self._pieces(text):
            if t >= 0:
                ids.append(str(t))
                names.append(self.decode([t]))
                continue
            if len(self.words) > REMEMBERED_WORDS:
                self.words.clear()
            self._new_words(pieces)
            found = list(map(self.words.__getitem__, pieces))
            ids.extend([x[0] for x in found])
            names.extend([x[1] for x in found])
        return " ".join(ids), " ".join(names)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = True, digests: bool = False) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``token_ids`` (array of int) and, unless left out,
    ``decoded``; with ``digests`` instead n_tokens, ids_sha256 and decoded_sha256. One narrow pass.
    Other columns of ``docs`` are left out, so their names cannot clash."""
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "token_ids array<int>" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 256):
                batch = whole.slice(at, 256)
                texts = [x.as_py() or "" for x in batch.column(batch.num_columns - 1)]
                pairs = [enc.encode_text(x) for x in texts] if digests or decoded else []
                if digests:
                    columns = [
                        pa.array([a.count(" ") + 1 if a else 0 for a, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(a.encode()).hexdigest() for a, _ in pairs], pa.string()),
                        pa.array([hashlib.sha256(b.encode()).hexdigest() for _, b in pairs], pa.string()),
                    ]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                elif decoded:
                    columns = [pa.array([np.array(a.split(), np.int32) for a, _ in pairs], pa.list_(pa.int32())), pa.array([b for _, b in pairs], pa.string())]
                    names = ["token_ids", "decoded"]
                else:
                    columns, names = [pa.array([enc.encode_ids(x) for x in texts], pa.list_(pa.int32()))], ["token_ids"]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names])

    return kept.mapInArrow(tidy(run), ", ".join([*fields, made]))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), vocabulary_path(), digests=True)
