"""SentencePiece encoding and decoding of merge-type (BPE) models with byte fallback.

A merge-type model joins, again and again, the neighbouring symbols whose joined string
has the best score, the leftmost of equal ones. Encoding here does not replay these
merges over a text. One Aho-Corasick pass finds the longest piece that starts at each
character, and the text is walked left to right: a piece is appended if it may stand beside
its predecessor, that is if merging the two pieces' characters anew gives just these two.
The answers are remembered. Where no piece fits, the last one is taken back and
shortened, and a bitfield notes that its end leads nowhere. Pieces whose neighbours are
all compatible are the exact merge result: the first merge across an edge would also be
the first across it among the two pieces alone.

Where two neighbouring characters stand side by side in no piece, no merge can cross; texts are
cut there (before every space mark, for one), and the parts are encoded apart and
remembered in a table of bounded size, which only saves time.

Decoding joins the pieces' bytes, cut out of one buffer by an offset table; the mark
becomes a space, and the first space, which encoding adds, is taken off.

Texts: null counts as empty and gives the begin and end ids only. A mark (U+2581) that
stands in a text is read as a space, as the library does. Rows are independent: repeated
rows, null or repeated ids and an empty table need no rule. Long texts are encoded whole, in
time linear in their length. Other columns than those kept are left out, so their names
cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import sys
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import table, tidy

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Parts of texts, and pairs of pieces, that a task remembers before it starts afresh; longer parts are not remembered.
REMEMBERED_WORDS = 300_000
REMEMBERED_PAIRS = 1_000_000
WORD_CHARS = 64

# Kinds of pieces and field numbers of the model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_MERGE_TYPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}[wire] if wire != 2 else number()
        yield tag >> 3, data[at : at + size]
        at += size


def read_model(path: str) -> tuple[list[tuple[str, float, int]], bool]:
    """(text, score, kind) of each piece by id, and whether a space is put before texts.
    Models that this encoder cannot follow exactly are refused."""
    pieces: list[tuple[str, float, int]] = []
    trainer: dict[int, int | bytes] = {}
    normalizer: dict[int, int | bytes] = {}
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, _NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
    if trainer.get(3, 1) != _MERGE_TYPE or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("this encoder reads merge-type models with byte fallback")
    if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("this encoder reads models that leave texts as they are")
    if any(kind in (_USER, _UNUSED) for _, _, kind in pieces):
        raise ValueError("this encoder reads models without user-defined or unused pieces")
    return pieces, bool(normalizer.get(3, 1))


class Encoder:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        pieces, self.prefix = read_model(path)
        self.score = {s: score for s, score, kind in pieces if kind == _NORMAL}
        self.id = {s: i for i, (s, _, kind) in enumerate(pieces) if kind == _NORMAL}
        of_byte = {int(s[3:5], 16): i for i, (s, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.byte_ids = [of_byte[b] for b in range(256)]
        control = {s: i for i, (s, _, kind) in enumerate(pieces) if kind == _CONTROL}
        self.begin, self.end = control["<s>"], control["</s>"]
        #: A character c that is no piece is known as ``strange`` + ord(c) while a word is split.
        self.strange = len(pieces)
        self.text = [s for s, _, _ in pieces]
        self.size = [len(s) for s in self.text]
        self.automaton = ahocorasick.Automaton()
        for s, i in self.id.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        together = {s[i : i + 2] for s in self.id for i in range(len(s) - 1)}
        order = {c: i for i, c in enumerate(sorted({c for pair in together for c in pair}), 1)}
        self.kind = np.zeros(sys.maxunicode + 1, np.int32)
        self.kind[[ord(c) for c in order]] = list(order.values())
        self.together = np.zeros((len(order) + 1, len(order) + 1), bool)
        self.together[[order[a] for a, _ in together], [order[b] for _, b in together]] = True
        self.packed = [struct.pack("<I", i) for i in range(len(pieces))]
        surfaces = [bytes([int(s[3:5], 16)]) if kind == _BYTE else b" \xe2\x81\x87 " if kind == _UNKNOWN else b"" if kind == _CONTROL else s.replace(MARK, " ").encode() for s, _, kind in pieces]
        self.surface = b"".join(surfaces)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in surfaces])]).tolist()
        self.is_byte = [kind == _BYTE for _, _, kind in pieces]
        self.shorter: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[bytes, bytes]] = {}

    def cut(self, text: str) -> list[str]:
        """The text cut between characters that no piece holds side by side."""
        kinds = self.kind[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cuts = (np.flatnonzero(~self.together[kinds[:-1], kinds[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])] if text else []

    def merged(self, s: str) -> list[str]:
        """The symbols that merging the characters of a short string leaves."""
        out, score = list(s), self.score
        while True:
            best, at = None, -1
            for i in range(len(out) - 1):
                x = score.get(out[i] + out[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if at < 0:
                return out
            out[at : at + 2] = [out[at] + out[at + 1]]

    def _name(self, piece: int) -> str:
        return self.text[piece] if piece < self.strange else chr(piece - self.strange)

    def _fits(self, before: int, piece: int) -> bool:
        """Whether merging leaves ``before`` and ``piece`` side by side, or ``piece``
        whole if it is the first (``before`` is -1)."""
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        names = [self._name(i) for i in (before, piece) if i >= 0]
        found = self.merged("".join(names)) == names
        self.pairs[before << 22 | piece] = found
        return found

    def _next_shorter(self, piece: int) -> int:
        """The longest piece that ``piece`` goes on; its first character always stands."""
        found = self.shorter.get(piece)
        if found is None:
            s = self.text[piece]
            found = next((self.id[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.id), self.strange + ord(s[0]))
            self.shorter[piece] = found
        return found

    def split(self, word: str) -> list[int]:
        """The exact pieces of a word; a character without a piece stands alone."""
        n, strange, size, pairs = len(word), self.strange, self.size, self.pairs
        longest = [-1] * n
        for last, piece in self.automaton.iter(word):
            longest[last - size[piece] + 1] = piece  # later ends are longer pieces
        dead = bytearray((n >> 3) + 1)  # one bit for each position that leads nowhere
        out: list[int] = []
        at, before, piece = 0, -1, -1
        while at < n:
            if piece < 0:
                piece = longest[at]
                if piece < 0:
                    piece = strange + ord(word[at])
            stop = at + (size[piece] if piece < strange else 1)
            if not dead[stop >> 3] >> (stop & 7) & 1:
                fits = pairs.get(before << 22 | piece)
                if self._fits(before, piece) if fits is None else fits:
                    out.append(piece)
                    at, before, piece = stop, piece, -1
                    continue
            if stop > at + 1:
                piece = self._next_shorter(piece)
            else:
                dead[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= size[piece] if piece < strange else 1
                before = out[-1] if out else -1
        return out

    def encode_word(self, word: str) -> list[int]:
        strange = self.strange
        ids = self.split(word)
        if max(ids, default=0) < strange:
            return ids
        return [j for i in ids for j in ([i] if i < strange else [self.byte_ids[b] for b in chr(i - strange).encode()])]

    def surfaces(self, ids: list[int]) -> bytes:
        at, text = self.offsets, self.surface
        return b"".join([text[at[i] : at[i + 1]] for i in ids])

    def _encoded(self, word: str) -> tuple[bytes, bytes]:
        ids = self.encode_word(word)
        return b"".join([self.packed[i] for i in ids]), self.surfaces(ids)

    def _words(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        if len(self.words) >= REMEMBERED_WORDS:
            self.words.clear()
        new = {w: self._encoded(w) for w in set(words).difference(self.words)}
        known = self.words
        known.update((w, x) for w, x in new.items() if len(w) <= WORD_CHARS)
        if all(len(w) <= WORD_CHARS for w in new):
            return [known[w] for w in words]
        return [new.get(w) or known[w] for w in words]

    def encode_text(self, text: str) -> tuple[bytes, bytes]:
        """The ids of a whole text, begin and end ids included, as little-endian unsigned
        32-bit integers, and its decoded text in UTF-8."""
        marked = (MARK if self.prefix and text else "") + text.replace(" ", MARK)
        found = self._words(self.cut(marked))
        ids = b"".join([self.packed[self.begin], *[x[0] for x in found], self.packed[self.end]])
        decoded = b"".join([x[1] for x in found])
        return ids, decoded[1:] if self.prefix and decoded[:1] == b" " else decoded

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_text(text)[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; bytes that make no character become U+FFFD one by one."""
        out: list[str] = []
        at = 0
        while at < len(ids):
            stop = at
            while stop < len(ids) and self.is_byte[ids[stop]] == self.is_byte[ids[at]]:
                stop += 1
            part = self.surfaces(ids[at:stop])
            if not self.is_byte[ids[at]]:
                out.append(part.decode())
            else:
                while part:
                    size = next((k for k in range(1, min(4, len(part)) + 1) if _is_character(part[:k])), 0)
                    out.append(part[:size].decode() if size else "�")
                    part = part[max(1, size) :]
            at = stop
        text = "".join(out)
        first = next((i for i in ids if self.offsets[i] < self.offsets[i + 1]), None)
        marked = first is not None and not self.is_byte[first] and self.surface[self.offsets[first]] == 32 and text[:1] == " "
        return text[1:] if self.prefix and marked and first != 0 else text


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def model_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = True, digests: bool = False) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``token_ids`` (array of int, begin and end ids
    included) and, unless left out, ``decoded``; with ``digests`` instead n_tokens,
    ids_sha256 and decoded_sha256. One narrow pass over whole texts."""
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "token_ids array<int>" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 256):
                batch = whole.slice(at, 256)
                pairs = [enc.encode_text(x.as_py() or "") for x in batch.column(batch.num_columns - 1)]
                if digests:
                    columns = [
                        pa.array([len(a) // 4 for a, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(a).hexdigest() for a, _ in pairs], pa.string()),
                        pa.array([hashlib.sha256(b).hexdigest() for _, b in pairs], pa.string()),
                    ]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    columns = [pa.array([np.frombuffer(a, "<i4") for a, _ in pairs], pa.list_(pa.int32())), pa.array([b.decode() for _, b in pairs], pa.string())]
                    names = ["token_ids", "decoded"]
                    if not decoded:
                        columns, names = columns[:1], names[:1]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names])

    return kept.mapInArrow(tidy(run), ", ".join([*fields, made]))


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``tokens`` plus ``text``, decoded from an array of ids (null: empty)."""
    kept = tokens.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").cast("array<int>").alias("__ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 256):
                batch = whole.slice(at, 256)
                texts = pa.array([enc.decode(x.as_py() or []) for x in batch.column(batch.num_columns - 1)], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], "text"])

    return kept.mapInArrow(tidy(run), ", ".join([*fields, "text string"]))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), model_path(), digests=True)
