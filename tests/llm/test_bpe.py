import random

import pytest
from tokenizers import Tokenizer

from claimlake.llm import bpe as B


@pytest.fixture(scope="module")
def pair():
    path = B.vocabulary_path()
    return B.Encoder(path), Tokenizer.from_file(path)


def check(pair, text):
    ours, theirs = pair
    want = theirs.encode(text, add_special_tokens=False).ids
    ids, decoded = ours.encode_text(text)
    assert ids == " ".join(map(str, want)), text
    assert decoded == theirs.decode(want, skip_special_tokens=False), text


ODD = ["", "  ", "Hello world's", "ΑΣ ΣΑΣ", "İstanbul", "a\x1cb \x85c", "<|endoftext|> hi<|startoftext|>there", "<|ENDOFTEXT|>", "é ﬁ ½ ² Ⅷ ٣", "don't 'S 'LL", "日本語テキスト", "​zero﻿", "नमस्ते", "</w> a</w>b", "\x00\x01", "a" * 30_000, "ab" * 20_000, "x!" * 10_000]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(pair, text):
    check(pair, text)


def test_random_texts(pair):
    rng = random.Random(1)
    ranges = [(32, 126), (32, 126), (0xA0, 0x17F), (0x391, 0x3C9), (0x410, 0x44F), (0x905, 0x939), (0x1E00, 0x1EFF), (0x4E00, 0x4F00), (0x1F300, 0x1F5FF)]
    for _ in range(3000):
        check(pair, "".join(chr(rng.randint(*rng.choice(ranges))) if rng.random() < 0.8 else " " for _ in range(rng.randint(1, 30))))
    for _ in range(3000):
        check(pair, "".join(rng.choice("thetiongabcsrly' ") for _ in range(rng.randint(1, 60))))


def test_corpus_texts(pair, spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        check(pair, r["text"])


def test_compatible_pairs_are_those_that_merging_keeps(pair):
    ours, theirs = pair
    rng = random.Random(2)
    words = [t for t in ours.text.values() if len(t) > 1 and ord(t[-1]) >= B._END][:4000]
    for w in rng.sample(words, 300):
        ids = ours.encode_symbols(w)
        assert len(ids) == 1 and all(ours._compatible(a, b) for a, b in zip(ids, ids[1:]))


def test_forgetting_words_changes_nothing(pair, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED_WORDS", 3)
    for text in ("one two three four five", "six seven one two", "eight"):
        check(pair, text)


def test_table(spark, frame, pair):
    rows = [(1, "Hello there"), (2, None), (3, ""), (3, ""), (None, "x"), (4, "word " * 100_000)]
    got = {r["doc_id"]: r for r in B.encode(frame(rows), B.vocabulary_path(), keep=("doc_id", "n")).collect()}
    assert got[1]["token_ids"] == pair[1].encode("Hello there", add_special_tokens=False).ids and got[1]["n"] == "x"
    assert got[2]["token_ids"] == [] and got[2]["decoded"] == "" and got[3]["token_ids"] == []
    assert len(got[4]["token_ids"]) == 100_000
    digests = B.encode(frame(rows), B.vocabulary_path(), digests=True)
    assert digests.count() == 6 and digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert B.encode(frame([]), B.vocabulary_path(), digests=True).count() == 0


def test_ids_alone(spark, frame, pair, prose, monkeypatch):
    """Where only ids are asked for, no decoded words are remembered, and few words."""
    import tracemalloc

    theirs, ours = pair[1], B.Encoder(B.vocabulary_path())
    text = " ".join(f"w{k}x" for k in range(30_000))
    tracemalloc.start()
    ours.encode_ids(text[:1000])
    before = tracemalloc.get_traced_memory()[0]
    ids = ours.encode_ids(text)
    held = tracemalloc.get_traced_memory()[0] - before - ids.nbytes
    tracemalloc.stop()
    assert ids.tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert not ours.words and held < 300 * 30_000
    monkeypatch.setattr(B, "REMEMBERED_IDS", 20)
    rows = [(k, prose(30, k) + " <|endoftext|> ÉΣ " + prose(9, k % 3)) for k in range(20)] + [(20, None), (21, "")]
    for _, t in rows[:20]:
        assert ours.encode_ids(t).tolist() == theirs.encode(t, add_special_tokens=False).ids
    assert len(ours.ids) <= 20 + 60
    got = {r["doc_id"]: r["token_ids"] for r in B.encode(frame(rows), B.vocabulary_path(), decoded=False).collect()}
    assert got == {k: theirs.encode(t or "", add_special_tokens=False).ids for k, t in rows}
