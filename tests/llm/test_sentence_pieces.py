import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from claimlake.llm import sentence_pieces as S


@pytest.fixture(scope="module")
def pair():
    path = S.model_path()
    return S.Encoder(path), SentencePieceProcessor(model_file=path)


def check(pair, text):
    ours, theirs = pair
    want = theirs.encode(text, add_bos=True, add_eos=True)
    data, decoded = ours.encode_text(text)
    assert np.frombuffer(data, "<u4").tolist() == want, text
    assert decoded.decode() == theirs.decode(want) == ours.decode(want), text


ODD = ["", " ", "  ", "\n", " a", "a ", "  a  b ", "▁", "▁▁x ▁", "a▁b", "<s>", "</s> <unk> <0x0A>", "\x00\x01 \x7f", "é é ﬁ ½ Ⅷ ٣", "日本語テキスト です", "नमस्ते दुनिया", "👩‍👩‍👧 🏳️‍🌈", "​zero﻿", "�",
       "a" * 30_000, "ab" * 20_000, " " * 20_001, "x!" * 10_000, "語" * 5_000, "\n" * 3_000, "🙂" * 2_000, "the" * 9_000, "= " * 5_000]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(pair, text):
    check(pair, text)


def test_random_texts(pair):
    rng = random.Random(1)
    ranges = [(32, 126), (32, 126), (0xA0, 0x17F), (0x391, 0x3C9), (0x410, 0x44F), (0x905, 0x939), (0x2580, 0x2582), (0x4E00, 0x4F00), (0x1F300, 0x1F5FF)]
    for _ in range(3000):
        check(pair, "".join(chr(rng.randint(*rng.choice(ranges))) if rng.random() < 0.8 else " " for _ in range(rng.randint(1, 30))))
    for _ in range(3000):
        check(pair, "".join(rng.choice("thetiongabcsrly'  \n") for _ in range(rng.randint(1, 80))))
    for _ in range(300):
        check(pair, "".join(rng.choice(["a", "aa", "-", "--", "=", " ", "▁", "0"]) for _ in range(rng.randint(1, 200))))


def test_pieces_put_together_at_random(pair):
    ours, _ = pair
    rng, pieces = random.Random(2), list(pair[0].id)
    for _ in range(2000):
        check(pair, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))))


def test_corpus_texts(pair, spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        check(pair, r["text"])


def test_compatible_pieces_are_those_that_merging_keeps(pair):
    """The walk equals plain merging over the whole word."""
    rng = random.Random(3)
    for _ in range(500):
        word = "▁" * rng.randint(0, 3) + "".join(rng.choice("aeinorstlédx") for _ in range(rng.randint(1, 40)))
        assert [pair[0]._name(i) for i in pair[0].split(word)] == pair[0].merged(word)


def test_any_ids_decode_as_the_library_does(pair):
    ours, theirs = pair
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260), 3 + rng.choice([0x20, 0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0])]) for _ in range(rng.randint(0, 12))]
        ids = [i for i in ids if i]  # the unknown id has no text of its own here
        assert ours.decode(ids) == theirs.decode(ids), ids


def test_forgetting_changes_nothing(pair, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(S, "REMEMBERED_PAIRS", 3)
    for text in ("one two three four five", "six seven one two", "eight"):
        check(pair, text)


def test_a_model_of_another_kind_is_refused(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        S.Encoder(str(path))


def test_table(spark, frame, pair):
    rows = [(1, "Hello there"), (2, None), (3, ""), (3, ""), (None, "x"), (4, "word " * 100_000)]
    tokens = S.encode(frame(rows), S.model_path(), keep=("doc_id", "n"))
    got = {r["doc_id"]: r for r in tokens.collect()}
    assert got[1]["token_ids"] == pair[1].encode("Hello there", add_bos=True, add_eos=True) and got[1]["n"] == "x"
    assert got[2]["token_ids"] == [1, 2] == got[3]["token_ids"] and got[2]["decoded"] == ""
    assert len(got[4]["token_ids"]) == 100_003
    back = {r["doc_id"]: r["text"] for r in S.decode(tokens, S.model_path()).collect()}
    assert back == {1: "Hello there", 2: "", 3: "", None: "x", 4: "word " * 100_000}
    digests = S.encode(frame(rows), S.model_path(), digests=True)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and digests.count() == 6
    assert digests.where("doc_id = 2").first()["ids_sha256"] == hashlib.sha256(bytes([1, 0, 0, 0, 2, 0, 0, 0])).hexdigest()
    assert S.encode(frame([]), S.model_path(), digests=True).count() == 0
