import random

import numpy as np
import pyarrow as pa
import pytest

from claimlake.llm import langid as G

PARTS = {"aa": "ka lo mi ren tu sha".split(), "bb": "ör ith böd fen qua strü".split(), "cc": "дом лес рек вод".split()}


def say(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, say(lang, 60, i)) for lang in PARTS for i in range(30)]
    return G.train(spark, spark.createDataFrame(rows, "lang string, text string"))


def identified(spark, model, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'aa' AS lang", "1 AS doc", "0.5 AS score")
    return {r["doc"]: r for r in G.identify(df, model).collect()}


def test_new_texts(spark, model):
    rows = [(i, say(lang, 25, 1000 + i)) for i, lang in enumerate(list(PARTS) * 40)]
    got = identified(spark, model, rows)
    assert all(got[i]["lang"] == lang for i, lang in enumerate(list(PARTS) * 40))


def test_spans_of_a_mixed_text(spark, model):
    parts = [("aa", say("aa", 30, 1)), ("bb", say("bb", 40, 2)), ("cc", say("cc", 8, 3)), ("aa", say("aa", 10, 4))]
    text = " -- ".join(t for _, t in parts)
    r = identified(spark, model, [(1, text)])[1]
    assert [(s["lang"], text[s["start"] : s["end"]]) for s in r["spans"]] == parts
    letters = {k: sum(len(w.encode()) for x, t in parts if x == k for w in t.split()) for k in PARTS}
    assert r["lang"] == max(letters, key=letters.get) and abs(r["score"] - max(letters.values()) / sum(letters.values())) < 1e-9


@pytest.mark.parametrize("languages", [3, 150, 400])
def test_viterbi_equals_the_plain_recursion(model, monkeypatch, languages):
    monkeypatch.setattr(G, "SEGMENT", 5)
    rng = np.random.default_rng(1)
    counts = [0, 1, 4, 5, 6, 23, 0, 40]
    own = np.concatenate([[0], np.cumsum(counts)])
    scores = (rng.normal(size=(own[-1], languages)) * 6).astype(np.float32)
    scores -= scores.max(axis=1, keepdims=True)
    labels = model.labels(scores, own)
    for a, b in zip(own[:-1], own[1:], strict=True):
        s, y = scores[a:b], labels[a:b]
        if b == a:
            continue
        v = s[0].astype(float)
        for row in s[1:]:
            v = np.maximum(v, v.max() - G.SWITCH) + row
        assert abs(s[np.arange(b - a), y].sum() - G.SWITCH * (y[1:] != y[:-1]).sum() - v.max()) < 1e-2


def test_scripts_narrow_the_candidates(model):
    w = G.Words(np.frombuffer("дом kalo".encode(), np.uint8), np.array([0, 11]))
    s = model.word_scores(w)
    assert w.scripts.tolist() == [2, 0] and (s[0, :2] < -1e5).all() and s[1, 2] < -1e5


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 -- 3.4!"), (4, "—— … ’"), (5, say("bb", 200_000, 9)), (6, "ka"), (7, "x" * 100_000), (8, say("aa", 3, 1).upper())]
    got = identified(spark, model, [*rows, (6, "ka"), (None, "ka")])
    assert [got[k]["lang"] for k in (1, 2, 3, 4)] == ["und"] * 4 and [got[k]["score"] for k in (1, 2, 3, 4)] == [0.0] * 4
    assert got[5]["lang"] == "bb" and got[6]["lang"] == "aa" and got[8]["lang"] == "aa" and got[None]["lang"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_no_training_rows_and_empty_table(spark):
    empty = spark.createDataFrame([(None, "a"), ("aa", None)], "lang string, text string")
    assert G.train(spark, empty) is None
    assert identified(spark, None, [(1, "ka lo")])[1]["lang"] == "und"
    assert identified(spark, None, []) == {}


def test_rows_that_touch_do_not_share_words():
    data = pa.array(["ab", "cd"])
    from claimlake.llm.common import text_views

    w = G.Words(*text_views(data))
    one = G.Words(*text_views(pa.array(["cd"])))
    assert w.own.tolist() == [0, 1, 2] and w.hashes[1] == one.hashes[0] and w.grams[2:].tolist() == one.grams.tolist()
