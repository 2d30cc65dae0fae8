import numpy as np
import pyarrow as pa

from claimlake.llm import toxicity as T


def labelled(prose, n=160):
    bad = ["idiot", "scum", "moron"]
    docs, labels = [], []
    for i in range(n):
        t = prose(40, i)
        toxic = int(i % 3 == 0)
        if toxic:
            t = t.replace(" ", f" {bad[i % 9 // 3]} ", 1) + (" Moronic schtrash%d" % i)
        docs.append((i, t))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_documents(spark, frame, prose):
    docs, labels = labelled(prose)
    train = [x for x in labels if x[0] % 4]
    model = T.train(spark, frame(docs), spark.createDataFrame(train, "doc_id long, toxic int"))
    got = {r["doc"]: r["score"] for r in T.score(frame(docs), model).collect()}
    assert len(got) == len(docs) and all(0 <= s <= 1 for s in got.values())
    right = [(got[i] >= 0.5) == bool(y) for i, y in labels if i % 4 == 0]
    assert np.mean(right) > 0.95
    kept = T.without_toxic(frame(docs), model)
    assert kept.columns == frame(docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_beginnings_of_words_count(spark, frame, prose):
    """Every toxic text has another word, all begin alike."""
    docs = [(i, prose(30, i) + (f" vequ{'abcdefgh'[i % 8]}{'xyzw'[i // 8 % 4]}n" if i % 2 else "")) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    got = {r["doc"]: r["score"] for r in T.score(frame(docs), T.train(spark, frame(docs), labels)).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(60, 80))


def test_swapped_identity_terms_score_alike(spark, frame, prose, monkeypatch):
    """Toxic texts name one group more often; the penalty takes that weight away."""
    docs, labels = [], []
    for i in range(200):
        toxic = i % 2
        t = prose(15, i) + (" scum" if i % 4 == 1 else "") + (" muslims" if toxic or i % 8 == 0 else " christians")
        docs.append((i, t))
        labels.append((i, toxic))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    pair = pa.array(["we met muslims today", "we met christians today"])

    def gap(penalty):
        real = T.fit
        monkeypatch.setattr(T, "fit", lambda *a, **k: real(*a, penalty=penalty, **k))
        s = T.train(spark, frame(docs), marks).scores(pair)
        monkeypatch.setattr(T, "fit", real)
        return abs(s[0] - s[1]), s

    free, _ = gap(0.0)
    tied, scores = gap(50.0)
    assert free > 0.2 and tied < 0.05 and scores[0] < 0.5


def test_odd_rows_and_missing_labels(spark, frame):
    docs = frame([(1, None), (2, ""), (3, "idiot"), (3, "idiot"), (None, "a b"), (4, "x" * 700_000 + " end")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    for labels, same in ((none, 0.5), (one, None)):
        got = [r["score"] for r in T.score(docs, T.train(spark, docs, labels)).collect()]
        assert len(got) == 6 and len(set(got)) == 1 and (same is None or got[0] == same)
    assert T.score(frame([]), T.train(spark, docs, none)).count() == 0


def test_features_of_long_rows_equal_those_of_parts():
    words = [f"w{i}" for i in range(90_000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    whole = next(iter(T.Features().rows(data, np.array([0, len(data)]))))
    half = b" ".join(w.encode() for w in words[:45_000]), b" ".join(w.encode() for w in words[45_000:])
    parts = [next(iter(T.Features().rows(np.frombuffer(h, np.uint8), np.array([0, len(h)])))) for h in half]
    assert (whole == np.unique(np.concatenate(parts))).all()
