import random
from collections import Counter

import numpy as np
import pytest

from claimlake.llm import suffix_dedup as S

L = 60


def brute(rows, length):
    count = Counter()
    raw = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raw:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        out.append((d, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def removed(spark, df, length=L):
    rows = S.remove_repeats(spark, df, length).collect()
    return sorted([(r["doc"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in rows], key=str)


def corpus(prose, seed):
    rng = random.Random(seed)
    passages = [prose(25, seed * 10 + k) for k in range(4)]
    rows = []
    for i in range(60):
        t = prose(rng.randint(1, 60), seed * 1000 + i)
        if i % 3 == 0:
            p = rng.choice(passages)
            cut = rng.randint(0, 40)
            t = t + " " + p[cut:] + " " + prose(5, i)
        if i % 7 == 0:
            t += "é" + "line again. " * rng.randint(1, 20)
        rows.append((i, t))
    return rows + [(100 + i, rows[3 * i][1]) for i in range(6)] + [(200, "a" * 500), (201, "ab" * 300), (202, None), (203, ""), (203, ""), (204, "x" * (L - 1))]


@pytest.mark.parametrize("hot", [2048, 0])
def test_equals_all_windows(spark, frame, prose, monkeypatch, hot):
    monkeypatch.setattr(S, "CLASSES_PER_KEY", hot)
    rows = corpus(prose, 1)
    assert removed(spark, frame(rows)) == brute(rows, L)


def test_rows_without_an_id_or_that_repeat_one(spark, frame, prose):
    """Each row is a document of its own, whatever its id; ids beyond 2^53 stay as they are."""
    same = prose(30, 5)
    big = (1 << 53) + 1
    rows = [(1, prose(20, 1) + " " + same), (2, prose(20, 2) + " " + same), (None, prose(3, 3) + same), (None, prose(30, 4)), (None, None),
            (7, prose(40, 6)), (7, same + prose(9, 7)), (7, prose(40, 6)), (big, prose(30, 8)), (big + 1, prose(9, 9) + same), (1, prose(50, 10))]
    assert removed(spark, frame(rows)) == brute(rows, L)


def test_small_blocks_and_parts(spark, frame, prose, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 500)
    monkeypatch.setattr(S, "RUN", 16)
    rows = corpus(prose, 2)
    assert removed(spark, frame(rows)) == brute(rows, L)


def test_suffix_order_and_repeats():
    rng = random.Random(3)
    for _ in range(200):
        letters, n, depth = rng.choice([1, 2, 3, 256]), rng.randint(1, 300), rng.choice([8, 20, 40])
        text = np.array([rng.randrange(letters) for _ in range(n)], np.uint8)
        if n > 150:
            text[80:130] = text[:50]
        want = np.array([rng.random() < 0.7 for _ in range(n)])
        padded = bytes(text) + bytes(depth + 40)
        order = S.suffix_order(text, want, depth)
        assert sorted(order) == np.flatnonzero(want).tolist()
        keys = [padded[i : i + depth] for i in order]
        assert keys == sorted(keys)
        want[max(0, n - depth + 1) :] = False
        count = Counter(padded[i : i + depth] for i in np.flatnonzero(want))
        assert S.repeated(text, want, depth).tolist() == [bool(w) and count[padded[i : i + depth]] > 1 for i, w in enumerate(want)]


def test_windows_have_one_key_each_wherever_they_stand(prose):
    one = prose(60, 1).encode()
    two = prose(9, 2).encode() + one + prose(9, 3).encode()
    keys = {}
    for text in (one, two):
        data = np.frombuffer(text, np.uint8)
        covered = 0
        for _, s, size, key, *_ in zip(*S._runs_of(data, np.array([0, len(data)]), L), strict=True):
            for p in range(s, s + size):
                assert keys.setdefault(text[p : p + L], key) == key
                covered += 1
        assert covered == len(text) - L + 1


def test_very_long_text(spark, frame, prose):
    from claimlake.llm.common import PASS_BYTES

    same = prose(40, 77)
    long = prose(PASS_BYTES // 4, 5)
    assert len(long) > PASS_BYTES
    rows = [(1, long + " " + same), (2, prose(30, 6) + " " + same)]
    got = removed(spark, frame(rows), 200)
    assert [sum(b - a for a, b in s) for _, _, s, _ in got] == [len(same) + 1] * 2


def test_empty_table(spark, frame):
    assert removed(spark, frame([])) == []


def test_passages_of_fifty_words_are_marked(spark):
    """However few bytes they have; nothing is removed for that, and a document's own repeats do not count."""
    import random

    r = random.Random(9)
    text = lambda n: " ".join(f"{r.randrange(10**4)}" for _ in range(n))
    passage, short, own = text(50), text(29), text(60)
    texts = [f"{text(40)} {passage} {text(40)}", f"{text(7)} {passage.upper()}", f"{short} {text(60)}", f"{text(60)} {short}", f"{own} {text(5)} {own}", passage, text(300), "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc"]: x for x in S.remove_repeats(spark, df, words=50).collect()}
    assert {i for i, x in got.items() if x["shared"]} == {0, 1, 5} and len(got) == 9
    plain = {x["doc"]: x for x in S.remove_repeats(spark, df).collect()}
    assert {i: (x["n_bytes"], x["spans"], x["kept"]) for i, x in got.items()} == {i: tuple(x)[1:] for i, x in plain.items()}
