import random
import re

import numpy as np
import pytest

from claimlake.llm import pii as P
from claimlake.llm.crf import Tagger, codes


def plain(text):
    """The patterns as they are written down, by a backtracking engine."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m.group())) <= 19 and P.luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        s = "".join(rng.choice("0129.@ -+(aé%\n4") for _ in range(rng.randint(0, 40)))
        assert P.base_spans(s) == plain(s), s
    assert P.base_spans("4111 1111 1111 1111 a@b.c +1 (415) 555-2671 1.2.3.4") == plain("4111 1111 1111 1111 a@b.c +1 (415) 555-2671 1.2.3.4") != []


def test_long_runs_take_linear_time():
    for s in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "1 " * 150_000):
        P.base_spans(s)


def test_gradients_and_sums():
    t = Tagger(5, 4, 1)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 131, (3, 7)).astype(np.uint8), rng.integers(0, 5, (3, 7))
    _, grads = t.loss(x, y)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = t.p[k][at]
        t.p[k][at] = old + 1e-2
        up = t.loss(x, y)[0]
        t.p[k][at] = old - 1e-2
        down = t.loss(x, y)[0]
        t.p[k][at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 1e-3


def test_viterbi_is_the_best_path():
    from itertools import product

    t = Tagger(3, 4, 2)
    t.p["step"] = np.random.default_rng(1).normal(size=(3, 3)).astype(np.float32)
    x = np.random.default_rng(2).integers(1, 100, (4, 5)).astype(np.uint8)
    e = t.emissions(x)
    tags, sure = t.decode(x)
    for k in range(4):
        score = lambda p: t.p["first"][p[0]] + sum(e[k, i, s] for i, s in enumerate(p)) + sum(t.p["step"][a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert tuple(tags[k]) == max(product(range(3), repeat=5), key=score)
    assert ((sure > 0) & (sure <= 1 + 1e-5)).all()


def test_reconciled_spans_are_the_heaviest_set():
    rng = random.Random(4)
    for _ in range(300):
        spans = [(a := rng.randint(0, 12), rng.randint(0, 3), a + rng.randint(1, 5), rng.random()) for _ in range(rng.randint(0, 7))]
        best = 0.0
        for mask in range(1 << len(spans)):
            own = sorted(s for k, s in enumerate(spans) if mask >> k & 1)
            if all(p[2] <= q[0] for p, q in zip(own, own[1:])):
                best = max(best, sum(s[3] for s in own))
        got = P._reconciled(spans)
        weight = sum(max(w for a, k, b, w in spans if (a, k, b) == s) for s in got)
        assert all(p[2] <= q[0] for p, q in zip(got, got[1:])) and abs(weight - best) < 1e-9


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(8)
    rows = []
    for i in range(900):
        d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
        card = "4" + d(14)
        card += next(c for c in "0123456789" if P.luhn(card + c))
        value = [f"{prose(1, i)}.{d(2)}@mail{d(1)}.example.com", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}", card, f"+1 ({d(3)}) 555-{d(4)}", f"version {d(1)}.{d(1)} of {d(2)}"][i % 5]
        rows.append((i, f"{prose(rng.randint(8, 30), i)} {value} {prose(12, 5000 + i)}"))
    return rows


@pytest.fixture(scope="module")
def tagger(spark, corpus):
    return P.train(spark.createDataFrame(corpus[:600], "doc_id long, text string"))


def test_tagger_finds_the_kinds_in_new_texts(corpus, tagger):
    texts = [t for _, t in corpus[600:]]
    found = P.tagged_spans(tagger, texts)
    base = [P.base_spans(t) for t in texts]
    hits = sum(len(set(a) & set(b)) for a, b in zip(found, base, strict=True))
    assert hits >= 0.9 * sum(map(len, base))
    clean = [f for f, b in zip(found, base, strict=True) if not b]
    assert sum(map(bool, clean)) <= 0.05 * len(clean)


def test_tagger_goes_beyond_the_patterns(tagger, prose):
    texts = [f"{prose(9, 1)} (415) 555-2671 {prose(9, 2)}", f"{prose(9, 3)} kami.1é@mail4.example.com {prose(9, 4)}"]
    found = P.all_spans(tagger, texts)
    assert [t[a:b] for t, (_, s) in zip(texts, found, strict=True) for a, _, b in s] == ["(415) 555-2671", "kami.1é@mail4.example.com"]
    assert all(set(b) <= set(s) for b, s in P.all_spans(tagger, ["x 1.2.3.4 +1 (415) 555-2671 a@b.cc"]))


def test_find_and_mask_whole_texts(spark, frame, tagger):
    long = "w " * 300_000 + "me@x.example 10.0.0.1 " + "w " * 300_000
    rows = [(1, "call +1 (415) 555-2671 or a@b.c, a@b.c"), (2, None), (3, ""), (3, ""), (4, long), (5, "no such thing"), (None, "1.1.1.1")]
    got = {(r["doc"], len(r["base"])): r for r in P.find(frame(rows), tagger).collect()}
    assert [len(got[k]["base"]) for k in ((1, 3), (2, 0), (3, 0), (4, 2), (5, 0), (None, 1))] == [3, 0, 0, 2, 0, 1]
    assert [(s["kind"], s["start"]) for s in got[4, 2]["base"]] == [("email", 600_000), ("ip", 600_013)]
    masked = P.mask(frame(rows), tagger)
    assert masked.columns == frame(rows).columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[1] == "call [PHONE] or [EMAIL], [EMAIL]" and texts[2] is None and texts[3] == "" and texts[4] == "w " * 300_000 + "[EMAIL] [IP] " + "w " * 300_000


def test_empty_table_and_no_matches(spark, frame):
    for rows in ([], [(1, "plain words only")], [(1, "3 words 4")]):
        tagger = P.train(frame(rows))
        assert [r["spans"] for r in P.find(frame(rows), tagger).collect()] == [[]] * len(rows)


def test_codes():
    assert codes("aé٣—𝒳").tolist() == [97, 128, 129, 130, 130]
