import random

import numpy as np
import pytest

from claimlake.llm import decontam as D


def edited(text, rate, rng):
    x = list(text)
    for _ in range(int(rate * len(x))):
        at, how = rng.randrange(len(x)), rng.randrange(3)
        if how == 0:
            x[at] = rng.choice("abcdefghij ")
        elif how == 1:
            del x[at]
        else:
            x.insert(at, rng.choice("abcdefghij "))
    return "".join(x)


@pytest.fixture(scope="module")
def bench(prose):
    return [(i, prose(random.Random(i).randint(12, 50), 30_000 + i).capitalize() + ".") for i in range(60)]


def leaks(spark, docs, bench, **more):
    items = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "1 AS doc", "2 AS n")
    return {(r["doc"], r["item"]): r["distance"] for r in D.leaks(docs, items, **more).collect()}


def test_infix_distances_equal_the_plain_recursion():
    rng = random.Random(1)
    items, windows, want = [], [], []
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [row[0] + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
            row = new
        items.append(a), windows.append(b), want.append(min(row))
    assert D.infix_distances(items, windows).tolist() == want


def test_exact_and_edited_passages_are_found_and_clean_texts_left_alone(spark, frame, prose, bench):
    """Recall against exact search over all windows, by rate of edits."""
    rng = random.Random(5)
    rows, near = [], {}
    for k, rate in enumerate([0.0, 0.02, 0.05, 0.08]):
        for i, t in bench:
            doc = 1000 * k + i
            text = f"{prose(rng.randint(0, 80), doc)} {edited(t, rate, rng)} {prose(rng.randint(0, 80), 9000 + doc)}"
            rows.append((doc, text))
            item = D.normal(t.encode())
            near[doc, i] = int(D.infix_distances([item], [D.normal(text.encode())])[0])
    clean = [(50_000 + i, prose(120, 70_000 + i)) for i in range(200)]
    got = leaks(spark, frame(rows + clean), bench)
    within = {x for x, d in near.items() if d <= 0.1 * len(D.normal(dict(bench)[x[1]].encode()))}
    for k in range(4):
        own = {x for x in within if x[0] // 1000 == k}
        assert len(own & set(got)) >= 0.9 * len(own) and (k or own <= set(got))
    assert set(got) <= within and all(got[x] >= near[x] for x in got)
    assert all(d == 0 for x, d in got.items() if x[0] < 1000)


def agreement(one, other, size=64):
    """Share of tables in which the windows at the head of two texts agree."""
    at = np.zeros(1, np.int64)
    letters = [D._folded(np.concatenate([D._codes(t), np.zeros(size, np.uint32)])) for t in (one, other)]
    keys = [np.array([k[0] for w in range(D.WALKS) for k in D.Walk(size, w).keys(x, at)]) for x in letters]
    return (keys[0] == keys[1]).mean()


def test_walks_fall_into_step_again():
    rng = random.Random(2)
    text, other = ("".join(rng.choice("abcdefgh ") for _ in range(160)) for _ in range(2))
    assert agreement(text, text) == 1 and agreement(text, other) == 0
    assert agreement(text, text[:20] + "z" + text[21:]) > 0.1 and agreement(text, text[:20] + text[21:]) > 0.1


def test_case_space_and_signs_do_not_matter(spark, frame, bench):
    t = bench[3][1]
    rows = [(1, t.upper()), (2, t.replace(" ", "\n  ")), (3, "<b>" + t.replace(" ", "** ") + "</b>")]
    assert {x[0] for x in leaks(spark, frame(rows), bench) if x[1] == 3} == {1, 2, 3}


def test_odd_rows(spark, frame, prose, bench):
    item = bench[0][1]
    odd = [*bench, (100, None), (101, ""), (102, "two words"), (103, item), (None, item), (104, "three short words")]
    long = prose(120_000, 3) + " " + item + " " + prose(1000, 4)
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, long), (5, "ab ab " * 50_000), (6, "now three short words stand here"), (7, "two words")]
    got = leaks(spark, frame(rows), odd)
    assert {x for x in got} == {(d, i) for d in (3, None, 4) for i in (0, 103)} | {(6, 104), (7, 102)}
    assert leaks(spark, frame(rows), []) == {} and leaks(spark, frame([]), bench) == {}


def test_many_items_come_in_blocks(spark, frame, bench, monkeypatch):
    rows = [(i, t) for i, t in bench]
    whole = leaks(spark, frame(rows), bench)
    monkeypatch.setattr(D, "BLOCK_BYTES", 3000)
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert len(list(D.blocks(items, 0.9))) > 2
    assert leaks(spark, frame(rows), bench) == whole
    kept = D.without_leaks(frame([*rows, (999, "clean text of a few words"), (998, None)]), items)
    assert kept.columns == frame(rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [998, 999]


def test_windows_of_two_rows_do_not_meet(bench):
    block = D.Block(bench, 0.9)
    words = bench[0][1].encode().split(b" ")
    halves = b" ".join(words[: len(words) // 2]), b" ".join(words[len(words) // 2 :])
    data = np.frombuffer(b"".join(halves), np.uint8)
    at = np.array([0, len(halves[0]), len(data)])
    assert block.found(data, at) == []


def test_near_copy_of_a_very_long_item():
    item = ("abcdefghij" * 4000).encode()
    assert D.infix_distances([item], [item[:20_000] + b"z" + item[20_001:39_000]]).tolist() == [1001]


def found(block, raw, **more):
    raw = raw.encode()
    return {x: d for _, x, d in block.found(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), **more)}


def worse(text, edits, clustered, rng):
    """Characters changed, lost or put in, at will or near one place."""
    x, middle = list(text), rng.randrange(len(text))
    for _ in range(edits):
        low, high = (middle - 2 * edits, middle + 2 * edits + 1) if clustered else (0, len(x))
        at, how = rng.randrange(max(0, min(low, len(x) - 1)), max(1, min(high, len(x)))), rng.randrange(3)
        x[at : at + (how < 2)] = [] if how == 1 else [rng.choice("abcdefghij")]
    return "".join(x)


LENGTHS = {"one": (1, 1), "two": (2, 2), "few": (3, 11), "some": (12, 50), "many": (51, 120), "unspaced": None}


@pytest.mark.parametrize("name", LENGTHS)
def test_recall_by_length_against_exact_search(prose, name):
    """Whole recall, wherever the edits stand; the tables alone find most of it."""
    rng = random.Random(name)
    if LENGTHS[name]:
        texts = [prose(rng.randint(*LENGTHS[name]), 40_000 + i) for i in range(12)]
    else:
        texts = ["".join(chr(rng.randrange(0x4E00, 0x4F00)) for _ in range(rng.randint(70, 120))) for _ in range(12)]
    block = D.Block(list(enumerate(texts)), 0.9)
    want = tables = spread = 0
    for k, t in enumerate(block.texts):
        for clustered in (False, True):
            for part in (0.0, 0.5, 1.0):
                raw = f"{prose(20, k)} - {worse(t, int(part * block.edits[k]), clustered, rng)} \n {prose(20, k + 1)}"
                row = D.normal(raw.encode()).decode()
                near = D.infix_distances(block.texts, [row] * len(block.texts)).tolist()
                leak = {x for x, d in enumerate(near) if d <= block.edits[x]}
                got = found(block, raw)
                assert set(got) == leak and all(got[x] >= near[x] for x in got)
                if not clustered:
                    want += len(leak)
                    spread += len(leak & set(found(block, raw, pieces=False)))
    assert want >= 30
    if name in ("some", "many", "unspaced"):
        assert spread >= 0.85 * want


def test_items_of_two_words_and_edits_in_every_bigram_are_found():
    block = D.Block([(1, "copper lantern")], 0.9)
    assert found(block, "x y copper lantern z") == {0: 0}
    words = "seventeen marvellous adventurers quietly discovered forgotten manuscripts underneath abandoned monastery libraries anciently containing priceless parchments".split()
    bad = [w if k in (0, len(words) - 1) else w[:2] + "0" + w[3:] for k, w in enumerate(words)]
    block = D.Block([(1, " ".join(words))], 0.9)
    assert len(words) - 2 <= block.edits[0] and found(block, "before " + " ".join(bad) + " after") == {0: len(words) - 2}


def test_distances_count_characters():
    item = "これは公開された評価問題の本文であり空白がない"  # 23 characters, two edits
    block = D.Block([(1, item)], 0.9)
    assert found(block, "前文" + item[:5] + "x" + item[6:12] + "y" + item[13:] + "後文") == {0: 2}
    assert found(block, item[:5] + "x" + item[6:12] + "y" + item[13:18] + "z" + item[19:]) == {}


def test_passes_and_order_of_rows_do_not_matter(prose, bench):
    block = D.Block(bench, 0.9)
    rows = [prose(30, 7) + " " + bench[5][1], "", bench[6][1] + " " + prose(9, 8)]
    raw = [r.encode() for r in rows]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = sorted(block.found(np.frombuffer(b"".join(raw), np.uint8), at))
    assert together == [(0, 5, 0), (2, 6, 0)] and [found(block, r) for r in rows] == [{5: 0}, {}, {6: 0}]
