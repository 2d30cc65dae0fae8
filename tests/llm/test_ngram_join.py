import random

import numpy as np
import pyarrow as pa
import pytest

from claimlake.llm import common, ngram_join
from claimlake.llm.components import components


def brute(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((root(x), root(y)))
                up[q] = p
    return {d: (len(sets[d]), root(d)) for d in ids}


def joined(spark, df, k, percent):
    return {r["doc"]: (r["n"], r["component"]) for r in ngram_join.ngram_join(spark, df, k, percent)[2].collect()}


def near_copies(prose, seed, groups=12):
    rng = random.Random(seed)
    rows, doc = [], 0
    for g in range(groups):
        base = prose(rng.choice([3, 5, 8, 30, 90, 200]), seed * 100 + g).split(" ")
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = [rng.choice(base + ["new", "words"])] * rng.randint(0, 2)
                w = w or ["x"]
            rows.append((doc, rng.choice([" ", "\n", "  "]).join(w).replace("ka", rng.choice(["ka", "KA"]))))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent,seed", [(4, 85, 1), (5, 80, 2), (2, 50, 3)])
def test_components_equal_all_pairs(spark, frame, prose, k, percent, seed):
    rows = near_copies(prose, seed) + [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "One"), (1004, "one"), (1005, "one two"), (1006, "ONE\x0btwo")]
    assert joined(spark, frame(rows), k, percent) == brute(rows, k, percent)


def test_a_large_group_of_copies_and_a_passage_in_every_text(spark, frame, prose):
    passage = prose(30, 5)
    copies = [(i, prose(60, 6)) for i in range(150)]
    chained = [(200 + i, " ".join(prose(60, 7).split(" ")[i : i + 55])) for i in range(6)]
    others = [(300 + i, f"{prose(40, 900 + i)} {passage} {prose(40, 950 + i)}") for i in range(40)]
    rows = copies + chained + others
    assert joined(spark, frame(rows), 4, 85) == brute(rows, 4, 85)


def test_very_long_text_is_read_in_parts(prose):
    text = (" ".join(prose(1000, 1) for _ in range(150)) + " ").encode()
    assert len(text) > common.PASS_BYTES
    data = np.frombuffer(text, np.uint8)
    whole, at = common.word_hashes(data, np.array([0, len(data)]))
    words = text.split()
    assert len(whole) == len(words) == at[-1]
    one = np.frombuffer(b"\n".join(words[:50]), np.uint8)
    assert (common.word_hashes(one, np.array([0, len(one)]))[0] == whole[:50]).all()


def test_empty_table(spark, frame):
    assert joined(spark, frame([]), 4, 85) == {}


def test_links_are_verified_pairs(spark, frame, prose):
    rows = near_copies(prose, 9)
    sets, links, _ = ngram_join.ngram_join(spark, frame(rows), 4, 85)
    want = brute(rows, 4, 85)
    for r in links.collect():
        assert want[r["a"]][1] == want[r["b"]][1]
    assert links.count() == links.distinct().count()


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y = (rng.integers(0, 3000, rng.integers(1, 2500), dtype=np.uint64) for _ in range(2))
        x, y = np.unique(x), np.unique(y)
        count = lambda s: np.minimum(np.bincount((s % 4).astype(int), minlength=128), 255).astype(np.uint8)[None]
        bound = ngram_join._bound(np.array([len(x)]), np.array([len(y)]), count(x), count(y))[0]
        assert bound >= len(np.intersect1d(x, y))


def test_prefix_groups_survive_batch_edges(spark):
    keys = [1, 2, 2, 3, 4, 4, 4, 5, 6, 6]
    sizes = [9, 9, 9, 9, 9, 9, 9, 9, 5, 9]  # the last two are too far apart
    df = spark.createDataFrame([(k, s << 32, i) for i, (k, s) in enumerate(zip(keys, sizes, strict=True))], "key long, at long, doc long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = sorted(r["doc"] for r in ngram_join._shared(df, 80).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [1, 2, 4, 5, 6]


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(5, i) for i in range(30)], [(9, 3), (3, 9), (7, 8), (8, 2), (9, None)]])
def test_components(spark, links):
    up = {}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            up.setdefault(a, a), up.setdefault(b, b)
            p, q = sorted((root(a), root(b)))
            up[q] = p
    got = {r["vertex"]: r["component"] for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}


def test_id_filter_keeps_every_wanted_row(spark):
    ids = spark.range(0, 2000, 7).withColumnRenamed("id", "doc")
    rows = spark.range(2000).withColumnRenamed("id", "doc")
    bits = common.id_filter(ids, "doc")
    kept = {r["doc"] for r in common.maybe_in(rows, "doc", bits).collect()}
    left = {r["doc"] for r in common.maybe_in(rows, "doc", bits, inside=False).collect()}
    assert set(range(0, 2000, 7)) <= kept and kept | left == set(range(2000)) and not kept & left


def test_text_views_of_slices_and_nulls():
    data, at = common.text_views(pa.array(["ab", None, "é", "", "xyz"]).slice(1, 3))
    assert bytes(data) == "é".encode() and at.tolist() == [0, 0, 2, 2]


def test_partnered_equals_all_pairs():
    rng = np.random.default_rng(4)
    for percent in (50, 80, 85):
        key = np.sort(rng.integers(0, 40, 400))
        n = rng.integers(1, 60, 400)
        at = (n << 32) | rng.integers(0, n)
        o = np.lexsort((at, key))
        key, at = key[o], at[o]
        want = np.zeros(400, bool)
        for i, j in ngram_join._meetings(key, at, percent):
            want[i] = want[j] = True
        assert ngram_join._partnered(key, at, percent).tolist() == want.tolist()
    assert want.any() and not want.all()


def test_a_large_group_is_linked_in_linear_time_and_room():
    n = 20_000  # near copies of one size: 200 million pairs
    key, at, ranges = np.ones(n, np.int64), np.full(n, 100 << 32), np.ones((n, 128), np.uint8)
    assert ngram_join._partnered(key, at, 85).all()
    i, j = ngram_join._nearest(key, at, ranges, 85)
    assert len(i) == 2 * (n - 1) and set(j.tolist()) == set(range(1, n)) and (i < j).all()


def test_groups_in_chunks_equal_all_pairs(spark, frame, prose, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    monkeypatch.setattr(ngram_join, "NEAR", 1)
    base = prose(40, 8).split(" ")
    rows = [(i, " ".join([*base[: i % 30 + 5], f"w{i}", *base[i % 30 + 6 :]])) for i in range(20)]
    assert joined(spark, frame(rows), 4, 70) == brute(rows, 4, 70)


def test_cross_pairs_in_chunks_are_all_pairs_of_different_components(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    comp = [0] * 11 + [11] * 6 + [17, 18, 18, 20, 21]
    members = spark.createDataFrame([(1, 50 << 32, d, c) for d, c in enumerate(comp)] + [(2, 50 << 32, 0, 0), (2, 50 << 32, 17, 17)], "key long, at long, doc long, comp long")
    features = spark.createDataFrame([(d, bytes([1] * 128)) for d in range(len(comp))], "doc long, ranges binary")
    got = {(r["a"], r["b"]) for r in ngram_join._cross_pairs(members, features, 80).collect()}
    want = {(a, b) for b in range(len(comp)) for a in range(b) if comp[a] != comp[b]}
    assert got == want


def test_sketches_never_rule_a_link_out():
    rng = np.random.default_rng(6)
    sets = []
    for n in (1, 5, 60, 300, 9000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for part in (0, 0.05, 0.5, 1):
            sets.append(np.unique(np.concatenate([base[int(part * n) :], rng.integers(0, 1 << 63, int(part * n) + 1, dtype=np.uint64)])))
    packed = np.empty(len(sets), object)
    packed[:] = [ngram_join._sketch(s) for s in sets]
    i, j = np.triu_indices(len(sets), 1)
    apart = ngram_join.Sketches(packed).apart(i, j)
    true = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)])
    assert (apart <= true).all()
    alike = (np.maximum(i, j) < 16) & (true < 150) & (i // 4 == j // 4)
    assert alike.any() and (apart[alike] >= 0.7 * true[alike] - 1).all()


def test_near_copies_below_the_threshold_are_not_named_pair_by_pair(spark, frame, prose, monkeypatch):
    """Each of 120 copies has changes of its own: some 7,000 pairs share most shingles, none is linked."""
    named = {}
    stage = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", lambda spark, df, label, *paths: named.setdefault(label, []).append(stage(spark, df, label, *paths)) or named[label][-1])
    rng, base = random.Random(7), prose(200, 77).split(" ")
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(200), 5):
            w[at] = f"own{i}x{at}"
        rows.append((i, " ".join(w)))
    got = joined(spark, frame(rows), 4, 85)
    assert got == brute(rows, 4, 85)
    pairs = sum(df.count() for label in ("likely", "best", "rest") for df in named.get(label, []))
    assert pairs < 1200
