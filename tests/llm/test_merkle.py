import hashlib
import zlib

import pytest

from claimlake.llm import merkle as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def written_as(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, more=0):
    n = None if row["n_chars"] is None else row["n_chars"] + more
    return sha("".join(written_as(v) for v in (row["doc_id"], row["source"], row["lang"], n, row["text"])))


def tree(leaves):
    """(root, per leaf the steps to it as (sibling or '', it stands left))."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i : i + 2])) for i in range(0, len(x), 2)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for x in levels[:-1]:
            path.append((x[i ^ 1], i & 1) if i ^ 1 < len(x) else ("", 0))
            i //= 2
        paths.append(path)
    return levels[-1][0], paths


def fold(h, path):
    for sibling, left in path:
        h = sha(sibling + h if left else h + sibling)
    return h


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    names = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    subs = {}
    for k in names:
        by[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subs[k] = tree([leaf(r) for r in by[k]])
    root, tops = tree([subs[k][0] for k in names])
    out = []
    for k, top in zip(names, tops):
        for r, path in zip(by[k], subs[k][1]):
            path = path + top
            forged = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            end = fold(leaf(r, forged), path)
            out.append((r["doc_id"], leaf(r), subs[k][0], root, sha("".join(x for x, _ in path)), end, end == root))
    return sorted(out, key=str)


@pytest.fixture
def run(spark, tmp_path):
    def make(rows, parts=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], schema)
        for name in ("tree", "leaf", "pos", "n", "block", "path", "forged", "at", "part", "root"):
            df = df.selectExpr("*", f"'x' AS {name}")
        path = str(tmp_path / f"d{len(rows)}")
        df.repartition(parts).write.parquet(path + "/documents.parquet")
        return M.op11_merkle(spark, path)

    return make


def doc(i, lang="en", text=None, source="web", n=None):
    text = f"text {i}" if text is None else text
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": len(text) if n is None else n}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("levels", [2, 12])
def test_sizes_of_trees(run, monkeypatch, levels):
    """Trees of 1 to 70 leaves, with builders of 4 leaves (several rounds above them) and of 4,096."""
    monkeypatch.setattr(M, "LEVELS", levels)
    rows = [doc(1000 * k + i, f"l{k}") for k, size in enumerate([1, 2, 3, 4, 5, 8, 9, 16, 17, 33, 70]) for i in range(size)]
    got = run(rows)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(got) == plain(rows)
    assert {r["verified"] for r in got.collect()} == {True, False}


def test_odd_rows(run):
    null = dict.fromkeys(("doc_id", "text", "lang", "source", "n_chars"))
    rows = [doc(i, lang) for i, lang in enumerate(["en", None, "", "-", "=", "é", "z", None])]
    rows += [null, null, doc(3), doc(3), doc(3, text="other"), doc(None), doc(10, text=""), doc(11, text="é" * 300_000), {**doc(18), "n_chars": None}, {**doc(19), "n_chars": (1 << 63) - 1}, doc((1 << 63) - 1), doc(-5)]
    assert rows_of(run(rows)) == plain(rows)


def test_one_language_of_almost_all_rows(run, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 3)
    rows = [doc(i, "en" if i % 9 else "de") for i in range(400)]
    assert rows_of(run(rows, parts=11)) == plain(rows)


def test_a_single_row_is_its_own_root(run):
    (r,) = run([doc(1)]).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == sha("")


def test_empty_table(run):
    assert run([]).count() == 0


def test_places_follow_the_order_of_completion():
    for n in range(1, 70):
        nodes = list(M.completed([bytes([i]) for i in range(n)], M.height(n)))
        assert [M.place(level, i, n) for level, i, _ in nodes] == list(range(len(nodes)))


def test_the_log_holds_every_node_once(spark, monkeypatch):
    """Pieces of log and the nodes above them fill the places of each tree without a gap."""
    monkeypatch.setattr(M, "LEVELS", 3)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trees, _, rows = M.manifest(spark, docs)
    for name, n in trees.roots.select("tree", "n").collect():
        places = {r["at"] + i for r in trees.log.where(f"tree = '{name}'").collect() for i in range(len(r["nodes"]) // 32)}
        places |= {r["at"] for r in trees.tops.where(f"tree = '{name}'").collect()}
        assert places == set(range(M.place(M.height(n), 0, n) + 1))
    assert rows.count() == docs.count() and rows.where(M.folded("leaf") != M.F.col("root")).count() == 0
