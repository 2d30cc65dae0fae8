"""Merkle manifest of a dataset as a postorder append log.

Every row is a leaf, and rows of one language make a tree, by id. Two consecutive nodes
(the last one of a level alone if their number is odd) become the hash of their
hexadecimal digests, level by level. The trees' roots make one more tree.

Builders are aligned: one takes 2^12 consecutive leaves of a tree and appends a node as soon as it
is complete, a parent right behind its last child. A node's place in that order needs no index:
before the first leaf s of its subtree stand 2 s - popcount(s) nodes, and a subtree over m
leaves and l levels holds the sum of ceil(m / 2^j) for j up to l. Builders of
2^12 block roots, then of their roots, complete the levels above, at places by the same
rule. A proof looks up its siblings by their places: the lower ones in the one piece of log that
the leaf's own builder wrote, the upper ones, the same for a whole block, by a join on place.

Leaves are numbered by a range sort with counts per part, so one language may hold any share of
the rows: no task holds more than its sorted part, or one block of leaves.

Rows: null columns are written "-". Null languages are a tree of their own, before all others.
Null ids come first in their tree; equal ids are ordered by their leaves' hashes, and rows alike
in all columns are leaves side by side (they meet in one part of the sort). Texts of any length
are hashed whole. An empty table gives no rows. Columns beside the five of ``documents`` are left
out, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from claimlake.llm.common import stage, table

#: A builder completes subtrees of 2^LEVELS leaves.
LEVELS = 12

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: boolean, hash: string>>"


def written_as(value: Column) -> Column:
    """"-" for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(written_as, values)), 256)


def above(digests: str) -> bytes:
    """The hash of joined hexadecimal digests."""
    return hashlib.sha256(digests.encode()).digest()


def height(n: int) -> int:
    return (n - 1).bit_length()


def place(level: int, index: int, n: int) -> int:
    """The place, in completion order, of a node of a tree with n leaves."""
    first = index << level
    m = min(n - first, 1 << level)
    return 2 * first - first.bit_count() + sum((m + (1 << j) - 1) >> j for j in range(level + 1)) - 1


def place_column(level: Column, index: Column, n: Column) -> Column:
    """``place`` for columns named level, index and n."""
    return F.expr("""
        2 * shiftleft(index, level) - bit_count(shiftleft(index, level)) - 1
        + aggregate(sequence(0, level), 0L, (a, j) -> a + shiftright(least(n - shiftleft(index, level), shiftleft(1L, level)) + shiftleft(1L, j) - 1, j))""")


def completed(leaves: list[bytes], top: int):
    """(level, index, digest) of every node over these leaves up to level ``top``, each as soon as it is complete."""
    waiting = [b""] * (top + 1)
    for i, node in enumerate(leaves):
        yield 0, i, node
        for level in range(top):
            if i >> level & 1:
                node = above(waiting[level].hex() + node.hex())
            elif i == len(leaves) - 1:
                node = above(node.hex())
            else:
                waiting[level] = node
                break
            yield level + 1, i >> (level + 1), node


@dataclass
class Forest:
    """``rows``: the leaves with ``tree``, ``pos``, ``n`` and their other columns. ``log``: a row
    per builder of leaves (tree, block, n, at, nodes): ``nodes`` are the digests, 32 bytes each, of
    the places from ``at`` on. ``tops`` (tree, n, level, index, at, node): the nodes above those
    builders, and their roots. ``roots`` (tree, n, root)."""

    rows: DataFrame
    log: DataFrame
    tops: DataFrame
    roots: DataFrame


def _placed(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, from 0 on in each tree by ``order``, and the tree's ``n``."""
    order = ["tree", *order]
    ordered = stage(spark, rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("at", 33).alias("part")
    counts = ordered.groupBy(part, "tree").agg(F.count(F.lit(1)).alias("held"), F.min("at").alias("first"))
    before = F.sum("held").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", "tree", "first", F.coalesce(before, F.lit(0)).alias("start"), F.sum("held").over(Window.partitionBy("tree")).alias("n"))
    starts = stage(spark, starts, "starts")
    placed = ordered.withColumn("part", part).join(starts, ["part", "tree"])
    return placed.withColumn("pos", F.col("start") + F.col("at") - F.col("first")).drop("part", "at", "first", "start")


def build(spark: SparkSession, rows: DataFrame, order: list[str]) -> Forest:
    """Trees over ``rows``, which have ``tree`` (never null) and ``leaf`` (binary)."""
    rows = _placed(spark, rows, order).withColumn("block", F.shiftright("pos", LEVELS))

    def builder(group: pa.Table) -> pa.Table:
        tree, block, n = (group.column(c)[0].as_py() for c in ("tree", "block", "n"))
        ids = np.argsort(group.column("pos").to_numpy())
        leaves = group.column("leaf").take(pa.array(ids)).to_pylist()
        nodes = b"".join([x for _, _, x in completed(leaves, min(LEVELS, height(n)))])
        return pa.table({"tree": [tree], "block": pa.array([block], pa.int64()), "n": pa.array([n], pa.int64()), "at": pa.array([place(0, block << LEVELS, n)], pa.int64()), "nodes": pa.array([nodes], pa.binary())})

    log = rows.select("tree", "block", "n", "pos", "leaf").groupBy("tree", "block").applyInArrow(builder, "tree string, block long, n long, at long, nodes binary")
    log = stage(spark, log, "log")
    tall = F.expr("CASE WHEN n = 1 THEN 0 ELSE length(bin(n - 1)) END")
    root = F.expr("substring(nodes, -32, 32)")
    tops = [log.where(F.col("n") > 1 << LEVELS).select("tree", "n", F.lit(LEVELS).alias("level"), F.col("block").alias("index"), (F.col("at") + F.length("nodes") / 32 - 1).cast("long").alias("at"), root.alias("node"))]
    largest = log.agg(F.max("n")).first()[0] or 0
    base = LEVELS

    def upper(base: int):
        def job(group: pa.Table) -> pa.Table:
            group = group.sort_by("index")
            tree, n, start = (group.column(c)[0].as_py() for c in ("tree", "n", "index"))
            found = [(base + level, (start >> level) + i, x) for level, i, x in completed(group.column("node").to_pylist(), min(LEVELS, height(n) - base)) if level]
            levels, ids, nodes = zip(*found)
            places = [place(level, i, n) for level, i in zip(levels, ids)]
            return pa.table({"tree": [tree] * len(found), "n": pa.array([n] * len(found), pa.int64()), "level": pa.array(levels, pa.int32()), "index": pa.array(ids, pa.int64()), "at": pa.array(places, pa.int64()), "node": pa.array(nodes, pa.binary())})

        return job

    while largest > 1 << base:  # twelve levels a round: three rounds for 10^13 leaves
        below = tops[-1].where((F.col("level") == base) & (F.col("n") > F.lit(1 << base)))
        keys = [F.col("tree"), F.shiftright("index", LEVELS).alias("block")]
        tops.append(stage(spark, below.groupBy(*keys).applyInArrow(upper(base), "tree string, n long, level int, index long, at long, node binary"), "tops"))
        base += LEVELS
    all_tops = tops[0]
    for t in tops[1:]:
        all_tops = all_tops.unionByName(t)
    roots = log.where(F.col("n") <= 1 << LEVELS).select("tree", "n", root.alias("root")).unionByName(all_tops.where(F.col("level") == tall).select("tree", "n", F.col("node").alias("root")))
    return Forest(rows, log, all_tops, roots)


def _upper_paths(forest: Forest) -> DataFrame:
    """tree, block and ``path``: the siblings, or none, of each level above a block, bottom first."""
    tall = F.expr("length(bin(n - 1))")
    steps = forest.log.where(F.col("n") > 1 << LEVELS).select("tree", "block", "n", F.explode(F.sequence(F.lit(LEVELS), tall - 1)).alias("level"))
    steps = steps.withColumn("own", F.expr(f"shiftright(block, level - {LEVELS})")).withColumn("index", F.col("own").bitwiseXOR(1))
    there = F.expr("shiftleft(index, level) < n")
    steps = steps.withColumn("at", F.when(there, place_column(F.col("level"), F.col("index"), F.col("n"))))
    found = steps.join(forest.tops.select("tree", "at", "node"), ["tree", "at"], "left")
    step = F.struct("level", F.when(there, F.col("index") < F.col("own")).alias("left"), F.lower(F.hex("node")).alias("hash"))
    paths = found.groupBy("tree", "block").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return paths.select("tree", "block", F.expr("transform(steps, s -> struct(s.left AS left, s.hash AS hash))").alias("path"))


def prove(forest: Forest, keep: list[str], roots: DataFrame | None = None) -> DataFrame:
    """``keep`` columns of the leaves, ``tree`` and ``path``: a step per level with the sibling's
    hash and whether it stands to the left; a level where the node stands alone has no hash.
    ``roots`` (tree, path): a path that goes on above the tree's root."""
    blocks = forest.log.join(_upper_paths(forest), ["tree", "block"], "left")
    none = F.expr(f"cast(array() AS {_PATH})")
    more = none
    if roots is not None:
        blocks = blocks.join(roots.select("tree", F.col("path").alias("beyond")), "tree")
        more = F.col("beyond")
    blocks = blocks.select("tree", "block", "n", "nodes", F.concat(F.coalesce("path", none), more).alias("upper"))
    rows = forest.rows.select("tree", "block", "pos", *keep)
    out = rows.select("tree", *keep).schema

    def extract(leaves: pa.Table, written: pa.Table) -> pa.Table:
        m, n = len(leaves), written.column("n")[0].as_py()
        digits = written.column("nodes")[0].as_py().hex()
        hashes = np.array([digits[i : i + 64] for i in range(0, len(digits), 64)] + [None], object)
        own = leaves.column("pos").to_numpy() & ((1 << LEVELS) - 1)
        tail = written.column("upper")[0].as_py()
        levels = min(LEVELS, height(n))
        left = np.empty((m, levels + len(tail)), object)
        value = np.empty((m, levels + len(tail)), object)
        for level in range(levels):
            sibling = (own >> level) ^ 1
            first = sibling << level
            size = sum((np.minimum(m - first, 1 << level) + (1 << j) - 1) >> j for j in range(level + 1))
            there = first < m
            at = np.where(there, 2 * first - np.bitwise_count(first) + size - 1, -1)
            value[:, level] = hashes[at]
            left[:, level] = np.where(there, sibling < (own >> level), None)
        for i, step in enumerate(tail):
            left[:, levels + i], value[:, levels + i] = step["left"], step["hash"]
        steps = pa.StructArray.from_arrays([pa.array(left.ravel(), pa.bool_()), pa.array(value.ravel(), pa.string())], ["left", "hash"])
        paths = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * left.shape[1]), steps)
        return leaves.select(["tree", *keep]).append_column("path", paths)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.fields)
    return rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(extract, f"{fields}, path {_PATH}")


def folded(leaf: str, path: str = "path") -> Column:
    """The root that a leaf (hexadecimal) and a path lead to."""
    return F.expr(f"aggregate({path}, {leaf}, (h, s) -> sha2(CASE WHEN s.hash IS NULL THEN h WHEN s.left THEN concat(s.hash, h) ELSE concat(h, s.hash) END, 256))")


def siblings_hash(path: str = "path") -> Column:
    """The hash of a path's siblings, bottom first."""
    return F.expr(f"sha2(array_join(transform({path}, s -> s.hash), ''), 256)")


def manifest(spark: SparkSession, docs: DataFrame, forged: Column | None = None) -> tuple[Forest, Forest, DataFrame]:
    """The languages' forest, the tree of their roots, and per document: doc_id, leaf, subroot, root
    and path (a step per level up to the root). ``forged``: a condition under which ``forged``
    holds the leaf as if n_chars were one more (else null)."""
    values = [F.col(f"`{c}`") for c in FIELDS]
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    other = leaf_hash(*[more if c == "n_chars" else F.col(f"`{c}`") for c in FIELDS])
    hashed = F.when(forged, F.unhex(other)) if forged is not None else F.lit(None).cast("binary")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"), "doc_id", F.unhex(leaf_hash(*values)).alias("leaf"), hashed.alias("forged"))
    trees = build(spark, rows, ["doc_id", "leaf"])
    names = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"))
    crown = build(spark, names, ["name"])
    root = crown.roots.select(F.lower(F.hex("root")).alias("root")).first()
    crowned = prove(crown, ["name", "leaf"]).select(F.col("name").alias("tree"), F.lower(F.hex("leaf")).alias("subroot"), F.lit(root and root["root"]).cast("string").alias("root"), "path")
    crowned = stage(spark, crowned, "crown")
    proved = prove(trees, ["doc_id", "leaf", "forged"], crowned).join(crowned.select("tree", "subroot", "root"), "tree")
    hexed = {c: F.lower(F.hex(c)) for c in ("leaf", "forged")}
    return trees, crown, proved.select("doc_id", hexed["leaf"].alias("leaf"), hexed["forged"].alias("forged"), "subroot", "root", "path")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    _, _, rows = manifest(spark, table(spark, sf_dir, "documents"), tampered)
    rows = rows.withColumn("proof_sha256", siblings_hash()).withColumn("start", F.coalesce("forged", "leaf")).withColumn("folded_root", folded("start"))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


def _levels_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, i, n, h), level by level."""
    return f"""{name} AS (
    SELECT tree, 0 AS level, i, n, h FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(right_h, ''))
    FROM (SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY i) AS right_h FROM {name} WHERE n > 1) WHERE i % 2 = 0)"""


#: The tampered rows' CRC-32 is taken bit by bit over the id's digits.
OP11_SQL = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, lang, {_leaf_sql()} AS leaf, {_leaf_sql('CAST(n_chars AS HUGEINT) + 1')} AS forged,
           list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
                       lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
    FROM documents),
ranked AS (
    SELECT *, coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM docs),
base AS (SELECT tree, i, n, leaf AS h FROM ranked),
{_levels_sql('nodes', 'base')},
subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
crown AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h, tree AS name FROM subroots),
{_levels_sql('crown_nodes', 'crown')},
root AS (SELECT h AS root FROM crown_nodes WHERE n = 1),
every_node AS (SELECT 0 AS tier, * FROM nodes UNION ALL SELECT 1, * FROM crown_nodes),
fold AS (
    SELECT r.doc_id, r.leaf, s.h AS subroot, c.i AS crown_i, c.n AS crown_n, 0 AS tier, r.tree, 0 AS level, r.i, r.n, '' AS proof,
           CASE WHEN xor(r.crc, 4294967295) % 7 = 0 THEN r.forged ELSE r.leaf END AS h
    FROM ranked r JOIN subroots s USING (tree) JOIN crown c ON c.name = r.tree
    UNION ALL
    SELECT f.doc_id, f.leaf, f.subroot, f.crown_i, f.crown_n, CASE WHEN f.n = 1 THEN 1 ELSE f.tier END, CASE WHEN f.n = 1 THEN '' ELSE f.tree END,
           CASE WHEN f.n = 1 THEN 0 ELSE f.level + 1 END, CASE WHEN f.n = 1 THEN f.crown_i ELSE f.i // 2 END, CASE WHEN f.n = 1 THEN f.crown_n ELSE (f.n + 1) // 2 END,
           CASE WHEN f.n = 1 THEN f.proof ELSE f.proof || coalesce(s.h, '') END,
           CASE WHEN f.n = 1 THEN f.h WHEN f.i % 2 = 1 THEN sha256(s.h || f.h) ELSE sha256(f.h || coalesce(s.h, '')) END
    FROM fold f LEFT JOIN every_node s ON s.tier = f.tier AND s.tree = f.tree AND s.level = f.level AND s.i = xor(f.i, 1)
    WHERE f.n > 1 OR f.tier = 0)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM fold, root WHERE tier = 1 AND n = 1
"""
