"""Exact top-k search by inner product with dual cover trees.

Vectors are dealt into blocks of about BLOCK rows: by the nearest of a few pivots, taken
from a bounded sample, and by hash within a pivot, so that a crowded pivot (a vector
that a third of the rows repeat) makes more blocks, not larger ones. Each task holds a
block's rows and builds a cover tree over them: a node's points lie within its covering
radius of its centre, and the centres of its children are more than half that apart.

Queries come to every block in groups with a tree of their own. Pairs of a query node
and a data node are visited together, best bound first; the bound on any inner product
between the two follows from their centres and covering radii. A pair is pruned when
the bound is below the worst kth score of the node's queries (or equal to it, where
none of the node's ids could win a tie). Two leaves are compared point by point, in exact
integers.

To prune from the start, every query first searches one block near it; the kth score
found there is its floor in all others. The blocks' answers, k each, are then merged.

Queries are a stated share of the rows; all rows are candidates, none is left out.
Rows whose id or vector is null, or whose vector holds nulls or non-finite values, take
no part; vectors of another length than the query's are not compared with it. Rows that
share the query's id are its own. Scores must fit in 63 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimlake.llm.common import stage, table, tidy

BLOCK = 4096
#: Queries that search a block together.
GROUP = 512
LEAF = 32
#: Points that a node's children hold on average, at least.
FILL = 4
PIVOTS = 16
#: Rows that the pivots are chosen from.
SAMPLE = 2048


class CoverTree:
    """Nodes as arrays: centre (a point), radius, children or a range of points, least id."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.points, self.ids = points, ids
        self.real = points.astype(np.float64)
        self.center: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.members: list[np.ndarray] = []
        self.least: list[int] = []
        if len(points):
            self._node(0, np.arange(len(points)), self._distances(0, np.arange(len(points))))

    def _distances(self, i: int, rows: np.ndarray) -> np.ndarray:
        d = self.real[rows] - self.real[i]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _node(self, center: int, rows: np.ndarray, far: np.ndarray) -> int:
        k = len(self.center)
        radius = float(far.max())
        self.center.append(center)
        self.radius.append(radius)
        self.children.append([])
        self.members.append(rows)
        self.least.append(int(self.ids[rows].min()))
        if len(rows) > LEAF and radius > 0:
            parts = self._parts(center, rows, far, radius / 2)
            if parts:
                self.members[k] = rows[:0]
                self.children[k] = [self._node(*p) for p in parts]
        return k

    def _parts(self, center: int, rows: np.ndarray, far: np.ndarray, half: float) -> list[tuple]:
        """Points in balls of half the radius; none where the balls are nearly empty, as in
        many dimensions without clusters: such a node stays a leaf and is compared as
        a matrix."""
        out, left, dist, c = [], rows, far, center
        while len(left):
            near = dist <= half
            out.append((c, left[near], dist[near]))
            left = left[~near]
            if len(out) > 8 and len(rows) - len(left) < FILL * len(out):
                return []
            if len(left):
                c = int(left[0])
                dist = self._distances(c, left)
        return out


class Best:
    """The k best (score, id) of each query, worst last."""

    def __init__(self, n: int, k: int, floors: np.ndarray):
        self.score = np.full((n, k), np.iinfo(np.int64).min, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.floor = floors  # scores known to be reached by k others

    def worst(self, rows: np.ndarray) -> tuple[int, int]:
        """The least of the rows' kth scores, and the largest id that could tie there."""
        s = np.maximum(self.score[rows, -1], self.floor[rows])
        low = int(s.min())
        at = rows[s == low]
        tie = np.where(self.score[at, -1] == low, self.id[at, -1], np.iinfo(np.int64).max)
        return low, int(tie.max())

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        k = self.score.shape[1]
        low = self.score[rows, -1]
        if scores.shape[1] > k:
            low = np.maximum(low, np.partition(scores, scores.shape[1] - k, axis=1)[:, -k])
        r, c = np.nonzero((scores >= low[:, None]) & (ids < np.iinfo(np.int64).max))
        old = np.repeat(np.arange(len(rows)), k)
        row = np.concatenate([old, r])
        s = np.concatenate([self.score[rows].ravel(), scores[r, c]])
        i = np.concatenate([self.id[rows].ravel(), ids[r, c]])
        o = np.lexsort((i, ~s, row))  # ~ turns the order around, without overflow
        first = np.searchsorted(row[o], np.arange(len(rows)))
        o = o[first[:, None] + np.arange(k)]
        self.score[rows], self.id[rows] = s[o], i[o]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, by floating point where that is exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def dual_search(queries: CoverTree, data: CoverTree, k: int, floors: np.ndarray) -> Best:
    """The k best data points of every query; of those below a query's floor, any."""
    best = Best(len(queries.points), k, floors)
    if not len(queries.points) or not len(data.points):
        return best
    qc, dc = np.array(queries.center), np.array(data.center)
    qr, dr = np.array(queries.radius), np.array(data.radius)
    qn = np.sqrt(np.einsum("ij,ij->i", queries.real[qc], queries.real[qc]))
    dn = np.sqrt(np.einsum("ij,ij->i", data.real[dc], data.real[dc]))
    under = list(queries.members)  # the queries of each node
    for node in range(len(under) - 1, -1, -1):  # children follow their parents
        if queries.children[node]:
            under[node] = np.concatenate([under[c] for c in queries.children[node]])

    def bounds(q: int, nodes: list[int]) -> np.ndarray:
        d = np.array(nodes)
        b = data.real[dc[d]] @ queries.real[qc[q]] + qr[q] * dn[d] + dr[d] * qn[q] + qr[q] * dr[d]
        return b + 1e-9 * np.abs(b) + 1e-6

    todo = [(0, 0, float(bounds(0, [0])[0]))]
    while todo:
        q, d, bound = todo.pop()
        low, tie = best.worst(under[q])
        if bound < low or (bound < low + 1 and data.least[d] > tie):
            continue
        qk, dk = queries.children[q], data.children[d]
        if not qk and not dk:
            rows, cols = under[q], data.members[d]
            scores = _products(queries.points[rows], data.points[cols])
            own = queries.ids[rows][:, None] == data.ids[cols][None, :]
            scores[own] = np.iinfo(np.int64).min
            ids = np.where(own, np.iinfo(np.int64).max, np.broadcast_to(data.ids[cols], scores.shape))
            best.add(rows, ids, scores)
        elif dk and (not qk or dr[d] >= qr[q]):
            b = bounds(q, dk)
            todo += [(q, dk[x], float(b[x])) for x in np.argsort(b)]  # the best on top
        else:
            todo += sorted(((c, d, float(bounds(c, [d])[0])) for c in qk), key=lambda t: t[2])
    return best


def _vectors(rows: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, dim, v): vectors of floor(scale * x), as 64-bit integers."""
    x = F.transform(F.col(f"`{vector}`"), lambda e: e.cast("double"))
    rows = rows.select(F.col(f"`{id}`").cast("long").alias("id"), x.alias("x")).where("id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
    rows = rows.where(~F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))))

    def run(batches):
        for batch in batches:
            v = [np.floor(np.array(e.values, np.float64) * scale).astype(np.int64) for e in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(e) for e in v], pa.int32()), pa.array([e.tobytes() for e in v], pa.binary())], ["id", "dim", "v"])

    return rows.mapInArrow(tidy(run), "id long, dim int, v binary")


def _pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Up to PIVOTS vectors of each length, far from one another, from a bounded sample."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    out = {}
    for dim in sorted({r["dim"] for r in rows}):
        x = np.array([np.frombuffer(r["v"], np.int64) for r in rows if r["dim"] == dim], np.float64)
        chosen = [0]
        far = ((x - x[0]) ** 2).sum(axis=1)
        while len(chosen) < PIVOTS and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        out[dim] = x[chosen]
    return out


def _placed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """The vectors with the number of their nearest pivot (of their length)."""

    def run(batches):
        for batch in batches:
            out = []
            for dim, v in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                p = pivots.get(dim)
                x = np.frombuffer(v.as_buffer(), np.int64).astype(np.float64)
                out.append(0 if p is None else int(((p - x) ** 2).sum(axis=1).argmin()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "pivot"])

    return vectors.mapInArrow(tidy(run), "id long, dim int, v binary, pivot int")


def _search(data: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in each block it asks."""
    rows = data.select("block", "dim", F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("long").alias("floor")).union(asked.select("block", "dim", F.lit(1).alias("kind"), "id", "v", "floor"))

    def answers(tree: CoverTree, held: list[tuple]) -> pa.RecordBatch:
        points = np.array([np.frombuffer(v, np.int64) for _, v, _ in held])
        lowest = np.iinfo(np.int64).min
        floors = np.array([lowest if f is None else f for _, _, f in held], np.int64)
        ids = np.array([i for i, _, _ in held], np.int64)
        best = dual_search(CoverTree(points, ids), tree, k, floors)
        row, col = np.nonzero((best.id < np.iinfo(np.int64).max) & (best.score >= floors[:, None]))
        return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(best.id[row, col]), pa.array(best.score[row, col])], ["query_id", "vec_id", "score"])

    def run(batches):
        now, tree, data_rows, held = None, None, [], []
        for batch in batches:
            for block, dim, kind, i, v, floor in zip(*[batch.column(c).to_pylist() for c in range(6)], strict=True):
                if now != (block, dim):
                    if held:
                        yield answers(tree, held)
                    now, tree, data_rows, held = (block, dim), None, [], []
                if kind == 0:
                    data_rows.append((i, v))
                    continue
                if not data_rows:
                    continue  # a block without rows of this length
                if tree is None:
                    tree = CoverTree(np.array([np.frombuffer(x, np.int64) for _, x in data_rows]), np.array([x for x, _ in data_rows], np.int64))
                held.append((i, v, floor))
                if len(held) == GROUP:
                    yield answers(tree, held)
                    held = []
        if held:
            yield answers(tree, held)

    return rows.repartition("block", "dim").sortWithinPartitions("block", "dim", "kind", "id").mapInArrow(tidy(run), "query_id long, vec_id long, score long")


def top_k(spark: SparkSession, rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows whose id satisfies ``is_query`` (a
    condition on column ``id``), the k other rows of the highest inner product, ties to
    the smaller id; all of them if there are fewer."""
    vectors = _vectors(rows, id, vector, scale)
    placed = stage(spark, _placed(vectors, _pivots(vectors)), "placed")
    counts = {r["pivot"]: r["count"] for r in placed.groupBy("pivot").count().collect()}  # PIVOTS rows at most
    salts = [-(-counts.get(p, 0) // BLOCK) for p in range(PIVOTS)]
    bases = [sum(salts[:p]) for p in range(PIVOTS)]
    number = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("pivot") + 1)
    block = number(bases) + F.pmod(F.xxhash64("id"), number([max(1, s) for s in salts])).cast("int")
    data = placed.withColumn("block", block)
    queries = data.where(is_query)
    near = _search(data, queries.withColumn("floor", F.lit(None).cast("long")), k)
    # a floor needs k answers
    floors = near.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("id"), "floor")
    floors = stage(spark, floors, "floors")
    asked = queries.drop("block").join(floors, "id", "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, sum(salts) - 1)))))
    found = _search(data, asked, k).distinct()
    ranked = found.selectExpr("query_id", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
