"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt to shards by a hash of their id. Each shard's tree splits at
the median of its widest component and keeps the tight box of every node; a
query's inner product with anything in a box is at most the sum of
max(q * low, q * high). A query walks a tree best bound first and stops at its
k-th score. It first searches the shard that holds it; the k-th result found
there is handed on to all other shards as the score to beat.

A stated query set meets all rows, in blocks: a task holds one shard and one
block of queries. Results per shard are at most k a query and are ranked per
query.

Defined results: vectors that are null, or hold null or non-finite components,
or have no id, take no part; rows that repeat an id are rows of their own, as
queries and as candidates, and a query only leaves its own row out; it meets
vectors of its own length only; ties go to the smaller id
(nodes keep their smallest id, so crowds of equal vectors are skipped at once);
empty vectors score 0; scores beyond the range of a long are cut off there; an
empty table gives an empty result; other columns are not read, so their names
can't clash.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.shared import materialise

K, SCALE = 10, 1024
#: vectors in a shard, queries in a block, vectors in a leaf
SHARD, BLOCK, LEAF = 4096, 1024, 64


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(rid, vec_id, vector): floor(scale * x) of every component, of the rows that take part, each with a number of its own."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # the vector is only looked at where it is known to be finite
    scaled = F.when(v.isNotNull() & finite, F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("vec_id"), scaled.alias("vector"))
    return rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL")


class KDTree:
    """Median splits with tight boxes over the rows of ``points``; identical points stay in one leaf."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order, nodes = np.arange(len(points)), []
        stack = [(0, len(points), -1, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            inside = points[order[start:end]]
            low, high = inside.min(axis=0), inside.max(axis=0)
            nodes.append([start, end, low, high, ids[order[start:end]].min(), [-1, -1]])
            if parent >= 0:
                nodes[parent][5][side] = len(nodes) - 1
            extent = high - low
            if end - start > leaf and extent.any():
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(inside[:, int(extent.argmax())], middle)]
                stack += [(start, start + middle, len(nodes) - 1, 0), (start + middle, end, len(nodes) - 1, 1)]
        self.points, self.ids, self.rows = points[order], ids[order], rows[order]
        self.spans = [(n[0], n[1]) for n in nodes]
        self.low, self.high = (np.array([n[i] for n in nodes]).reshape(len(nodes), -1) for i in (2, 3))
        self.least_id = [int(n[4]) for n in nodes]
        self.children = [n[5] for n in nodes]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that each query (row) can score in each node (column)."""
        zero = queries.dtype.type(0) if queries.dtype != object else 0
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query: np.ndarray, bound: np.ndarray, own: int, k: int, beat: tuple | None) -> list[tuple]:
        """The best (score, -id) of at most k rows other than row ``own``, all better than ``beat``."""
        best: list[tuple] = []  # heap of (score, -id), the worst on top
        waiting = [(-bound[0], 0)]
        while waiting:
            top, node = heapq.heappop(waiting)
            worst = best[0] if len(best) == k else None
            if beat is not None and (worst is None or beat > worst):
                worst = beat
            if worst is not None and (-top, -self.least_id[node]) <= worst:
                if -top < worst[0]:
                    break  # no node left has a better bound
                continue
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(waiting, (-bound[child], child))
                continue
            start, end = self.spans[node]
            scores, ids = self.points[start:end] @ query, self.ids[start:end]
            others = self.rows[start:end] != own
            better = np.flatnonzero((scores >= worst[0]) & others if worst is not None else others)
            if len(better) > k:  # of equal scores the smaller ids
                better = better[np.lexsort((ids[better], -scores[better]))[:k]]
            for i in better.tolist():
                found = (scores[i], -int(ids[i]))
                if beat is not None and found <= beat:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return best


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.empty((0, 0), np.int64)


def _exact(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest type that holds every partial sum exactly."""
    # in Python integers: the largest negative long has no absolute value
    reach = [max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0 for m in (points, queries)]
    most = 2 * reach[0] * reach[1] * max(1, points.shape[1])
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
    return points.astype(kind), queries.astype(kind)


def _search(k: int, leaf: int):
    schema = pa.schema({"query": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()})

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if len(vectors) and len(queries):
            points, wanted = _exact(_matrix(vectors.column("vector")), _matrix(queries.column("vector")))
            tree = KDTree(points, vectors.column("vec_id").to_numpy(), vectors.column("rid").to_numpy(), leaf)
            bounds = tree.bounds(wanted)
            rows, ids, beats = (queries.column(n).to_pylist() for n in ("rid", "vec_id", "beat"))
            for query, bound, row, own, beat in zip(wanted, bounds.tolist(), rows, ids, beats):
                limit = (beat["score"], -beat["vec_id"]) if beat else None
                found += [(row, own, -i, s) for s, i in tree.search(query, bound, row, k, limit)]
        low, high = -(1 << 63), (1 << 63) - 1
        columns = [*([f[i] for f in found] for i in range(3)), [min(max(int(f[3]), low), high) for f in found]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def _groups(rows: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / size)).cast("long")


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    shard: int = SHARD,
    block: int = BLOCK,
    leaf: int = LEAF,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows where ``is_query`` (an expression on vec_id) holds."""
    vectors = materialise(integer_vectors(df, id_col, vector_col, scale), "vectors")
    counts = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).select(
        _groups(F.col("n"), shard).alias("shards"), _groups(F.col("q"), block).alias("blocks")
    )
    shards, blocks = counts.first()
    dealt = vectors.withColumn("dim", F.size("vector")).withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)))
    queries = materialise(
        dealt.filter(is_query).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "rid"), F.lit(blocks))), "queries"
    )
    every_block = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["dim", "shard", "block"]
    kinds = "query long, query_id long, vec_id long, score long"

    def search(these: DataFrame) -> DataFrame:
        return every_block.groupBy(*keys).cogroup(these.groupBy(*keys)).applyInArrow(_search(k, leaf), kinds)

    nothing = F.lit(None).cast("struct<score: long, vec_id: long>").alias("beat")
    at_home = materialise(search(queries.select("*", nothing)), "home")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id"))
    kth = at_home.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
    kth = kth.select(F.col("query").alias("rid"), F.struct("score", F.col("vec_id").alias("vec_id")).alias("beat"))
    others = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), F.array("shard"))
    sent = queries.join(kth, "rid", "left").withColumn("shard", F.explode(others)).select("rid", "vec_id", "vector", *keys, "beat")
    found = at_home.unionByName(search(sent))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = f"""
WITH vectors AS (
  SELECT row_number() OVER () AS rid, vec_id, [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, v.vec_id, list_inner_product(q.vector, v.vector)::BIGINT AS score
  FROM vectors q JOIN vectors v ON q.vec_id % 100 = 0 AND q.rid <> v.rid
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY rid ORDER BY score DESC, vec_id)
QUALIFY rank <= {K}
"""
