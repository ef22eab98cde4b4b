"""Exact top-k search by inner product with a KD-tree per shard.

Rows are dealt by a hash of their id to shards of bounded size. Each shard builds a KD-tree by median splits of its widest
dimension, with tight boxes around all nodes. A query goes through a tree best first: the bound of a box is the largest
inner product any point in it can have, and nodes whose bound is below the k-th best score known are never opened (equal
bounds are, for ties go to the smaller id). The k-th score is passed on: every query first searches one shard, and its
k-th score there is the starting bound in all others.

Queries are a stated set of rows; they meet the shards in blocks of bounded size. Per query and shard at most k rows come
back. Scores are sums of products of whole numbers and exact as long as they stay below 2^53; then any order of search
gives the same result.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part, as rows or as queries, and
empty ones neither; rows of another length than the query's are no candidates; repeated vectors are ranked by id; rows
with one id are rows of their own: each is a query with ranks of its own, and a candidate of the others; null ids take no part; a query without candidates has no row; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kamienica.session import settle

LEAF = 128  # points in a leaf
SHARD_ROWS, BLOCK_QUERIES = 16_384, 2_048


class KDTree:
    """Points in rows, ids and row numbers beside them; node arrays, children behind their parents."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(points))
        self.low, self.high, self.children, self.span = [], [], [], []
        waiting = [(self._node(points, order), order, 0)] if len(points) else []
        placed, filled = np.empty(len(points), np.int64), 0
        while waiting:
            node, own, _ = waiting.pop()
            spread = self.high[node] - self.low[node]
            axis = int(spread.argmax())
            if len(own) <= leaf or spread[axis] == 0:
                placed[filled:filled + len(own)] = own
                self.span[node] = (filled, filled + len(own))
                filled += len(own)
                continue
            half = len(own) // 2
            own = own[np.argpartition(points[own, axis], half)]
            for part in (own[half:], own[:half]):
                child = self._node(points, part)
                self.children[node].append(child)
                waiting.append((child, part, 0))
        self.points, self.ids, self.rows = points[placed], ids[placed], rows[placed]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _node(self, points, own) -> int:
        part = points[own]
        self.low.append(part.min(axis=0))
        self.high.append(part.max(axis=0))
        self.children.append([])
        self.span.append(None)
        return len(self.low) - 1

    def top(self, query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[float, int]]:
        """Up to k (score, id), best first, among points scoring `floor` or more and not the query's own row."""
        if not len(self.points):
            return []
        bounds = np.maximum(query * self.low, query * self.high).sum(axis=1)
        best: list[tuple[float, int]] = []  # (-score, id) in order
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heappop(heap)
            if -bound < floor:
                break
            if self.span[node] is None:
                for child in self.children[node]:
                    if bounds[child] >= floor:
                        heappush(heap, (-bounds[child], child))
                continue
            x, y = self.span[node]
            scores = self.points[x:y] @ query
            at = np.flatnonzero((scores >= floor) & (self.rows[x:y] != own))
            if len(at):
                if len(at) > k:  # the k best of the leaf, ties by id
                    at = at[np.lexsort((self.ids[x:y][at], -scores[at]))[:k]]
                best = sorted(best + [(-s, i) for s, i in zip(scores[at].tolist(), self.ids[x:y][at].tolist())])[:k]
                if len(best) == k:
                    floor = max(floor, -best[-1][0])
        return [(-s, i) for s, i in best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


FOUND = "query long, vec_id long, score double"


def _search(k: int, leaf: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(queries):
            tree = KDTree(_matrix(rows.column("vector")), rows.column("id").to_numpy(), rows.column("row").to_numpy(), leaf)
            for query, own, floor in zip(_matrix(queries.column("vector")), queries.column("row").to_pylist(),
                                         queries.column("floor").to_pylist()):
                found = tree.top(query, own, k, -np.inf if floor is None else floor)
                out += [(own, i, s) for s, i in found]
        values = list(zip(*out)) if out else [()] * 3
        return pa.table({"query": pa.array(values[0], pa.int64()), "vec_id": pa.array(values[1], pa.int64()),
                         "score": pa.array(values[2], pa.float64())})
    return run


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, vector, dims): components turned into floor(scale * x); only rows that can take part."""
    raw = F.col(vector).cast("array<double>")
    sound = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (table.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & sound)
            .select(F.col(key).cast("long").alias("id"),
                    F.transform(raw, lambda x: F.floor(x * scale).cast("double")).alias("vector"),
                    F.size(vector).alias("dims")))


def top_k(table: DataFrame, every: int = 50, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by `every`."""
    points = settle(whole_vectors(table, key, vector, scale).withColumn("row", F.monotonically_increasing_id()))
    n = points.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n // (every * block_queries)))
    # pmod of two hashes with unlike seeds: ids in arithmetic progression still spread evenly
    spread = lambda column, parts, seed: F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(parts))
    rows = points.select(*[F.col(c).alias(c) for c in points.columns], spread("row", shards, 1).alias("shard"))
    queries = points.where(F.col("id") % every == 0).select("row", "vector", "dims", spread("row", blocks, 2).alias("block"),
                                                            spread("row", shards, 3).alias("home"))

    def search(asked: DataFrame) -> DataFrame:
        """`asked` has the shard each query is to go to; every shard meets every block of queries it is asked by."""
        met = rows.join(asked.select("shard", "block", "dims").distinct(), ["shard", "dims"])
        met = met.select(*[F.col(c).alias(c) for c in met.columns])  # columns of its own beside `asked`
        cells = ["shard", "block", "dims"]
        return met.groupBy(*cells).cogroup(asked.groupBy(*cells)).applyInArrow(_search(k, leaf), FOUND)

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    first = settle(search(queries.withColumn("shard", F.col("home")).withColumn("floor", F.lit(None).cast("double"))))
    kth = first.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
    rest = (queries.join(kth.withColumnRenamed("query", "row"), "row", "left")
            .withColumn("shard", F.explode(others)).withColumn("shard", F.col("shard").cast("long")))
    names = points.where(F.col("id") % every == 0).select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return (first.unionAll(search(rest)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score")))


QUERY_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT q.r, q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.r <> v.r AND len(q.e) = len(v.e))
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
