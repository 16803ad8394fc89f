"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt evenly over shards and queries over blocks; a cell is one shard and one
block. In its cell a shard becomes a KD-tree: nodes are split at the median of their widest
dimension, and every node keeps the tight box around its vectors. The largest product that
a box allows is a query's bound for all vectors within; a query visits nodes best bound
first and stops when no bound reaches its kth score. Bounds of all nodes for all queries
of a cell come from two matrix products.

The kth score is propagated: each query first searches one shard, and takes the kth score
found there into all other shards, where fewer boxes can still matter. Queries meet every
shard, in blocks of bounded size; nothing is broadcast.

Components become floor(256 * x) as whole numbers; products are exact (whole numbers of
double precision where they stay below 2^53, else Python's). Scores beyond a long are
clamped. Vectors that are null, or hold null or non-finite components, take no part, nor do
rows with null vec_id; vec_id is the key, and of rows that repeat it the least vector
counts. Vectors of differing lengths share only their common components. Ties go to the
smaller vec_id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import salted, table
from riskloom.session import materialize

K = 5
EVERY = 50
SCALE = 256
LEAF = 64
#: Vectors per shard and queries per block, on average.
SHARD_ROWS = 4_000
BLOCK_ROWS = 2_000
MIN_SHARDS = 48

_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the vector as whole numbers (in doubles)."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    # NaN and infinities are the values whose difference with themselves is not zero.
    good = F.forall("x", lambda c: c.isNotNull() & ((c * scale - c * scale) == 0))
    keyed = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(good)
    whole = keyed.select("vec_id", F.transform("x", lambda c: _floor(c * scale)).alias("v"))
    return whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def _floor(x: Column) -> Column:
    """Floor as a double: from 2^53 on, doubles have no fraction."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def _matrix(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of one length; missing components are 0."""
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


class Tree:
    """KD-tree with tight boxes. Node i has children 2i + 1 and 2i + 2, or is a leaf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.members: dict[int, np.ndarray] = {}
        boxes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting = [(0, np.arange(len(ids)))] if len(ids) else []
        while waiting:
            node, rows = waiting.pop()
            own = vectors[rows]
            low, high = own.min(axis=0), own.max(axis=0)
            boxes[node] = low, high
            width = high - low
            if len(rows) <= LEAF or not width.size or not width.max():
                self.members[node] = rows
                continue
            along = own[:, width.argmax()]
            order = np.argpartition(along, len(rows) // 2)
            waiting += [(2 * node + 1, rows[order[: len(rows) // 2]]), (2 * node + 2, rows[order[len(rows) // 2 :]])]
        self.nodes = {node: at for at, node in enumerate(boxes)}
        self.low = np.array([b[0] for b in boxes.values()])
        self.high = np.array([b[1] for b in boxes.values()])

    def search(self, queries: np.ndarray, own: np.ndarray, reach: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """(query number, vec_id, score) of each query's k best here that are not below its ``reach``.

        ``own`` are the queries' vec_ids, which they do not find.
        """
        if not len(self.ids):
            return
        width = max(queries.shape[1], self.vectors.shape[1])
        queries, vectors, low, high = (_widen(m, width) for m in (queries, self.vectors, self.low, self.high))
        limit = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, width)
        if limit < 1 << 53:
            bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        else:  # products are exact in Python's whole numbers, bounds are left open
            queries, vectors = (np.array([[int(c) for c in row] for row in m], object).reshape(m.shape) for m in (queries, vectors))
            bounds = np.full((len(queries), len(low)), np.inf)
        for number, (query, mine, bound) in enumerate(zip(queries, own, bounds)):
            best: list[tuple[int, int]] = []  # a heap of (score, -vec_id), the worst first
            least = reach[number]
            waiting = [(-bound[0], 0)]
            while waiting:
                ahead, node = heapq.heappop(waiting)
                if -ahead < least:
                    break
                if node not in self.members:
                    for child in (2 * node + 1, 2 * node + 2):
                        if (b := bound[self.nodes[child]]) >= least:
                            heapq.heappush(waiting, (-b, child))
                    continue
                rows = self.members[node]
                scores = vectors[rows] @ query
                for at in np.flatnonzero(scores >= least):
                    if self.ids[rows[at]] == mine:
                        continue
                    entry = (int(scores[at]), -int(self.ids[rows[at]]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    least = max(least, best[0][0])
            yield from ((number, -minus, score) for score, minus in best)


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _search_cells(rows: DataFrame, k: int) -> DataFrame:
    """Rows (cell, asks, id, v, reach): vectors of a shard and queries of a block by cell."""

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy().astype(bool)
        ids = group.column("id").to_numpy()
        vectors = [c.values.to_numpy() for c in group.column("v").combine_chunks()]
        reach = group.column("reach").to_numpy(zero_copy_only=False)
        tree = Tree(ids[~asks], _matrix([v for v, a in zip(vectors, asks) if not a]))
        found = list(tree.search(_matrix([v for v, a in zip(vectors, asks) if a]), ids[asks], np.nan_to_num(reach[asks], nan=-np.inf), k)) if asks.any() else []
        number, vec_id, score = (list(c) for c in zip(*found)) if found else ([], [], [])
        clamped = [max(-(1 << 63), min((1 << 63) - 1, s)) for s in score]
        return pa.table({"query_id": pa.array(ids[asks][number] if number else [], pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(clamped, pa.int64())})

    return rows.groupBy("cell").applyInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score; both inputs have vec_id and v."""
    vectors = materialize(vectors, "vectors")
    queries = materialize(queries, "queries")
    shards = max(MIN_SHARDS, vectors.count() // SHARD_ROWS)
    blocks = max(1, queries.count() // BLOCK_ROWS)
    sharded = salted(vectors, shards, "vec_id", name="shard")
    blocked = salted(salted(queries, blocks, "vec_id", name="block"), shards, F.lit(1), "vec_id", name="home")

    def cells(asking: DataFrame) -> DataFrame:
        """Every shard with every block that has queries for it."""
        of = sharded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        cell = F.struct("shard", "block").alias("cell")
        given = of.select(cell, F.lit(0).alias("asks"), F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("reach"))
        return given.unionByName(asking.select(cell, F.lit(1).alias("asks"), F.col("vec_id").alias("id"), "v", "reach"))

    home = blocked.select(F.col("home").alias("shard"), "block", "vec_id", "v", F.lit(None).cast("double").alias("reach"))
    first = materialize(_search_cells(cells(home), k), "first-found")
    kth = _best(first, k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).cast("double").alias("reach"))
    reaching = blocked.join(kth, blocked["vec_id"] == kth["query_id"], "left")
    others = reaching.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    found = first.union(_search_cells(cells(others), k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best partners of every 50th of the ``embeddings``."""
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
