"""Hard negatives by inner product, found with an STR-packed R-tree.

Rows are packed by sort-tile-recursive: the table is cut at quantiles of the label, every
slab at quantiles of the widest coordinate, every strip of it at quantiles of the next one.
A tile of more than ``SHARD_ROWS`` rows (copies cannot be told apart by coordinates) is
dealt over several shards. A shard is packed the same way into leaves and their parents.
Every node of the tree, from slab to leaf, has a minimum bounding box and an interval of
labels. A box gives an interval of each coordinate's product with a query, and their sums
the least and the largest inner product within.

A query asks for the k best scores in each of some score windows, among the rows of its own
label or among those of all others. First it visits the one shard with the best bound; the
kth scores found there go into all windows. Then it visits the shards whose boxes reach a
window, in blocks of bounded size. Within a shard nodes wait in a queue, best bound first;
boxes of the wrong labels, outside all windows, or strictly below the kth scores are left out.

The positives of an anchor are its k best rows of the same label. Each positive's score
gives a window, from ``LOW`` to ``HIGH`` percent of it, and the negatives are the best rows
of other labels in it. A positive without a positive score has an empty window.

Components become floor(256 * x) as whole numbers; products are exact (whole numbers of
double precision where they stay below 2^53, else Python's) and held within the range of a
long. Rows with a null vec_id, label or vector, or with null or non-finite components, take
no part; of rows that repeat a vec_id the least (label, vector) counts. Vectors of differing
lengths share only their common components. Ties go to the smaller vec_id. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.session import broadcast_up_to, materialize

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
EVERY = 100
SCALE = 256
#: Rows of a shard, rows of a leaf, children of a node, and queries of one block.
SHARD_ROWS, LEAF, FAN, BLOCK_ROWS = 4_000, 128, 16, 1_000
#: Quantiles that a slab can be cut at, and tiles up to which their borders are broadcast.
GRID, MAX_BORDERS = 256, 4_096
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_BOXES = "shard long, slab long, low_label long, high_label long, low array<double>, high array<double>"
_FOUND = "ask long, w int, vec_id long, score long"


def whole_rows(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v, the vector as whole numbers (in doubles)."""
    x = F.transform("embedding", lambda c: c.cast("double") * scale)
    # NaN and infinities are the values whose difference with themselves is not zero.
    good = F.forall("x", lambda c: c.isNotNull() & ((c - c) == 0))
    known = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND label IS NOT NULL")
    keyed = known.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x")).where(good)
    # From 2^53 on, doubles have no fraction.
    whole = F.transform("x", lambda c: F.when(F.abs(c) < float(1 << 53), F.floor(c).cast("double")).otherwise(c))
    return keyed.select("vec_id", F.struct("label", whole.alias("v")).alias("row")).groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def _widest(vectors: DataFrame, count: int) -> list[int]:
    """The coordinates with the largest variance."""
    spread = vectors.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.variance("x").alias("s"))
    return [r["at"] for r in spread.orderBy(F.desc_nulls_last("s"), "at").limit(count).collect()]


def packed(vectors: DataFrame, rows: int = SHARD_ROWS) -> DataFrame:
    """The vectors with their shard and slab (all shards of a slab share its part of the tree)."""
    keys: list[Column] = [F.col("label").cast("double"), *(F.coalesce(F.get("v", F.lit(c)), F.lit(0.0)) for c in _widest(vectors, 2))]
    tiled = vectors.withColumn("tile", F.lit(0).cast("long"))
    for at, key in enumerate(keys):
        steps = [i / GRID for i in range(1, GRID)]
        cuts = F.percentile_approx(key, steps, GRID * 10).alias("cuts")
        # Written, as another run of the sketches could give other borders.
        borders = materialize(tiled.groupBy("tile").agg(cuts, F.count(F.lit(1)).alias("n")), "borders")
        slabs = F.least(F.lit(GRID), F.ceil(F.pow(F.col("n") / rows, 1 / (len(keys) - at))))
        below = F.size(F.filter("cuts", lambda c: c < key))
        slab = F.floor(below * slabs / GRID).cast("long")
        tiled = tiled.join(broadcast_up_to(borders, MAX_BORDERS), "tile").withColumn("tile", F.col("tile") * GRID + slab).drop("cuts", "n")
        tiled = materialize(tiled, "tiles")
    counts = materialize(tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / rows).cast("long").alias("parts")), "tile-parts")
    dealt = tiled.join(broadcast_up_to(counts, MAX_BORDERS), "tile")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    return dealt.select(F.xxhash64("tile", part).alias("shard"), F.floor(F.col("tile") / GRID).cast("long").alias("slab"), "vec_id", "label", "v")


def _matrix(rows: list[np.ndarray], width: int = 0) -> np.ndarray:
    """Rows of one length; missing components are 0."""
    out = np.zeros((len(rows), max([width, *map(len, rows)])))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _vectors(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [c.values.to_numpy() for c in column.combine_chunks()]


def boxes(shards: DataFrame) -> DataFrame:
    """Bounding box and labels of every shard."""

    def run(group: pa.Table) -> pa.Table:
        v, labels = _matrix(_vectors(group.column("v"))), group.column("label").to_numpy()
        row = {"shard": group["shard"][0].as_py(), "slab": group["slab"][0].as_py(), "low_label": labels.min(), "high_label": labels.max()}
        # Shorter vectors miss components, which count as 0; the zeros of _matrix are in the box.
        return pa.Table.from_pylist([row | {"low": v.min(axis=0).tolist(), "high": v.max(axis=0).tolist()}], schema=_schema(_BOXES))

    return shards.groupBy("shard").applyInArrow(run, _BOXES)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product of each query with anything in each box."""
    width = max(queries.shape[1], low.shape[1])
    queries, low, high = (_widen(m, width) for m in (queries, low, high))
    if _limit(queries, low, high) >= 1 << 53:  # not exact: every box may hold anything
        return np.full((len(queries), len(low)), -np.inf), np.full((len(queries), len(low)), np.inf)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _limit(queries: np.ndarray, *others: np.ndarray) -> float:
    return float(np.abs(queries).max(initial=0)) * max(float(np.abs(m).max(initial=0)) for m in others) * max(1, queries.shape[1])


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _wrong(same: bool, label: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Boxes without any row that the query may find."""
    return (low > label) | (high < label) if same else (low == label) & (high == label)


class Tree:
    """Packed R-tree of one shard. Node 0 is the root, ``children`` is empty for a leaf."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = _tile(vectors, labels)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        starts = np.arange(0, len(ids), LEAF)
        self.rows = [slice(s, s + LEAF) for s in starts]
        low, high = np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts)
        low_label, high_label = np.minimum.reduceat(self.labels, starts), np.maximum.reduceat(self.labels, starts)
        levels, first = [(low, high, low_label, high_label)], 0
        self.children: dict[int, range] = {}
        while len(levels[-1][0]) > 1:
            low, high, low_label, high_label = levels[-1]
            at = np.arange(0, len(low), FAN)
            for i, start in enumerate(at):
                self.children[first + len(low) + i] = range(first + start, first + min(start + FAN, len(low)))
            first += len(low)
            levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(low_label, at), np.maximum.reduceat(high_label, at)))
        self.root = first
        self.low, self.high, self.low_label, self.high_label = (np.concatenate(c) for c in zip(*levels))

    def search(self, queries: np.ndarray, asks: list[tuple[int, int, list[int], list[int]]], k: int, same: bool) -> Iterator[tuple[int, int, int, int]]:
        """(query number, window, vec_id, score) of the k best in each window.

        A query is (own vec_id, label, least scores, largest scores); it does not find itself.
        """
        width = max(queries.shape[1], self.vectors.shape[1])
        queries, vectors = _widen(queries, width), _widen(self.vectors, width)
        lows, highs = _bounds(queries, self.low, self.high)
        exact = _limit(queries, vectors) < 1 << 53
        if not exact:
            queries, vectors = (np.array([[int(c) for c in row] for row in m], object).reshape(m.shape) for m in (queries, vectors))
        for number, (query, (own, label, least, most), low, high) in enumerate(zip(queries, asks, lows, highs)):
            wrong = _wrong(same, label, self.low_label, self.high_label)
            need, best = list(least), [[] for _ in least]
            waiting = [] if wrong[self.root] else [(-high[self.root], self.root)]
            while waiting:
                ahead, node = heapq.heappop(waiting)
                if -ahead < min(need):
                    break
                if not any(-ahead >= n and low[node] <= m for n, m in zip(need, most)):
                    continue
                if node in self.children:
                    for child in self.children[node]:
                        if not wrong[child] and high[child] >= min(need):
                            heapq.heappush(waiting, (-high[child], child))
                    continue
                rows = self.rows[node]
                scores = vectors[rows] @ query
                if not exact:
                    scores = np.array([max(_LEAST, min(_MOST, s)) for s in scores], object)
                ids = self.ids[rows]
                fit = ((self.labels[rows] == label) == same) & (ids != own)
                for w, heap in enumerate(best):
                    for at in np.flatnonzero(fit & (scores >= need[w]) & (scores <= most[w])):
                        entry = (int(scores[at]), -int(ids[at]))
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        need[w] = max(need[w], heap[0][0])
            yield from ((number, w, -minus, score) for w, heap in enumerate(best) for score, minus in heap)


def _tile(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Order of the rows in which every ``LEAF`` of them lie close: label, then strips of the two widest coordinates."""
    if not vectors.shape[1]:
        return np.argsort(labels, kind="stable")
    wide = np.argsort(-vectors.var(axis=0), kind="stable")[:2]
    first, second = vectors[:, wide[0]], vectors[:, wide[-1]]
    order = np.lexsort((first, labels))
    strip = LEAF * max(1, int(np.sqrt(len(order) / LEAF)))
    return np.concatenate([rows[np.lexsort((second[rows], labels[rows]))] for rows in np.split(order, range(strip, len(order), strip))])


def _route(asks: DataFrame, tree: DataFrame, same: bool, first_only: bool) -> DataFrame:
    """ask and shard, for shards whose box reaches a window; or only the one with the best bound.

    Asks in blocks meet the boxes of one slab at a time.
    """
    blocks = max(1, asks.count() // BLOCK_ROWS)
    slabs = tree.select("slab").distinct()
    in_blocks = asks.withColumn("block", F.pmod(F.xxhash64("ask"), F.lit(blocks)).cast("int"))
    # One row per slab, at most GRID * GRID of them.
    everywhere = in_blocks.withColumn("slab", F.explode(F.lit(sorted(r["slab"] for r in slabs.collect())).cast("array<long>")))
    asked = tree.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            low, high = _matrix(_vectors(right["low"])), _matrix(_vectors(right["high"]))
            queries = _matrix(_vectors(left["v"]))
            least, most = _bounds(queries, low, high)
            labels = right["low_label"].to_numpy(), right["high_label"].to_numpy()
            shards = right["shard"].to_numpy()
            rows = zip(*(left[c].to_pylist() for c in ("ask", "label", "need", "most")))
            for (ask, label, need, top), down, up in zip(rows, least, most):
                reached = np.zeros(len(shards), bool)
                for n, m in zip(need, top):
                    reached |= (up >= n) & (down <= m)
                at = np.flatnonzero(reached & ~_wrong(same, label, *labels))
                if first_only:
                    at = at[np.argsort(-up[at], kind="stable")[:1]]
                out += [(ask, int(shards[i]), float(up[i])) for i in at]
        return pa.table({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate((("ask", pa.int64()), ("shard", pa.int64()), ("up", pa.float64())))})

    found = everywhere.groupBy("slab", "block").cogroup(asked.groupBy("slab", "block")).applyInArrow(run, "ask long, shard long, up double")
    if first_only:
        return found.groupBy("ask").agg(F.max_by("shard", F.struct("up", "shard")).alias("shard"))
    return found.select("ask", "shard")


def _visit(asks: DataFrame, visits: DataFrame, shards: DataFrame, k: int, same: bool) -> DataFrame:
    """What the asks find in the shards that they visit, in blocks of asks."""
    busy = materialize(visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("blocks")), "busy")
    asking = (
        asks.join(visits, "ask").join(busy, "shard")
        .select("shard", F.pmod(F.xxhash64("ask"), F.col("blocks")).alias("block"), "ask", "label", "v", "need", "most")
    )
    asked = shards.join(busy, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "vec_id", "label", "v")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            tree = Tree(right["vec_id"].to_numpy(), right["label"].to_numpy(), _matrix(_vectors(right["v"])))
            rows = list(zip(*(left[c].to_pylist() for c in ("ask", "label", "need", "most"))))
            out = [(rows[i][0], w, vec_id, score) for i, w, vec_id, score in tree.search(_matrix(_vectors(left["v"])), rows, k, same)]
        return pa.table({f.name: pa.array([r[i] for r in out], f.type) for i, f in enumerate(_schema(_FOUND))})

    return asking.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_in_windows(asks: DataFrame, shards: DataFrame, tree: DataFrame, k: int, same: bool) -> DataFrame:
    """ask, w, rank, vec_id and score: each ask's k best in each of its windows.

    Asks have ask, label, v and the windows as two arrays of longs, need and most.
    """
    home = materialize(_route(asks, tree, same, first_only=True), "home")
    first = materialize(_visit(asks, home, shards, k, same), "first-found")
    kth = _best(first, k).groupBy("ask", "w").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    reach = kth.where("kth IS NOT NULL").groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kth"))
    raised = F.transform("need", lambda n, w: F.greatest(n, F.try_element_at("kth", w)))
    reaching = materialize(asks.join(reach, "ask", "left").withColumn("need", raised).drop("kth"), "reaching")
    others = materialize(_route(reaching, tree, same, first_only=False).join(home, ["ask", "shard"], "left_anti"), "others")
    return _best(first.union(_visit(reaching, others, shards, k, same)), k)


def hard_negatives(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` are whole_rows(); anchors are those whose vec_id is divisible by ``every``.
    """
    vectors = materialize(rows, "vectors")
    shards = materialize(packed(vectors), "shards")
    tree = materialize(boxes(shards), "boxes")
    anchors = materialize(shards.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("ask"), "label", "v"), "anchors")
    whole = F.array(F.lit(_LEAST)).alias("need"), F.array(F.lit(_MOST)).alias("most")
    near = best_in_windows(anchors.select("*", *whole), shards, tree, positives, True)
    pairs = materialize(near.select("ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # One window per anchor and distinct score; whole numbers of 30 * score may pass a long.
    score = F.col("positive_score").cast("decimal(38,0)")
    need, most = F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long")
    windows = pairs.select("ask", "positive_score", need.alias("need"), most.alias("most")).where("need <= most").distinct()
    sorted_ = F.sort_array(F.collect_list(F.struct("positive_score", "need", "most")))
    asking = windows.groupBy("ask").agg(sorted_.alias("s")).select("ask", *(F.col(f"s.{c}").alias(c) for c in ("positive_score", "need", "most")))
    asking = materialize(anchors.join(asking, "ask"), "windows")
    found = best_in_windows(asking.drop("positive_score"), shards, tree, negatives, False)
    scored = found.join(asking.select("ask", F.posexplode("positive_score").alias("w", "positive_score")), ["ask", "w"])
    return scored.join(pairs, ["ask", "positive_score"]).select(
        F.col("ask").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th of the ``embeddings``; every 7th has another label first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(whole_rows(table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
