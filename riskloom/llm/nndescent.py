"""Approximate nearest neighbours: a graph by NN-descent, queries by greedy search in it.

Equal vectors are one node of the graph; only the smallest ``KEPT_COPIES`` of their ids are
kept, since no answer can hold more. A first graph joins each node with the nearest of its
leaves in a few random partitions. Then rounds of NN-descent: neighbours of neighbours (in
both directions) meet by Spark joins, and a node takes those that are nearer than its worst
neighbour. A node that is many nodes' neighbour takes part for a fixed number of them per
round, as NN-descent samples; so no key is hot. Rounds end after ``ROUNDS``.

Queries start at their own node and repeat: expand the nearest nodes not yet expanded, join
their neighbours with their vectors, keep the nearest. A query ends when its ``BEAM``
nearest are all expanded. Graph and search measure in double precision, component by
component, on vectors kept as they are: in single precision where the column has that, else
in double. So neither groups of near copies nor huge components blur a distance. Ties in the
graph are broken by a hash of the pair, so that a group of equal distances does not choose
the same few neighbours. All that the beam holds is measured for the answer.

Partitions are fitted on a sample of ``SAMPLE`` vectors; every row is indexed. Recall
against brute force is measured in the tests and in README.md.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do
rows with null vec_id; of rows that repeat a vec_id the least vector counts. A missing
component counts as 0. Squared distances must fit a double. Ties go to the smaller vec_id. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from riskloom.llm.common import mix64, table
from riskloom.session import materialize

K = 10
EVERY = 100
NEIGHBOURS = 20
#: Nodes that a node takes part with as their neighbour, per round.
REVERSE = 20
ROUNDS = 4
#: Candidates that a node hears of from one common neighbour.
OFFERS = 4
TREES = 3
LEAF = 256
SAMPLE = 4_096
BEAM = 300
EXPAND = 60
KEPT_COPIES = K + 1


def _packed(v: DataFrame, single: bool) -> DataFrame:
    """node, and its vector as bytes, which begin with the bytes of a component."""
    kind, mark = (np.float32, b"\4") if single else (np.float64, b"\x08")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A missing component is 0, as trailing ones are.
            packed = [mark + np.nan_to_num(row.values.to_numpy(zero_copy_only=False)).astype(kind).tobytes() for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "packed"])

    return v.select("node", "v").mapInArrow(run, "node long, packed binary")


def _rows(packed: list[bytes]) -> np.ndarray:
    kind = np.float32 if not packed or packed[0][0] == 4 else np.float64
    width = max(map(len, packed), default=1) - 1
    return np.frombuffer(b"".join(p[1:].ljust(width, b"\0") for p in packed), kind).reshape(len(packed), width // kind().itemsize).astype(np.float64)


def _distances(rows: np.ndarray) -> np.ndarray:
    """Squared distances between all rows, from differences: products would cancel."""
    out = np.empty((len(rows), len(rows)))
    for i, row in enumerate(rows):
        apart = rows - row
        out[i] = np.einsum("ij,ij->i", apart, apart)
    return out


def _pair_hash(nodes: np.ndarray) -> np.ndarray:
    own = nodes.astype(np.uint64)
    return mix64(mix64(own)[:, None] * np.uint64(3) + own)


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """node (the least id), v and the least ids of every distinct usable vector."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = F.forall("v", lambda c: c.isNotNull() & ((c - c) == 0)) & F.exists("v", lambda c: c != 0)
    keyed = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v")).where(good)
    keyed = keyed.groupBy("vec_id").agg(F.min("v").alias("v"))
    least = Window.partitionBy("v").orderBy("vec_id")
    kept = keyed.withColumn("place", F.row_number().over(least)).where(F.col("place") <= KEPT_COPIES)
    return kept.groupBy("v").agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("ids")).select("node", "v", "ids")


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """node and its k nearest as an array of (d, other); a node has few pairs, bounded by the round."""
    ranked = F.array_sort(F.collect_set(F.struct("d", F.xxhash64("node", "other").alias("tie"), "other")))
    return pairs.groupBy("node").agg(F.transform(F.slice(ranked, 1, k), lambda e: F.struct(e["d"].alias("d"), e["other"].alias("other"))).alias("near"))


def first_graph(vectors: DataFrame, k: int) -> DataFrame:
    """Nearest within the leaves of random partitions with median cuts."""
    n = vectors.count()
    sample = vectors.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).collect()
    points = _rows([bytes(r["packed"]) for r in sample])
    depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
    rng = np.random.default_rng(7)
    planes = rng.standard_normal((TREES, points.shape[1] if len(points) else 0, depth))
    cuts = np.stack([np.median(points @ p, axis=0) if len(points) else np.zeros(depth) for p in planes])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column(1).to_pylist())
            width = planes.shape[1]
            rows = np.pad(rows, ((0, 0), (0, max(0, width - rows.shape[1]))))[:, :width]
            for tree in range(TREES):
                code = ((rows @ planes[tree] > cuts[tree]) @ (1 << np.arange(depth, dtype=np.int64))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code * TREES + tree)], names=["node", "packed", "leaf"])

    in_leaf = vectors.mapInArrow(leaves, "node long, packed binary, leaf long")
    sizes = materialize(in_leaf.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")), "leaves")
    # A crowded leaf is dealt over several groups.
    grouped = in_leaf.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("node", "leaf"), F.ceil(F.col("n") / (2 * LEAF))))

    def near(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        d = _distances(_rows(group.column("packed").to_pylist()))
        np.fill_diagonal(d, np.inf)
        width = min(k, len(nodes) - 1)
        best = np.lexsort((_pair_hash(nodes), d), axis=1)[:, :width]
        return pa.table({"node": np.repeat(nodes, width), "other": nodes[best].ravel(), "d": np.take_along_axis(d, best, axis=1).ravel()})

    return _nearest(grouped.groupBy("leaf", "part").applyInArrow(near, "node long, other long, d double"), k)


def _sampled(graph: DataFrame, most: int, salt: int) -> DataFrame:
    """Edges (node, other, d, fresh); of a node's followers at most ``most``, by hash."""
    edges = graph.select("node", F.explode("near").alias("e")).select("node", "e.*")
    order = Window.partitionBy("other").orderBy(F.xxhash64("node", "other", F.lit(salt)), "node")
    return edges.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")


def descend(graph: DataFrame, vectors: DataFrame, k: int, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of NN-descent on rows (node, near)."""
    fresh = F.transform("near", lambda e: F.struct(e["d"].alias("d"), e["other"].alias("other"), F.lit(True).alias("fresh")))
    graph = materialize(graph.withColumn("near", fresh), "graph")
    for turn in range(rounds):
        edges = _sampled(graph, REVERSE, turn)
        sides = edges.select(F.col("node").alias("centre"), F.col("other").alias("node"), "fresh").union(edges.select(F.col("other").alias("centre"), "node", "fresh"))
        known = vectors.join(graph.select("node", F.when(F.size("near") >= k, F.element_at("near", -1)["d"]).alias("worst")), "node", "left")
        meetings = sides.join(known, "node").groupBy("centre").agg(F.collect_list(F.struct("node", "packed", "worst", "fresh")).alias("guests"))

        def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for at in range(0, batch.num_rows, 500):
                    lists = batch.column(0).slice(at, 500)
                    guests = lists.flatten()
                    node, worst = guests.field("node").to_numpy(), guests.field("worst").fill_null(np.inf).to_numpy()
                    fresh, rows = guests.field("fresh").to_numpy(zero_copy_only=False), _rows(guests.field("packed").to_pylist())
                    stops = np.cumsum(lists.value_lengths().to_numpy())
                    for a, b in zip(np.append(0, stops), stops):
                        nodes, new, d = node[a:b], fresh[a:b], _distances(rows[a:b])
                        d[(nodes[:, None] == nodes) | ~(new[:, None] | new) | (d >= worst[a:b, None])] = np.inf
                        best = np.lexsort((_pair_hash(nodes), d), axis=1)[:, :OFFERS]
                        own = np.take_along_axis(d, best, axis=1)
                        row, column = np.nonzero(np.isfinite(own))
                        out.append((nodes[row], nodes[best[row, column]], own[row, column]))
                if out:
                    node, other, d = (np.concatenate(c) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(d, pa.float64())], names=["node", "other", "d"])

        offers = meetings.select("guests").mapInArrow(introduce, "node long, other long, d double")
        pairs = offers.withColumn("fresh", F.lit(True)).unionByName(graph.select("node", F.explode("near").alias("e")).select("node", "e.other", "e.d", F.lit(False).alias("fresh")))
        merged = pairs.groupBy("node", "other").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
        ranked = F.array_sort(F.collect_list(F.struct("d", F.xxhash64("node", "other").alias("tie"), "other", "fresh")))
        near = F.transform(F.slice(ranked, 1, k), lambda e: F.struct(e["d"].alias("d"), e["other"].alias("other"), e["fresh"].alias("fresh")))
        graph = materialize(merged.groupBy("node").agg(near.alias("near")), "graph")
    return graph


def search(graph: DataFrame, vectors: DataFrame, queries: DataFrame, beam: int = BEAM) -> DataFrame:
    """query_id, node and d of the ``beam`` nearest nodes that greedy search finds.

    ``queries``: query_id and the node to start from, which holds the query's vector.
    """
    followers = _sampled(graph, REVERSE, -1).select(F.col("other").alias("node"), F.col("node").alias("other"))
    links = materialize(graph.select("node", F.explode("near.other").alias("other")).union(followers).distinct(), "links")
    asking = materialize(queries.join(vectors, "node").select("query_id", "node", F.col("packed").alias("own")), "asking")
    found = asking.select("query_id", "node", F.lit(0).cast("double").alias("d"), F.lit(False).alias("done"))
    nearest = Window.partitionBy("query_id").orderBy("d", "node")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_rows(batch.column(c).to_pylist()) for c in ("own", "packed"))
            width = max(a.shape[1], b.shape[1])
            a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("node"), pa.array(((a - b) ** 2).sum(axis=1))], names=["query_id", "node", "d"])

    while True:
        ranked = found.withColumn("open", F.row_number().over(Window.partitionBy("query_id", "done").orderBy("d", "node")))
        expand = ~F.col("done") & (F.col("open") <= EXPAND)
        found = materialize(ranked.select("query_id", "node", "d", "done", expand.alias("now")), "found")
        frontier = found.where("now").select("query_id", "node")
        if frontier.isEmpty():
            return found.select("query_id", "node", "d")
        reached = frontier.join(links, "node").select("query_id", F.col("other").alias("node")).distinct()
        new = reached.join(found.select("query_id", "node"), ["query_id", "node"], "left_anti").join(vectors, "node").join(asking.select("query_id", "own"), "query_id")
        measured = new.select("query_id", "node", "own", "packed").mapInArrow(measure, "query_id long, node long, d double")
        both = found.select("query_id", "node", "d", (F.col("done") | F.col("now")).alias("done")).union(measured.withColumn("done", F.lit(False)))
        found = both.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= beam).drop("place")


def nearest_neighbours(vectors: DataFrame, every: int = EVERY, k: int = K, neighbours: int = NEIGHBOURS, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id and score for the rows whose vec_id is divisible by ``every``."""
    nodes = materialize(distinct_vectors(vectors), "nodes")
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    packed = materialize(_packed(nodes, single), "packed")
    graph = descend(first_graph(packed, neighbours), packed, neighbours)
    asked = materialize(_usable_ids(vectors, nodes, every), "queries")
    found = search(graph, packed, asked, beam)
    exact = found.select("query_id", "node").join(nodes, "node").join(asked.withColumnRenamed("node", "own").join(nodes.select(F.col("node").alias("own"), F.col("v").alias("w")), "own"), "query_id")
    square = F.zip_with("v", "w", lambda a, b: (F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))) * (F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))))
    score = F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, x: s + x))
    pairs = exact.select("query_id", F.explode("ids").alias("vec_id"), score.alias("score")).where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _usable_ids(vectors: DataFrame, nodes: DataFrame, every: int) -> DataFrame:
    """query_id and node of the rows that ask."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    asking = vectors.where((F.col("vec_id") % every == 0) & F.col("embedding").isNotNull())
    own = asking.select(F.col("vec_id").cast("long").alias("query_id"), x.alias("v")).groupBy("query_id").agg(F.min("v").alias("v"))
    return own.join(nodes.select("node", "v"), "v").select("query_id", "node")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every 100th of the ``embeddings``."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
