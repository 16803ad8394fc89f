"""Near duplicates among embeddings: signs of random hyperplanes, exact cosines, components.

Only vectors of one label are compared. Equal vectors are one *node* with a weight. The
signs of a vector's products with ``BITS`` random hyperplanes are its sketch; a table takes
some of these bits as key, and two vectors are compared where they agree on a key in one of
the tables. The number of tables follows from the bits of a key and ``MISSED``, the chance
that a pair at the threshold agrees in none of them; the bits of a key follow from the
number of vectors, so that chance company stays small. Before any vector moves, those who
share a key are compared by their sketches: a pair that differs in more bits than one at the
threshold ever should (six standard deviations) is left out.

Groups of near copies would be all pairs. So nodes are first gathered into *balls*: where
a key of the first table is shared, the node most crowded there is a pivot, and nodes within
half the threshold's angle of it are its ball. Any two in a ball are linked, by the triangle
inequality, without being compared. Two balls are compared by their pivots: the angle between
these and the two radii tell mostly that all, or none, of their pairs are linked. Only what
is left is compared by blocks of members, which report counts and one link per ball.

Links have a cosine of at least the threshold in double precision. Vectors that are null,
empty, zero or hold null or non-finite components link with nothing, nor do those without a
label; vectors of different lengths do not link. Rows without vec_id are left out; of rows
that repeat a vec_id the least (label, vector) counts. Equal vectors are linked and counted.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.components import components
from riskloom.session import materialize

COSINE = 0.93
#: Bits of a sketch, chance that a pair at the threshold meets in no table, and seed of the hyperplanes.
BITS, MISSED, SEED = 512, 1e-5, 12
#: Nodes that a key gathers by chance, on average and at most.
COMPANY = 64
#: Vectors whose signs are taken at a time.
STEP = 256
#: Balls of a key, and members of two balls, that meet in one task.
CELL = 2_000
#: What rounding may change in an angle.
SLACK = 1e-7


def plan(nodes: int, cosine: float = COSINE) -> tuple[int, int]:
    """Bits of a key and number of tables for so many nodes."""
    agree = 1 - acos(cosine) / pi
    bits = max(4, min(60, ceil(log2(max(1, nodes) / COMPANY))))
    return bits, ceil(log(MISSED) / log(1 - agree**bits))


def planes(width: int, count: int) -> np.ndarray:
    """The random hyperplanes, the same in every task."""
    return np.random.default_rng([SEED, width]).normal(size=(width, count))


def unit_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and u, the vector at length 1; u is null for what links with nothing."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    keyed = rows.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), x.alias("x")).alias("row"))
    least = keyed.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")
    # NaN and infinities are the values whose difference with themselves is not zero.
    good = F.col("label").isNotNull() & F.coalesce(F.forall("x", lambda c: c.isNotNull() & ((c - c) == 0)), F.lit(False))
    # The largest component becomes 1 first, so that squares neither overflow nor vanish.
    most = F.array_max(F.transform("x", F.abs))
    scaled = F.when(good & (most > 0), F.transform("x", lambda c: c / most))
    length = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, c: a + c * c))
    return least.select("vec_id", "label", scaled.alias("s")).select("vec_id", "label", F.transform("s", lambda c: c / length).alias("u"))


def sketched(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """The nodes with their sketch (an array of longs) and the keys of all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("u"))
            widths = column.value_lengths().to_numpy()
            sketches, keys = np.zeros((batch.num_rows, BITS // 64), np.int64), np.zeros((batch.num_rows, tables), np.int64)
            for width in np.unique(widths).tolist():
                if width not in known:
                    known[width] = planes(width, max(BITS, bits * tables))
                alike = np.flatnonzero(widths == width)
                for rows in np.split(alike, range(STEP, len(alike), STEP)):
                    signs = column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), width) @ known[width] > 0
                    sketches[rows] = np.packbits(signs[:, :BITS], axis=1).view(np.int64)
                    keys[rows] = signs[:, : bits * tables].reshape(len(rows), tables, bits) @ powers
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(sketches), _lists(keys)], names=[*batch.schema.names, "sketch", "keys"])

    return nodes.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", sketch array<long>, keys array<long>")


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _angle(a: str, b: str) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(a, b))))


def balls(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """node, ball (its pivot's node) and far, the angle to the pivot.

    The pivot of a first key is the least node of its most crowded second key.
    """
    first, second = F.get("keys", F.lit(0)).alias("first"), F.get("keys", F.lit(1)).alias("second")
    width = F.size("u").alias("width")
    keyed = nodes.select("node", "label", width, first, second, "u")
    crowds = keyed.groupBy("label", "width", "first", "second").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("node", "u"), "node").alias("pivot"))
    pivots = crowds.groupBy("label", "width", "first").agg(F.max_by("pivot", F.struct("n", -F.col("pivot.node"))).alias("pivot"), F.sum("n").alias("n")).where("n > 1")
    # Written, so that the join sees two plain exchanges and can split a hot key.
    pivots = materialize(pivots.select("label", "width", "first", F.col("pivot.node").alias("ball"), F.col("pivot.u").alias("p")), "pivots")
    near = keyed.join(pivots.hint("merge"), ["label", "width", "first"], "left").withColumn("far", F.when(F.col("node") == F.col("ball"), 0.0).otherwise(_angle("u", "p")))
    within = F.col("ball").isNotNull() & (F.col("far") <= acos(cosine) / 2 - SLACK)
    return near.select("node", F.when(within, F.col("ball")).otherwise(F.col("node")).alias("ball"), F.when(within, F.col("far")).otherwise(0.0).alias("far"))


def company(nodes: DataFrame, members: DataFrame, radii: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs of balls (a, b), a < b, that share a key and whose sketches are close enough.

    A ball takes part in the keys of all its members, each once, with the sketch of its pivot.
    """
    keyed = nodes.join(members.select("node", "ball"), "node").select("ball", "label", F.size("u").alias("width"), F.posexplode("keys").alias("t", "key")).distinct()
    crowds = keyed.groupBy("label", "width", "t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowds = materialize(crowds.select("label", "width", "t", "key", F.ceil(F.col("n") / CELL).cast("int").alias("parts")), "crowds")
    sketches = radii.join(nodes.select(F.col("node").alias("ball"), "sketch"), "ball").select("ball", "radius", "sketch")
    met = keyed.join(crowds.hint("merge"), ["label", "width", "t", "key"]).join(materialize(sketches, "pivot-sketches").hint("merge"), "ball")
    part = F.pmod(F.xxhash64("ball"), F.col("parts")).cast("int")
    # Beyond one part, each pair of parts is a cell.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    split = met.select("label", "width", "t", "key", part.alias("part"), other, "ball", "radius", "sketch")
    low, high = F.least("part", "other"), F.greatest("part", "other")
    cell = F.xxhash64("label", "width", "t", "key", low, high).alias("cell")
    rows = split.select(cell, (F.col("part") == low).alias("left"), (F.col("part") == high).alias("right"), "ball", "radius", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, in_left, in_right, ball, radius, sketch in _cells(batches):
            signs = np.unpackbits(np.ascontiguousarray(sketch).view(np.uint8), axis=1).astype(np.float32) * 2 - 1
            left, right = np.flatnonzero(in_left), np.flatnonzero(in_right)
            for rows in np.array_split(left, max(1, len(left) * len(right) // 2_000_000)):
                differ = (BITS - signs[rows] @ signs[right].T) / 2
                share = np.minimum(1.0, (acos(cosine) + radius[rows][:, None] + radius[right][None, :]) / pi)
                allowed = BITS * share + 6 * np.sqrt(BITS * share * (1 - share)) + 1
                x, y = np.nonzero((differ <= allowed) & (ball[rows][:, None] != ball[right][None, :]))
                if not len(x):
                    continue
                # Within one part each pair is met from both sides; in a cell of two parts the lesser ball may be on the right.
                a, b = ball[rows[x]], ball[right[y]]
                found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of the rows that share a value of the first, sorted column; the last column holds sketches."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]] + [batch.columns[-1].flatten().to_numpy().reshape(-1, BITS // 64)]
        if kept:
            columns = [np.concatenate(pair) for pair in zip(kept, columns)]
        starts = [0, *(np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1).tolist()]
        for start, stop in zip(starts, starts[1:]):
            yield [c[start:stop] for c in columns]
        kept = [c[starts[-1] :] for c in columns] if batch.num_rows or kept else None
    if kept:
        yield kept


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Tables of the rows that share a value of the sorted column ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        starts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        if held and held[-1].column(key)[0].as_py() != values[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        for start, stop in zip(starts, starts[1:]):
            if start:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def compared(pairs: DataFrame, nodes: DataFrame, members: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links between members of the pairs of balls: node, its links of this kind, and one partner.

    Members meet in blocks of at most ``CELL``.
    """
    sizes = members.groupBy("ball").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"))
    sizes = materialize(sizes, "ball-parts")
    of = lambda side: sizes.withColumnsRenamed({"ball": side, "parts": f"parts_{side}"}).hint("merge")
    numbered = materialize(pairs.join(of("a"), "a").join(of("b"), "b"), "compared-balls")
    own = members.join(nodes.select("node", "u", "weight"), "node").join(sizes.hint("merge"), "ball").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("parts")

    def side(mine: str, others: str) -> DataFrame:
        copies = numbered.select(F.col(mine).alias("ball"), "a", "b", F.explode(F.sequence(F.lit(0), F.col(f"parts_{others}") - 1)).alias("other"))
        met = own.join(copies.hint("merge"), "ball")
        places = ("part", "other") if mine == "a" else ("other", "part")
        return met.select(F.xxhash64("a", "b", *places).alias("cell"), F.lit(mine == "a").alias("left"), "node", "weight", "u")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _groups(batches, 0):
            left = held["left"].to_numpy(zero_copy_only=False)
            node, weight = held["node"].to_numpy(), held["weight"].to_numpy()
            u = held["u"].combine_chunks()
            u = u.values.to_numpy()[u.offsets[0].as_py() :].reshape(held.num_rows, -1)
            close = u[left] @ u[~left].T >= cosine
            for own, other, links in ((left, ~left, close), (~left, left, close.T)):
                n = links @ weight[other]
                some = n > 0
                partner = node[other][links[some].argmax(axis=1)] if some.any() else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node[own][some]), pa.array(n[some]), pa.array(partner)], names=["node", "n", "partner"])

    rows = side("a", "b").unionByName(side("b", "a"))
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "node long, n long, partner long")


def near_duplicates(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    vectors = materialize(unit_vectors(rows), "unit-vectors")
    nodes = vectors.where("u IS NOT NULL").groupBy("label", "u").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    bits, tables = plan(vectors.count(), cosine)
    nodes = materialize(sketched(nodes.select("node", "label", "weight", "u"), bits, tables), "nodes")

    members = materialize(balls(nodes, cosine), "balls")
    weighed = members.join(nodes.select("node", "weight"), "node")
    radii = materialize(weighed.groupBy("ball").agg(F.max("far").alias("radius"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("size")), "radii")
    met = materialize(company(nodes, members, radii.select("ball", "radius"), cosine), "company")

    pivots = materialize(radii.join(nodes.select(F.col("node").alias("ball"), "u"), "ball"), "ball-pivots")
    of = lambda side: pivots.select(F.col("ball").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("radius", "weight", "size", "u"))).hint("merge")
    angles = met.join(of("a"), "a").join(of("b"), "b").withColumn("dot", _dot("u_a", "u_b")).withColumn("angle", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("dot")))))
    reach, limit = F.col("radius_a") + F.col("radius_b"), acos(cosine)
    alone = (F.col("size_a") == 1) & (F.col("size_b") == 1)
    kind = (
        F.when(alone, F.when(F.col("dot") >= cosine, "all").otherwise("none"))
        .when(F.col("angle") + reach <= limit - SLACK, "all").when(F.col("angle") - reach > limit + SLACK, "none").otherwise("some")
    )
    judged = materialize(angles.select("a", "b", "weight_a", "weight_b", kind.alias("kind")).where("kind <> 'none'"), "judged")
    some = materialize(compared(judged.where("kind = 'some'").select("a", "b"), nodes, members, cosine), "compared")

    # Links of a ball: all within it, and all of the balls that it is linked with as a whole.
    whole = judged.where("kind = 'all'")
    both = whole.select(F.col("a").alias("ball"), F.col("weight_b").alias("n")).unionAll(whole.select("b", "weight_a"))
    outside = both.groupBy("ball").agg(F.sum("n").alias("outside"))
    of_ball = radii.join(outside.hint("merge"), "ball", "left").select("ball", (F.col("weight") - 1 + F.coalesce("outside", F.lit(0))).alias("n"))
    of_node = some.groupBy("node").agg(F.sum("n").alias("m"))
    links = members.join(of_ball.hint("merge"), "ball").join(of_node.hint("merge"), "node", "left").select("node", (F.col("n") + F.coalesce("m", F.lit(0))).alias("n_links"))
    edges = members.select(F.col("node").alias("a"), F.col("ball").alias("b")).union(whole.select("a", "b")).union(some.select("node", "partner"))
    joined = components(materialize(edges.where("a <> b"), "near-links"))

    of_nodes = links.join(joined.hint("merge"), "node", "left").select("node", "n_links", F.coalesce("component", "node").alias("component_id"))
    by_vector = nodes.select("label", "u", "node").join(of_nodes.hint("merge"), "node").select("label", "u", "n_links", "component_id")
    key = F.xxhash64("u").alias("h")
    found = vectors.where("u IS NOT NULL").withColumn("h", key).join(by_vector.withColumn("h", key).hint("merge"), ["label", "h", "u"]).select("vec_id", "n_links", "component_id")
    rest = vectors.where("u IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings``."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a) USING (vec_id)
"""
