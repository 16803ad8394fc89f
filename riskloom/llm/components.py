"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize


#: Parts over which the neighbours of one node are dealt.
SALTS = 16


def _salted_join(pairs: DataFrame, of_node: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with the columns of ``of_node``, one row per u."""
    copies = of_node.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(copies, ["u", "salt"])


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) for every node of an edge (a, b).

    Large-star and small-star steps in turn until nothing changes. A step takes the least
    neighbour of each node by an aggregate and joins it back, over ``SALTS`` parts of the
    neighbours, so no task needs all neighbours of a node at once. Each round is a written
    table, so executors may be lost.
    """
    plain = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    current, before = materialize(plain, "edges"), None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _salted_join(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _salted_join(large, smallest).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        current = materialize(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), "edges")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(current.select("v", F.col("v")).distinct())
