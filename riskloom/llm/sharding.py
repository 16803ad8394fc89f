"""Histogram sort of documents into shards of near equal bytes, with built-in functions only.

The sort key is one long: its upper half comes from the text, its lower half from the row,
so equal texts lie side by side and a group of copies of any size can still be cut. The
borders between shards are found by counting: each pass adds up the bytes per bin of the
key ranges that are still open, and keeps the one bin that holds a border. Bins are a
rising function of the key, so sums over bins are exact counts of bytes below a border.
Passes end when every border meets the tolerance or cannot be refined. Then rows move once,
to (shard, part), where slots are numbered.

Null text has no bytes (size 1, checksum 0 of nothing). Repeated rows are kept, each with a
slot of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.session import materialize

SHARDS = 8
#: Bins per open key range and pass.
BINS = 512
#: A border may be off by this part of a shard's share.
TOLERANCE = 1e-5
#: Rows that share a (shard, part), on average.
ROWS_PER_PART = 50_000


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum and sort key of every row."""
    text = F.col("text")
    row = F.xxhash64(F.col("doc_id"), F.monotonically_increasing_id())
    key = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 32), 32).bitwiseOR(F.shiftrightunsigned(row, 32))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        key.alias("key"),
    )


@dataclass(frozen=True)
class _Range:
    """Keys low..high, with the weight of all keys below."""

    low: int
    high: int
    below: int


def _bin(key: Column, r: _Range, bins: int) -> Column:
    """Bin of a key in the range: its leading bits, as many as give no more than ``bins`` bins."""
    bits = max(0, (r.high - r.low).bit_length() - bins.bit_length() + 2)
    return F.shiftright(key, bits)


def splitters(rows: DataFrame, targets: list[int], allowed: float, weight: str = "size", bins: int = BINS) -> list[int]:
    """For each target the largest key that still lies below: the weight up to it meets the target.

    Ranges of different targets are equal or apart, so a row falls into one bin at most.
    """
    edge = rows.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    if edge["low"] is None:
        return [0] * len(targets)
    found: dict[int, int] = {}
    open_ = {t: _Range(edge["low"], edge["high"], 0) for t in set(targets)}
    while open_:
        ranges = sorted(set(open_.values()), key=lambda r: r.low)
        number, bin_ = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, r in enumerate(ranges):
            inside = F.col("key").between(r.low, r.high)
            number = F.when(inside, F.lit(i)).otherwise(number)
            bin_ = F.when(inside, _bin(F.col("key"), r, bins)).otherwise(bin_)
        histogram = (
            rows.withColumns({"_range": number, "_bin": bin_}).where("_range IS NOT NULL").groupBy("_range", "_bin")
            .agg(F.sum(weight).alias("weight"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        )
        for i, r in enumerate(ranges):
            filled = sorted((h for h in histogram if h["_range"] == i), key=lambda h: h["low"])
            for target in [t for t, own in open_.items() if own == r]:
                below, last = r.below, r.low - 1
                for h in filled:
                    if below + h["weight"] > target:
                        break
                    below, last = below + h["weight"], h["high"]
                else:
                    h = None
                over = below + h["weight"] - target if h else float("inf")
                if target - below <= allowed or h is None:
                    found[target] = last
                elif over <= allowed:
                    found[target] = h["high"]
                elif h["low"] == h["high"]:
                    found[target] = last if target - below <= over else h["high"]
                else:
                    open_[target] = _Range(h["low"], h["high"], below)
                    continue
                del open_[target]
    return [found[t] for t in targets]


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Shard and slot of every row; the rows of a shard are a range of the sort key."""
    rows = materialize(keyed(docs), "shard-keys")  # borders are compared with these keys again
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    size, number = total["bytes"] or 0, total["rows"]
    borders = splitters(rows, [size * i // shards for i in range(1, shards)], tolerance * size / shards)
    home = F.lit(0)
    for border in borders:
        home = home + (F.col("key") > F.lit(border)).cast("int")
    parts = max(64, number // (shards * ROWS_PER_PART))
    dealt = rows.withColumns({"shard": home, "part": F.pmod(F.col("key"), F.lit(parts)).cast("int")})
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("shard", "part").orderBy("key", "doc_id")
    return (
        dealt.withColumn("own", F.row_number().over(own)).join(shifts, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("shift") + F.col("own") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` over eight shards of near equal bytes."""
    return shard(table(spark, sf_dir, "documents"))
