"""Which of very many 64-bit hashes occur often: counted packed, held in a filter of bounded size.

Tasks send the distinct hashes they gather by ranges of their values, cut to 32 bits within
the range, with a count of one byte (or four, for large thresholds) beside each. Hashes that
are cut alike count as one, and a Bloom filter lets some through by chance: a frequent hash
is always told as frequent, a rare one nearly never.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import mix64

#: Bits of the filter for each frequent hash, and the most bits there are.
BITS_EACH, MAX_BITS = 16, 1 << 30
#: Hashes of a range, on average, and hashes that a task gathers before it sends them.
RANGE_HASHES, GATHER = 1 << 20, 1 << 20


def ranges_for(hashes: int) -> int:
    """Number of ranges, a power of two, for about so many hashes."""
    return 1 << min(31, max(4, ceil(log2(max(1, hashes / RANGE_HASHES)))))


def frequent(rows: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], ranges: int, least: int) -> DataFrame:
    """h, for the hashes that ``hashes`` finds ``least`` times in the rows; h is what ``Filter`` is made of."""
    high = ranges.bit_length() - 1
    kind = np.uint8 if least < 256 else np.uint32

    def packed(gathered: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate([*gathered, np.zeros(0, np.uint64)]) >> np.uint64(32 - high), return_counts=True)
        of = (keys >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        low, n = keys.astype(np.uint32), np.minimum(n, least).astype(kind)  # more than enough is enough
        slices = list(zip(starts, [*starts[1:], len(keys)]))
        columns = [of[starts], [low[a:b].tobytes() for a, b in slices], [n[a:b].tobytes() for a, b in slices]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=["range", "low", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []
        for some in hashes(batches):
            gathered.append(some)
            if sum(map(len, gathered)) >= GATHER:
                yield packed(gathered)
                gathered = []
            elif len(gathered) >= 1_000:
                gathered = [np.concatenate(gathered)]
        yield packed(gathered)

    def merge(group: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(b.as_buffer(), np.uint32) for b in group["low"]])
        n = np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in group["n"]])
        order = np.argsort(low, kind="stable")
        starts = np.flatnonzero(np.diff(low[order].astype(np.int64), prepend=-1))
        often = np.add.reduceat(n[order].astype(np.int64), starts) >= least
        key = (group["range"][0].as_py() << 32) + low[order][starts][often].astype(np.int64)
        return pa.table({"h": mix64(key.astype(np.uint64)).astype(np.int64)})

    return rows.mapInArrow(run, "range long, low binary, n binary").groupBy("range").applyInArrow(merge, "h long")


class Filter:
    """Bloom filter of 64-bit hashes with two probes.

    ``high`` is None for plain hashes. For what ``frequent`` gives it is the leading bits
    that make a range, and the filter is asked with the hashes that were counted.
    """

    def __init__(self, bits: int, held: np.ndarray, high: int | None = None):
        self.bits, self.held, self.high = bits, held, high

    def parts(self) -> tuple[int, np.ndarray, int | None]:
        """What to send to tasks."""
        return self.bits, self.held, self.high

    @staticmethod
    def positions(h: Column, bits: int) -> list[Column]:
        return [F.shiftrightunsigned(h, 64 - bits), h.bitwiseAND(F.lit((1 << bits) - 1))]

    @classmethod
    def of(cls, hashes: DataFrame, ranges: int | None = None) -> Filter:
        """Filter of the column h."""
        wanted = max(1, hashes.count()) * BITS_EACH
        bits = min(int(log2(MAX_BITS)), max(15, ceil(log2(wanted))))
        at = hashes.select(F.explode(F.array(*cls.positions(F.col("h"), bits))).alias("at"))
        # Rows of 32768 bits, numbered from 1 as their positions are; MAX_BITS bounds what reaches the driver.
        place = F.col("at") + 1
        maps = at.groupBy(F.bitmap_bucket_number(place).alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map"))
        held = np.zeros((1 << bits) // 8, np.uint8)
        for r in maps.toLocalIterator():
            base = (r["row"] - 1) * 4096
            held[base : base + 4096] = np.frombuffer(bytes(r["map"]), np.uint8)
        return cls(bits, held, ranges and ranges.bit_length() - 1)

    def has(self, hashed: np.ndarray) -> np.ndarray:
        h = hashed if self.high is None else mix64(hashed >> np.uint64(32 - self.high))
        low, high = h & np.uint64((1 << self.bits) - 1), h >> np.uint64(64 - self.bits)
        return self._bit(low) & self._bit(high)

    def held_by(self, spark: SparkSession) -> Callable[[Column], Column]:
        """Whether the filter holds the hashes of a column; only these go to Python, not the rows they are of."""
        shared = spark.sparkContext.broadcast(self.parts())

        def has(h: pd.Series) -> pd.Series:
            return pd.Series(Filter(*shared.value).has(h.to_numpy().view(np.uint64)))

        return F.pandas_udf(has, "boolean")

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
