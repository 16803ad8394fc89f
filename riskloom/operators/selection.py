"""Exact order statistics by repeated histograms: scans only, no sort and no row shuffle.

Each pass counts the rows of the still open value ranges in equal-width bins (map-side
combined, at most bins x ranges result rows), then narrows every range to the bin that
holds the wanted rank.  Bins report their own smallest and largest value, so the next
range is exact.  When few rows are left, their distinct values finish the search.  Numbers
use equal-width bins, text its leading characters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from riskloom.operators.ordered import ROWS_PER_KEY, many_valued_keys, null_safe, prior_totals

BINS = 2048
FINISH_ROWS = 20_000
#: Groups that become literals of the histogram expression; more are ranked by a sorted plan.
MAX_GROUPS = 256


@dataclass(frozen=True)
class Ranked:
    """The value at a rank, with the rows strictly below it and equal to it."""

    value: object
    below: int
    equal: int
    total: int


@dataclass
class _Range:
    group: tuple
    low: object
    high: object
    below: int
    rows: int
    ranks: list[int] = field(default_factory=list)


def select_ranks(
    df: DataFrame,
    value: str,
    ranks: Callable[[tuple, int], Sequence[int]],
    by: Sequence[str] = (),
    bins: int = BINS,
    finish_rows: int = FINISH_ROWS,
) -> dict[tuple, dict[int, Ranked]]:
    """Value at each wanted 1-based ascending rank per group; nulls and NaN are not counted.

    ``ranks(group, n)`` names the ranks once the group size is known.  The answer is one
    entry per group and rank, so groups are classes, splits or tied scores, not row keys.
    """
    by = list(by)
    data = df.select(*by, F.col(value).alias("_v"))
    if data.schema["_v"].dataType.typeName() in ("double", "float"):
        data = data.withColumn("_v", F.when(~F.isnan("_v"), F.col("_v")))
    stats = data.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    heads = stats.collect()
    found: dict[tuple, dict[int, Ranked]] = {}
    totals: dict[tuple, int] = {}
    open_ranges: list[_Range] = []
    for row in heads:
        group = tuple(row[c] for c in by)
        wanted = sorted(set(ranks(group, row["_n"]))) if row["_n"] else []
        found[group], totals[group] = {}, row["_n"]
        if any(r < 1 or r > row["_n"] for r in wanted):
            raise ValueError(f"rank outside 1..{row['_n']}: {wanted}")
        if wanted:
            open_ranges.append(_Range(group, row["_lo"], row["_hi"], 0, row["_n"], wanted))

    if len(heads) > MAX_GROUPS:
        return _sorted_ranks(data, by, open_ranges, found, totals)
    while True:
        still_open = []
        for r in open_ranges:
            if r.low == r.high:
                for k in r.ranks:
                    found[r.group][k] = Ranked(r.low, r.below, r.rows, totals[r.group])
            else:
                still_open.append(r)
        if not still_open:
            return found
        fine = sum(r.rows for r in still_open) <= finish_rows
        open_ranges = _narrow(data, by, still_open, None if fine else bins)
        if [(r.group, r.low, r.high, r.rows) for r in open_ranges] == [(r.group, r.low, r.high, r.rows) for r in still_open]:
            raise RuntimeError(f"bins of {value} do not narrow {open_ranges[0]}")


def _sorted_ranks(data: DataFrame, by: list[str], ranges: list[_Range], found: dict, totals: dict) -> dict[tuple, dict[int, Ranked]]:
    """The same for many groups: running counts over the distinct values of each group."""
    keys = [data.schema[c] for c in by]
    wanted = [(*r.group, k) for r in ranges for k in r.ranks]
    asked = data.sparkSession.createDataFrame(wanted, StructType([*keys, StructField("_rank", LongType())]))
    values = data.filter(F.col("_v").isNotNull()).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    running = prior_totals(values, by, [F.col("_v")], {"_below": F.col("_n")})
    for r in null_safe(running, asked, by, "inner").filter("_rank > _below AND _rank <= _below + _n").collect():
        group = tuple(r[c] for c in by)
        found[group][r["_rank"]] = Ranked(r["_v"], r["_below"], r["_n"], totals[group])
    return found


def _bin(r: _Range, bins: int) -> Column:
    """A bin number or name that never falls as the value rises."""
    if isinstance(r.low, str):
        # Text: characters beyond those that the range has in common, two where they are ASCII.
        known = len(commonprefix([r.low, r.high]))
        return F.substring("_v", 1, known + (2 if (r.low[known:] + r.high[known:]).isascii() else 1))
    if isinstance(r.low, float) and not math.isfinite(r.high - r.low):
        # Infinite or overflowing: bins of the logarithm, in which infinity has a place of its own.
        scaled = F.signum("_v") * F.least(F.log1p(F.abs("_v")), F.lit(1000.0))
        low, high = (math.copysign(min(math.log1p(abs(x)), 1000.0), x) for x in (r.low, r.high))
        return F.floor((scaled - F.lit(low)) / F.lit((high - low) / (bins - 1))).cast("int")
    share = (F.col("_v") - F.lit(r.low)).cast("double") / F.lit(float(r.high - r.low))
    return F.least(F.floor(share * F.lit(float(bins))), F.lit(bins - 1)).cast("int")


def _narrow(data: DataFrame, by: list[str], ranges: list[_Range], bins: int | None) -> list[_Range]:
    range_id, bin_id = F.lit(None).cast("int"), F.lit(None)
    for i, r in enumerate(ranges):
        inside = F.col("_v").between(F.lit(r.low), F.lit(r.high))
        for column, key in zip(by, r.group):
            inside = inside & F.col(column).eqNullSafe(F.lit(key))
        range_id = F.when(inside, F.lit(i)).otherwise(range_id)
        if bins:
            bin_id = F.when(inside, _bin(r, bins)).otherwise(bin_id)
    # One plain interval over all ranges reaches the parquet scan as a pushed filter.
    low, high = min(r.low for r in ranges), max(r.high for r in ranges)
    tagged = data.filter(F.col("_v").between(F.lit(low), F.lit(high))).withColumn("_range", range_id)
    tagged = tagged.withColumn("_bin", bin_id if bins else F.when(F.col("_range").isNotNull(), F.col("_v")))
    # Rows outside every range form one null group, dropped below.  As a filter the test would
    # be pushed to the scan, with the value's whole expression copied into every range.
    counted = tagged.groupBy("_range", "_bin").agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    counted = sorted((r for r in counted.collect() if r["_range"] is not None), key=lambda r: (r["_range"], r["_bin"]))
    narrowed: list[_Range] = []
    below = {i: r.below for i, r in enumerate(ranges)}
    for row in counted:
        parent, start = ranges[row["_range"]], below[row["_range"]]
        wanted = [k for k in parent.ranks if start < k <= start + row["n"]]
        if wanted:
            narrowed.append(_Range(parent.group, row["lo"], row["hi"], start, row["n"], wanted))
        below[row["_range"]] = start + row["n"]
    return narrowed


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), **tuning: int
) -> dict[tuple, list[float]]:
    """Quantiles with linear interpolation between the two neighbouring rows."""

    def position(n: int, p: float) -> tuple[int, int, float]:
        at = p * (n - 1)
        low = math.floor(at)
        return low + 1, min(low + 2, n), at - low

    picked = select_ranks(
        df, value, lambda _, n: [k for p in probabilities for k in position(n, p)[:2]], by, **tuning
    )
    out: dict[tuple, list[float]] = {}
    for group, values in picked.items():
        if not values:
            out[group] = [None] * len(probabilities)
            continue
        n = next(iter(values.values())).total
        out[group] = []
        for p in probabilities:
            low, high, fraction = position(n, p)
            a, b = float(values[low].value), float(values[high].value)
            out[group].append(a + (b - a) * fraction)
    return out


def quantile_table(df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str], max_groups: int = MAX_GROUPS, **tuning: int) -> DataFrame:
    """One row per group (null keys are one) with an exact quantile per name, as ``exact_quantiles`` gives it.

    Few groups are searched by histograms; the table then carries a broadcast hint, as it has
    at most ``max_groups`` rows. More groups never leave Spark: rows are combined to distinct
    values per group, running counts tell which ranks each value holds, and a group that owns most
    values is cut into slices. Groups without values have null quantiles.
    """
    by = list(by)
    keys = [df.schema[c] for c in by]
    if df.select(*by).distinct().limit(max_groups + 1).count() <= max_groups:
        found = exact_quantiles(df, value, list(probabilities.values()), by, **tuning)
        kind = StructType([*keys, *[StructField(name, DoubleType()) for name in probabilities]])
        return F.broadcast(df.sparkSession.createDataFrame([(*group, *q) for group, q in found.items()], kind))
    data = df.select(*by, F.col(value).cast("double").alias("_v")).withColumn("_v", F.when(~F.isnan("_v"), F.col("_v")))
    groups = data.groupBy(*by).agg(F.count("_v").alias("_total"))
    values = data.filter(F.col("_v").isNotNull()).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    running = prior_totals(
        values, by, [F.col("_v")], {"_below": F.col("_n")}, hot_keys=many_valued_keys(data, by, "_v", ROWS_PER_KEY))
    ranked = null_safe(groups, running, by)
    held, ends = F.lit(False), {}
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for end, rank in (("low", F.floor(at) + 1), ("high", F.least(F.floor(at) + 2, F.col("_total")))):
            here = (F.col("_below") < rank) & (rank <= F.col("_below") + F.col("_n"))
            held, ends[f"_{end}_{name}"] = held | here, F.max(F.when(here, F.col("_v")))
    # Only values at a wanted rank go on, and one row of every group without values.
    picked = ranked.filter(held | (F.col("_total") == 0)).groupBy(*by).agg(
        F.max("_total").alias("_total"), *[c.alias(n) for n, c in ends.items()])

    def between(name: str, p: float) -> Column:
        at, low, high = F.lit(float(p)) * (F.col("_total") - 1), F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return (low + (high - low) * (at - F.floor(at))).alias(name)

    return picked.select(*by, *[between(name, p) for name, p in probabilities.items()])


@dataclass(frozen=True)
class Cut:
    """The row at position ``rank`` of an order by value, ties broken by a unique id."""

    rank: int
    value: object
    tie: object | None
    descending: bool

    def includes(self, value: Column, tie: Column) -> Column:
        """True for exactly the first ``rank`` rows.  A narrow expression: no shuffle."""
        ahead = value > F.lit(self.value) if self.descending else value < F.lit(self.value)
        tied = value == F.lit(self.value)
        return ahead | (tied if self.tie is None else tied & (tie <= F.lit(self.tie)))


def cut_points(
    df: DataFrame,
    value: str,
    tie: str,
    ranks: Callable[[int], Sequence[int]],
    descending: bool = False,
    **tuning: int,
) -> list[Cut]:
    """Borders of the first k rows for each wanted k; only rows tied at a border are re-ranked."""
    wanted: list[int] = []

    def ascending_ranks(_: tuple, n: int) -> list[int]:
        wanted.extend(ranks(n))
        return [n - k + 1 if descending else k for k in wanted]

    picked = select_ranks(df, value, ascending_ranks, **tuning).get((), {})
    if not picked:
        return []
    ahead: dict[int, tuple[Ranked, int]] = {}
    for k in wanted:
        at = picked[next(iter(picked.values())).total - k + 1 if descending else k]
        before = at.total - at.below - at.equal if descending else at.below
        ahead[k] = (at, k - before)
    partial = {k: (at, need) for k, (at, need) in ahead.items() if need < at.equal}
    ties: dict[int, object] = {}
    if partial:
        values = sorted({at.value for at, _ in partial.values()})
        tied = df.filter(F.col(value).isin(values)).select(F.col(value).alias("_cut"), tie)
        chosen = select_ranks(
            tied, tie, lambda g, _: [need for at, need in partial.values() if at.value == g[0]], by=["_cut"], **tuning
        )
        ties = {k: chosen[(at.value,)][need].value for k, (at, need) in partial.items()}
    return [Cut(k, ahead[k][0].value, ties.get(k), descending) for k in wanted]
