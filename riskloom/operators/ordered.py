"""Order-dependent operators that hold when one key owns a large share of the rows.

A plain window sends every row of a key to one task.  Keys below a row limit keep that
plan (one shuffle).  Keys above it are *sliced*: their rows are range-partitioned on the
full order, so slices are equal in rows whatever the key, each slice is summarised, and
the few summaries carry state from one slice to the next.  Results are the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

ROWS_PER_KEY = 1_000_000
MAX_LISTED_KEYS = 10_000
#: A slice is not cut below this many rows, whatever the limit, but there are always a few.
MIN_SLICE_ROWS, MIN_SLICES = 100, 3
#: Beyond so many slices each holds at least ``FULL_SLICE_ROWS``: a slice costs a task in every pass over the rows.
MANY_SLICES, FULL_SLICE_ROWS = 200, 100_000
ALL_KEYS = "all"


def hot_key_hashes(df: DataFrame, by: Sequence[str], limit: int) -> list[int] | str:
    """Hashes of keys with more than ``limit`` rows, or ``ALL_KEYS`` when too many to list.

    One column-pruned count with map-side combine.  Hashes are enough: a collision only
    sends a small key down the sliced path, which is exact for every key.
    """
    if not by:
        return ALL_KEYS if df.count() > limit else []
    hot = (
        df.groupBy(*by).count().filter(F.col("count") > limit)
        .select(F.xxhash64(*by).alias("h")).limit(MAX_LISTED_KEYS + 1).collect()
    )
    return ALL_KEYS if len(hot) > MAX_LISTED_KEYS else [r.h for r in hot]


def many_valued_keys(df: DataFrame, by: Sequence[str], value: str, limit: int) -> list[int] | str:
    """Like ``hot_key_hashes`` for rows that will be combined per distinct value.

    A sketch of the distinct values is enough, as both plans are exact: no shuffle of values.
    """
    estimate = F.approx_count_distinct(value).alias("n")
    if not by:
        return ALL_KEYS if df.agg(estimate).first().n > limit else []
    many = df.groupBy(*by).agg(estimate).filter(F.col("n") > limit).select(F.xxhash64(*by).alias("h"))
    found = many.limit(MAX_LISTED_KEYS + 1).collect()
    return ALL_KEYS if len(found) > MAX_LISTED_KEYS else [r.h for r in found]


def split_hot(df: DataFrame, by: Sequence[str], hot: list[int] | str) -> tuple[DataFrame | None, DataFrame | None]:
    """``(small keys, hot keys)``; either side is None when empty by construction."""
    if hot == ALL_KEYS:
        return None, df
    if not hot:
        return df, None
    is_hot = F.xxhash64(*by).isin(hot)
    return df.filter(~is_hot), df.filter(is_hot)


def _carry(by: Sequence[str], hot: list[int] | str, carried: DataFrame) -> DataFrame:
    """One record per (slice, key): at most slices + keys rows, as a key's slices are contiguous.

    With listed hot keys (or no key) that is a proven small bound, so it is broadcast;
    with too many hot keys to list Spark decides by size.
    """
    return carried if by and hot == ALL_KEYS else F.broadcast(carried)


def _combine(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    if hot is None:
        return cold
    return hot if cold is None else cold.unionByName(hot)


def slice_count(rows: int, limit: int) -> int:
    """Slices for so many rows.  A low limit cuts a small table finely, a large one not into ever more tasks."""
    fine = -(-rows // max(limit, MIN_SLICE_ROWS))
    return max(MIN_SLICES, min(fine, MANY_SLICES), -(-rows // max(limit, FULL_SLICE_ROWS)))


def slice_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int = ROWS_PER_KEY) -> DataFrame:
    """Add ``_slice``: contiguous, row-balanced ranges of the (key, order) sequence.

    Their number follows from the rows and the limit, not from session settings, and as it
    is given, adaptive execution keeps it.
    Written out once, so every later pass sees the same slice borders even when a task
    or an executor is lost and the range sample would be drawn again.
    """
    ranged = df.repartitionByRange(slice_count(df.count(), limit), *[F.col(c) for c in by], *order)
    return materialize(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other; the right copy of the keys is dropped."""
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for k in keys:
        match = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = match if condition is None else condition & match
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def prior_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    measures: dict[str, Column],
    inclusive: bool = False,
    limit: int = ROWS_PER_KEY,
    hot_keys: list[int] | str | None = None,
) -> DataFrame:
    """Running totals per key in a total order, without (default) or with the row itself.

    ``order`` must be free of ties within a key.  Each measure is summed over the rows
    before the current one; the first row of a key gets zero.  ``hot_keys`` passes the
    result of an earlier ``hot_key_hashes`` over the same keys.
    """
    by = list(by)
    end = Window.currentRow if inclusive else -1

    def running(frame_keys: Sequence[str]) -> dict[str, Column]:
        w = Window.partitionBy(*frame_keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return {name: F.coalesce(F.sum(f"_m_{name}").over(w), F.lit(0)) for name in measures}

    valued = df.withColumns({f"_m_{n}": c for n, c in measures.items()})
    helper = [f"_m_{n}" for n in measures]

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumns(running(by)).drop(*helper)

    def sliced(part: DataFrame) -> DataFrame:
        rows = slice_rows(part, by, order, limit)
        per_slice = rows.groupBy(*by, "_slice").agg(*[F.sum(h).alias(h) for h in helper])
        across = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = per_slice.select(
            *by, "_slice",
            *[F.coalesce(F.sum(f"_m_{n}").over(across), F.lit(0)).alias(f"_c_{n}") for n in measures],
        )
        local = rows.withColumns(running([*by, "_slice"]))
        joined = null_safe(local, _carry(by, hot_keys, carried), [*by, "_slice"])
        totals = {n: F.col(n) + F.col(f"_c_{n}") for n in measures}
        return joined.withColumns(totals).drop("_slice", *helper, *[f"_c_{n}" for n in measures])

    if hot_keys is None:
        hot_keys = hot_key_hashes(valued, by, limit)
    cold, hot = split_hot(valued, by, hot_keys)
    return _combine(plain(cold) if cold is not None else None, sliced(hot) if hot is not None else None)


def global_rank(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank", limit: int = ROWS_PER_KEY) -> DataFrame:
    """1-based ``row_number`` per key that never needs a key in one task."""
    return prior_totals(df, by, order, {name: F.lit(1).cast("bigint")}, inclusive=True, limit=limit)


def previous_row(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    columns: dict[str, str],
    limit: int = ROWS_PER_KEY,
    hot_keys: list[int] | str | None = None,
) -> DataFrame:
    """Bring columns of the key's previous row; ``columns`` maps source name to new name.

    ``hot_keys`` passes the result of an earlier ``hot_key_hashes`` over the same rows.
    """
    by = list(by)

    def lagged(frame_keys: Sequence[str]) -> dict[str, Column]:
        w = Window.partitionBy(*frame_keys).orderBy(*order)
        return {new: F.lag(old).over(w) for old, new in columns.items()}

    def sliced(part: DataFrame) -> DataFrame:
        rows = slice_rows(part, by, order, limit)
        local_order = Window.partitionBy(*by, "_slice").orderBy(*order)
        numbered = rows.withColumn("_pos", F.row_number().over(local_order))
        last = numbered.groupBy(*by, "_slice").agg(
            *[F.max_by(F.struct(old), "_pos").getField(old).alias(f"_l_{new}") for old, new in columns.items()]
        )
        across = Window.partitionBy(*by).orderBy("_slice")
        carried = last.select(*by, "_slice", *[F.lag(f"_l_{new}").over(across).alias(f"_c_{new}") for new in columns.values()])
        joined = null_safe(numbered.withColumns(lagged([*by, "_slice"])), _carry(by, hot_keys, carried), [*by, "_slice"])
        filled = {new: F.when(F.col("_pos") == 1, F.col(f"_c_{new}")).otherwise(F.col(new)) for new in columns.values()}
        return joined.withColumns(filled).drop("_slice", "_pos", *[f"_c_{new}" for new in columns.values()])

    if hot_keys is None:
        hot_keys = hot_key_hashes(df, by, limit)
    cold, hot = split_hot(df, by, hot_keys)
    return _combine(
        cold.withColumns(lagged(by)) if cold is not None else None, sliced(hot) if hot is not None else None
    )


def recent_values(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    value: str,
    n: int = 5,
    name: str = "recent",
    limit: int = ROWS_PER_KEY,
) -> DataFrame:
    """The key's last ``n`` values up to and including the row, oldest first."""
    by = list(by)

    def last_n(frame_keys: Sequence[str], what: Column) -> Column:
        w = Window.partitionBy(*frame_keys).orderBy(*order).rowsBetween(-(n - 1), Window.currentRow)
        return F.collect_list(what).over(w)

    def sliced(part: DataFrame) -> DataFrame:
        rows = slice_rows(part, by, order, limit)
        local_order = Window.partitionBy(*by, "_slice").orderBy(*order)
        # Boxed, so that rows with a null value keep their place; nulls go at the end.
        boxed = F.struct(F.col(value).alias("v"))
        local = rows.withColumn(name, last_n([*by, "_slice"], boxed)).withColumn("_pos", F.row_number().over(local_order))
        tails = local.groupBy(*by, "_slice").agg(F.max_by(name, "_pos").alias("_tail"))
        across = Window.partitionBy(*by).orderBy("_slice").rowsBetween(-n, -1)
        carried = tails.select(*by, "_slice", F.flatten(F.collect_list("_tail").over(across)).alias("_before"))
        joined = null_safe(local, _carry(by, hot_keys, carried), [*by, "_slice"])
        # A slice of a key holds at least one row, so n earlier slices are enough.
        full = F.concat(F.col("_before"), F.col(name))
        size = F.least(F.size(full), F.lit(n))
        last = F.when(F.col("_pos") < n, F.slice(full, F.size(full) - size + 1, size)).otherwise(F.col(name))
        values = F.transform(F.filter(last, lambda b: b["v"].isNotNull()), lambda b: b["v"])
        return joined.withColumn(name, values).drop("_slice", "_pos", "_before")

    hot_keys = hot_key_hashes(df, by, limit)
    cold, hot = split_hot(df, by, hot_keys)
    return _combine(
        cold.withColumn(name, last_n(by, F.col(value))) if cold is not None else None, sliced(hot) if hot is not None else None
    )
