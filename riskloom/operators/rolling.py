"""Strictly-past rolling statistics and previous-transaction features per card."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from riskloom.functions import scalar as X
from riskloom.operators.ordered import ROWS_PER_KEY, hot_key_hashes, null_safe, previous_row, split_hot

# A sliding frame re-adds its rows for every row, so its cost per card grows with the
# square of the rows inside the longest window; dense cards go to the cell plan early.
ROWS_PER_CARD = 50_000
_PARTS = ("n", "s1", "s2")


def statistic_names(label: str, prefix: str = "rolling") -> dict[str, str]:
    return {
        "count": f"{prefix}_count_{label}", "sum": f"{prefix}_amt_sum_{label}",
        "mean": f"{prefix}_amt_mean_{label}", "std": f"{prefix}_amt_std_{label}",
    }


def rolling_past(
    df: DataFrame,
    card: str,
    epoch: str,
    amount: str,
    windows: Mapping[str, int],
    prefix: str = "rolling",
    limit: int = ROWS_PER_CARD,
    hot_keys: list[int] | str | None = None,
) -> DataFrame:
    """Count, sum, mean and sample deviation of the amount over ``[t - width, t)`` per card.

    ``epoch`` is an integer clock and widths use its unit.  An empty window gives 0, 0,
    null, null; a single row gives a null deviation.  Rows at the same instant never see
    each other.
    """
    if hot_keys is None:
        hot_keys = hot_key_hashes(df, [card], limit)
    cold, hot = split_hot(df, [card], hot_keys)
    parts = []
    if cold is not None:
        parts.append(_sliding(cold, card, epoch, amount, windows, prefix))
    if hot is not None:
        parts.append(_cells(hot, card, epoch, amount, windows, prefix))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _sliding(df: DataFrame, card: str, epoch: str, amount: str, windows: Mapping[str, int], prefix: str) -> DataFrame:
    ordered = Window.partitionBy(card).orderBy(epoch)
    out: dict[str, Column] = {}
    for label, width in windows.items():
        past = ordered.rangeBetween(-width, -1)
        names = statistic_names(label, prefix)
        out[names["count"]] = F.count(amount).over(past)
        out[names["sum"]] = F.coalesce(F.sum(amount).over(past), F.lit(0.0))
        out[names["mean"]] = F.avg(amount).over(past)
        out[names["std"]] = F.stddev_samp(amount).over(past)
    return df.withColumns(out)


def cell_width(width: int) -> int:
    """About 1/60 of the window, and a divisor of it: frames over cells stay short."""
    return next(width // parts for parts in (60, 48, 30, 24, 20, 12, 10, 8, 6, 5, 4, 3, 2, 1) if width % parts == 0)


def _cells(df: DataFrame, card: str, epoch: str, amount: str, windows: Mapping[str, int], prefix: str) -> DataFrame:
    """The same statistics for cards too dense for one task, in time linear in the rows.

    Rows collapse to one record per (card, instant).  All parts of a window are plain sums
    of doubles over its own records, never differences, so a NaN or an extreme amount
    stays in the windows that hold it.
    """
    # Sums are kept around the mean of the finite amounts so that the variance does not cancel.
    finite = F.when((F.col(amount) - F.col(amount)) == 0, F.col(amount))
    centre = df.agg(F.coalesce(F.avg(finite), F.lit(0.0)).alias("c")).scalar()
    centred = F.col(amount) - F.col("_centre")
    moments = (
        df.select(card, epoch, amount).withColumn("_centre", centre)
        .groupBy(card, epoch, "_centre")
        .agg(F.count(amount).alias("n"), F.sum(centred).alias("s1"), F.sum(centred * centred).alias("s2"))
        .withColumns({p: F.coalesce(p, F.lit(0)) for p in _PARTS})
    )
    out = df
    for label, width in windows.items():
        names = statistic_names(label, prefix)
        n, s1, s2 = (F.col(p) for p in _PARTS)
        spread = F.greatest(F.lit(0.0), s2 - s1 * s1 / n)
        found = _window_sums(moments, card, epoch, width).select(
            card, epoch,
            n.cast("bigint").alias(names["count"]),
            F.when(n > 0, s1 + n * F.col("_centre")).otherwise(F.lit(0.0)).alias(names["sum"]),
            F.when(n > 0, s1 / n + F.col("_centre")).alias(names["mean"]),
            F.when(n > 1, F.sqrt(spread / (n - 1))).alias(names["std"]),
        )
        out = null_safe(out, found, [card, epoch])
    return out


def _window_sums(moments: DataFrame, card: str, epoch: str, width: int) -> DataFrame:
    """Sums of the moments over ``[t - width, t)`` for every (card, instant).

    Time is cut into cells.  A window is three disjoint parts: the whole cells between its
    ends, the start of the row's own cell, and the end of the cell the window opens in.
    The last two are running sums inside one cell, so no task holds more than a cell.
    """
    cell = cell_width(width)
    placed = moments.withColumn("_cell", F.floor((F.col(epoch) - F.pmod(F.col(epoch), F.lit(cell))) / F.lit(cell)))
    steps = width // cell
    cells = placed.groupBy(card, "_cell").agg(*[F.sum(p).alias(p) for p in _PARTS])
    between = Window.partitionBy(card).orderBy("_cell").rangeBetween(-(steps - 1), -1)
    whole = {p: F.coalesce(F.sum(p).over(between), F.lit(0)) if steps > 1 else F.lit(0) for p in _PARTS}
    middle = cells.select(card, "_cell", F.lit(-1).alias("_ask"), *[c.alias(f"_mid_{p}") for p, c in whole.items()])
    # Inside a cell three kinds of rows meet, told apart by _ask: its whole-cell sums (-1), the
    # opening cell of the window shifted forward onto it (0), and its own instants (1).
    asks = placed.withColumns({"_ask": F.lit(1), "_at": F.col(epoch)})
    shifted = placed.select(
        card, *_PARTS, (F.col("_cell") + steps).alias("_cell"), F.lit(0).alias("_ask"), (F.col(epoch) + width).alias("_at")
    )
    inside = asks.unionByName(shifted, allowMissingColumns=True).unionByName(middle, allowMissingColumns=True)
    in_cell = Window.partitionBy(card, "_cell")
    forwards = in_cell.orderBy("_ask", "_at").rowsBetween(Window.unboundedPreceding, -1)
    backwards = in_cell.orderBy(F.col("_at").desc(), F.col("_ask")).rowsBetween(Window.unboundedPreceding, 0)

    def total(ask: int, value: str, frame: WindowSpec) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_ask") == ask, F.col(value))).over(frame), F.lit(0))

    sums = {f"_{p}": total(1, p, forwards) + total(-1, f"_mid_{p}", forwards) + total(0, p, backwards) for p in _PARTS}
    return inside.withColumns(sums).filter(F.col("_ask") == 1).select(card, epoch, "_centre", *[F.col(f"_{p}").alias(p) for p in _PARTS])


def consecutive_features(
    df: DataFrame,
    card: str,
    epoch: str,
    tie: str,
    lat: str,
    lon: str,
    ticks_per_second: int = 1,
    limit: int = ROWS_PER_KEY,
    hot_keys: list[int] | str | None = None,
) -> DataFrame:
    """Distance, elapsed seconds and speed against the card's previous transaction."""
    lagged = previous_row(
        df, [card], [F.col(epoch), F.col(tie)], {lat: "_prev_lat", lon: "_prev_lon", epoch: "_prev_epoch"}, limit, hot_keys
    )
    return (
        lagged.withColumn("dist_consecutive_km", X.haversine_km(F.col(lat), F.col(lon), F.col("_prev_lat"), F.col("_prev_lon")))
        .withColumn("time_since_last_tx", (F.col(epoch) - F.col("_prev_epoch")) / F.lit(float(ticks_per_second)))
        .withColumn("velocity_kmh", X.speed_kmh(F.col("dist_consecutive_km"), F.col("time_since_last_tx")))
        .drop("_prev_lat", "_prev_lon", "_prev_epoch")
    )
