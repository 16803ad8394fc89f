"""Data-quality and exploratory aggregates.  Each is one scan with map-side combine."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import scalar as X
from riskloom.operators.selection import exact_quantiles, quantile_table


def quality_report(df: DataFrame, label: str, clock: str, card: str) -> DataFrame:
    """Rows, positives, rate (0 when empty), time range and distinct cards."""
    n, pos = F.count(F.lit(1)), F.coalesce(F.sum((F.col(label) == 1).cast("bigint")), F.lit(0))
    return df.agg(
        n.alias("n_rows"), pos.alias("n_fraud"),
        F.when(n > 0, pos / n).otherwise(F.lit(0.0)).alias("fraud_rate"),
        F.min(clock).alias("first_time"), F.max(clock).alias("last_time"),
        F.count_distinct(card).alias("n_cards"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null)`` for columns that have nulls; all columns counted in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("bigint")).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_null")) for i, c in enumerate(columns)])
    return counts.select(F.inline(pairs)).filter(F.col("n_null") > 0)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class with the negatives-per-positive ratio."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    pos = F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0))
    ratio = counts.agg(((F.sum("n") - pos) / F.greatest(pos, F.lit(1))).alias("r")).scalar()
    return counts.withColumn("imbalance_ratio", ratio)


def rate_by_keys(df: DataFrame, label: str, keys: Mapping[str, Column], min_rows: int = 0) -> DataFrame:
    """``(key, value, n, n_pos, rate)`` for every key in one scan; null values are left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in keys.items()]))
    out = (
        df.select(F.col(label).alias("_y"), pairs.alias("_p")).select("_y", "_p.key", "_p.value")
        .filter(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("bigint").alias("n_pos"), F.avg("_y").alias("rate"))
    )
    return out.filter(F.col("n") >= min_rows) if min_rows else out


def per_card(df: DataFrame, card: str, label: str) -> DataFrame:
    return df.groupBy(card).agg(
        F.count(F.lit(1)).alias("tx"), F.sum(label).cast("bigint").alias("fraud_tx"),
        F.max((F.col(label) == 1).cast("int")).alias("any_fraud"),
    )


def card_summary(df: DataFrame, card: str, label: str) -> DataFrame:
    """Share of cards hit and the spread of transactions per card.

    ``percentile`` keeps one counter per distinct value; distinct per-card counts over N
    rows number at most sqrt(2N), so its buffer is bounded.
    """
    return per_card(df, card, label).agg(
        F.count(F.lit(1)).alias("n_cards"), F.sum("any_fraud").alias("n_fraud_cards"), F.avg("any_fraud").alias("fraud_card_share"),
        F.percentile("tx", F.lit(0.5)).alias("tx_median"), F.percentile("tx", F.lit(0.95)).alias("tx_p95"), F.max("tx").alias("tx_max"),
    )


def card_describe(df: DataFrame, card: str, label: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of per-card tx, fraud_tx and any_fraud."""
    cards = per_card(df, card, label)
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("v")) for c in ("tx", "fraud_tx", "any_fraud")
    ]))
    quartiles = F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        cards.select(pairs).groupBy("column")
        .agg(
            F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
            F.min("v").cast("double").alias("min"), quartiles.alias("q"), F.max("v").cast("double").alias("max"),
        )
        .select("column", "count", "mean", "std", "min",
                F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")
    )


def quantiles_by_class(df: DataFrame, label: str, values: Sequence[str], probabilities: Mapping[str, float], **tuning: int) -> DataFrame:
    """``measure, label, n, mean, max`` and exact quantiles of several values per class.

    All values share each scan, as rows of (measure, value).
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values]))
    long = df.select(F.col(label).cast("int").alias("label"), pairs)
    found = quantile_table(long, "value", probabilities, ["measure", "label"], **tuning)
    basic = long.groupBy("measure", "label").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max"))
    return basic.join(found, ["measure", "label"])


def conditional_quantile(df: DataFrame, value: str, probability: float, where: Column, **tuning: int) -> float | None:
    """Exact quantile over the rows that satisfy the condition (the training-only ceiling)."""
    found = exact_quantiles(df.filter(where), value, [probability], **tuning)
    return found[()][0] if () in found else None


def histogram(df: DataFrame, label: str, value: str, bins: int, low: float, high: float, log: bool = False) -> DataFrame:
    """Counts and density per class over equal-width bins, linear or in the logarithm."""
    v = F.log(F.col(value)) if log else F.col(value)
    lo, hi = (math.log(low), math.log(high)) if log else (float(low), float(high))
    counts = (
        df.select(F.col(label).cast("int").alias("label"), X.linear_bin(v, F.lit(lo), F.lit(hi), bins).alias("bin"))
        .groupBy("label", "bin").agg(F.count(F.lit(1)).alias("n")).filter(F.col("bin").isNotNull())
    )
    # classes x bins rows from here on
    totals = counts.groupBy("label").agg(F.sum("n").alias("_total"))
    step = (hi - lo) / bins
    left, right = F.lit(lo) + F.col("bin") * step, F.lit(lo) + (F.col("bin") + 1) * step
    width = F.exp(right) - F.exp(left) if log else F.lit(step)
    return counts.join(F.broadcast(totals), "label").select("label", "bin", "n", (F.col("n") / (F.col("_total") * width)).alias("density"))


def rate_spread(rates: DataFrame) -> DataFrame:
    """Highest over lowest group rate, over lowest non-zero rate, and groups without positives."""
    positive = F.when(F.col("rate") > 0, F.col("rate"))
    return rates.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_groups"), F.max("rate").alias("max_rate"), F.min("rate").alias("min_rate"),
        F.when(F.min("rate") > 0, F.max("rate") / F.min("rate")).alias("max_over_min"),
        (F.max("rate") / F.greatest(F.min(positive), F.lit(1e-9))).alias("max_over_lowest_nonzero"),
        F.sum((F.col("rate") == 0).cast("bigint")).alias("n_zero_groups"),
    )


def extreme_groups(rates: DataFrame, k: int = 20) -> DataFrame:
    """Top k groups by rate and bottom k with a rate above zero, ties broken by name."""
    top = rates.orderBy(F.desc("rate"), "value").limit(k).withColumn("side", F.lit("top"))
    bottom = rates.filter(F.col("rate") > 0).orderBy("rate", "value").limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def top_by_volume(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)
