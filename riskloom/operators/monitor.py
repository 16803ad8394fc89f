"""Drift, fairness, service levels and period reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators.metrics import confusion_at
from riskloom.operators.ordered import ROWS_PER_KEY, many_valued_keys, null_safe, prior_totals
from riskloom.operators.selection import exact_quantiles, quantile_table

_EMPTY_SHARE = 1e-6


def psi_drift(df: DataFrame, feature: str, is_baseline: Column, period: Column, bins: int = 10, alert: float = S.PSI_ALERT, **tuning: int) -> DataFrame:
    """Population stability index of a feature per period against the baseline.

    Bin borders are the baseline's quantiles.  One scan counts baseline and periods; what
    follows has bins x periods rows.
    """
    edges = exact_quantiles(df.filter(is_baseline), feature, [i / bins for i in range(1, bins)], **tuning)[()]
    # Heavily tied features repeat borders; a repeated border would be an always-empty bin.
    edges = sorted(set(edges))
    counts = df.filter(F.col(feature).isNotNull()).groupBy(
        F.coalesce(is_baseline, F.lit(False)).alias("_baseline"), period.alias("period"), X.bins_right_closed(F.col(feature), edges).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    base = counts.filter("_baseline").groupBy("bin").agg(F.sum("n").alias("_b"))
    base_total = base.agg(F.sum("_b")).scalar()
    # Current rows without a period belong to none.
    current = counts.filter(~F.col("_baseline") & F.col("period").isNotNull()).drop("_baseline")
    totals = current.groupBy("period").agg(F.sum("n").alias("_total"))
    all_bins = totals.select("period", "_total", F.explode(F.sequence(F.lit(0), F.lit(len(edges)))).alias("bin"))
    shares = all_bins.join(current, ["period", "bin"], "left").join(base, "bin", "left").select(
        "period",
        F.greatest(F.coalesce(F.col("n"), F.lit(0)) / F.col("_total"), F.lit(_EMPTY_SHARE)).alias("p"),
        F.greatest(F.coalesce(F.col("_b"), F.lit(0)) / base_total, F.lit(_EMPTY_SHARE)).alias("q"),
    )
    return shares.groupBy("period").agg(F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))).alias("psi")).withColumn(
        "alert", F.col("psi") > F.lit(alert)
    )


def ks_drift(df: DataFrame, feature: str, is_baseline: Column, limit: int = ROWS_PER_KEY) -> DataFrame:
    """Largest gap between the two empirical distributions, over distinct values."""
    known = df.filter(F.col(feature).isNotNull())
    values = known.groupBy(F.col(feature).alias("v")).agg(
        F.sum(is_baseline.cast("bigint")).alias("b"), F.sum((~is_baseline).cast("bigint")).alias("c")
    )
    running = prior_totals(values, [], [F.col("v")], {"cum_b": F.col("b"), "cum_c": F.col("c")}, inclusive=True,
                           hot_keys=many_valued_keys(known, [], feature, limit))
    totals = known.agg(F.struct(
        F.sum(is_baseline.cast("bigint")).alias("b"), F.sum((~is_baseline).cast("bigint")).alias("c")
    ).alias("t")).scalar()
    gap = F.abs(F.col("cum_b") / F.col("_t.b") - F.col("cum_c") / F.col("_t.c"))
    return running.withColumn("_t", totals).agg(
        F.max(gap).alias("ks"), F.max("_t.b").alias("n_baseline"), F.max("_t.c").alias("n_current")
    )


def fairness_by_group(
    df: DataFrame,
    label: str,
    score: str,
    groups: Mapping[str, Column],
    threshold: float = S.OPERATING_THRESHOLD,
    min_rows: int = S.FAIRNESS_MIN_ROWS,
    ratios: Mapping[str, float] = S.FAIRNESS_RATIO,
) -> DataFrame:
    """False-positive rate and recall per group value, flagged against the dimension's median.

    Groups below ``min_rows`` are not measured.  Group values are few (states, age groups,
    categories), so the median works on a handful of rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("value")) for d, c in groups.items()]))
    rows = df.select(label, score, pairs.alias("_g")).select(label, score, "_g.*").filter(F.col("value").isNotNull())
    counted = confusion_at(rows, label, score, threshold, by=["dimension", "value"])
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    rates = counted.withColumns({
        "n": n,
        "fpr": F.when(F.col("fp") + F.col("tn") > 0, F.col("fp") / (F.col("fp") + F.col("tn"))),
        "tpr": F.when(F.col("fn") + F.col("tp") > 0, F.col("tp") / (F.col("fn") + F.col("tp"))),
    }).filter(F.col("n") >= min_rows)
    middle = rates.groupBy("dimension").agg(
        F.percentile("fpr", F.lit(0.5)).alias("_fpr"), F.percentile("tpr", F.lit(0.5)).alias("_tpr")
    )
    allowed = F.lit(2.0)
    for dimension, ratio in ratios.items():
        allowed = F.when(F.col("dimension") == dimension, F.lit(ratio)).otherwise(allowed)

    def off(rate: str, median: str) -> Column:
        too_high = F.col(rate) > allowed * F.col(median)
        too_low = F.col(rate) * allowed < F.col(median)
        return F.coalesce(too_high | too_low, F.lit(False))

    # One row per dimension.
    return rates.join(F.broadcast(middle), "dimension").select(
        "dimension", "value", "n", "fpr", F.col("tpr").alias("recall"),
        off("fpr", "_fpr").alias("fpr_flag"), off("tpr", "_tpr").alias("recall_flag"),
    )


def period_report(df: DataFrame, merchant: str, clock: str, decision: str, label: str, amount: str) -> DataFrame:
    """Per merchant and half month: handled, approved, blocked, escalated, saved amount, false positives.

    A roll-up adds each merchant's total and the grand total (null keys, told apart by
    ``level``); partial sums per task make a dominant merchant one record per task.
    """
    blocked, fraud = F.col(decision) == "block", F.col(label) == 1

    def count(condition: Column) -> Column:
        return F.sum(condition.cast("bigint"))

    keyed = df.withColumn("period", X.half_month(F.col(clock)))
    return keyed.rollup(F.col(merchant).alias("merchant"), "period").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("n_reviewed"), count(F.col(decision) == "approve").alias("n_auto_approved"),
        count(blocked).alias("n_auto_blocked"), count(F.col(decision) == "pending_review").alias("n_escalated"),
        F.sum(F.when(blocked & fraud, F.col(amount)).otherwise(0.0)).alias("saved_amount"),
        count(blocked & ~fraud).alias("n_false_positives"),
    )


def service_levels(df: DataFrame, latency: str, clock: str, shift: Column, probability: float = 0.99, **tuning: int) -> DataFrame:
    """Per shift: latency percentile, mean resolution and peak rows per second."""
    keyed = df.withColumn("shift", shift)
    tails = quantile_table(keyed, latency, {"p99": probability}, ["shift"], **tuning)
    per_second = keyed.groupBy("shift", F.date_trunc("second", F.col(clock)).alias("_s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(latency).alias("t"), F.count(latency).alias("m")
    )
    levels = per_second.groupBy("shift").agg(
        F.sum("n").alias("n"), F.max("n").alias("peak_per_second"), (F.sum("t") / F.sum("m")).alias("mean_latency")
    )
    return null_safe(levels, tails, ["shift"])
