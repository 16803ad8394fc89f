"""Cost of a decision threshold: a fixed price per false positive, the amount per missed fraud."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X


def threshold_grid(start: float = 0.05, step: float = 0.01, count: int = 91) -> list[float]:
    """Evenly stepped doubles: start + i * (second - first), as array ranges are built."""
    delta = (start + step) - start
    return [start + i * delta for i in range(count)]


def cost_sweep(
    df: DataFrame,
    label: str,
    score: str,
    amount: str,
    fp_costs: Sequence[float] = (S.COST_PER_FALSE_POSITIVE,),
    grid: Sequence[float] | None = None,
) -> DataFrame:
    """``fp_cost, threshold, n_fp, n_fn, cost_fn, total_cost`` for every threshold, in one scan.

    Each row falls in one gap of the grid; all thresholds follow from running sums over
    the gap totals, which are as many as the grid has values.
    """
    grid = list(grid or threshold_grid())
    negative, positive = F.col(label) == 0, F.col(label) == 1
    gaps = df.filter(F.col(score).isNotNull()).groupBy(X.digitize(F.col(score), grid).alias("gap")).agg(
        F.sum(negative.cast("bigint")).alias("neg"), F.sum(positive.cast("bigint")).alias("pos"),
        F.sum(F.when(positive, F.col(amount)).otherwise(0.0)).alias("amt"),
    )
    spark = df.sparkSession
    every = spark.range(len(grid) + 1).select(F.col("id").cast("int").alias("gap"))
    filled = every.join(gaps, "gap", "left").fillna(0)
    rising = Window.partitionBy(F.lit(0)).orderBy("gap").rowsBetween(Window.unboundedPreceding, -1)
    falling = Window.partitionBy(F.lit(0)).orderBy(F.desc("gap")).rowsBetween(Window.unboundedPreceding, 0)
    thresholds = F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("gap"))
    swept = filled.withColumns({
        "n_fp": F.sum("neg").over(falling), "n_fn": F.sum("pos").over(rising), "cost_fn": F.sum("amt").over(rising),
    }).filter(F.col("gap") > 0)
    return swept.select(
        F.explode(F.array(*[F.lit(float(c)) for c in fp_costs])).alias("fp_cost"),
        thresholds.alias("threshold"), "n_fp", "n_fn", "cost_fn",
    ).withColumn("total_cost", F.col("n_fp") * F.col("fp_cost") + F.col("cost_fn"))


def cost_at(df: DataFrame, label: str, score: str, amount: str, threshold: float, fp_cost: float = S.COST_PER_FALSE_POSITIVE) -> DataFrame:
    flagged = F.col(score) >= F.lit(float(threshold))
    false_alarm = F.sum((flagged & (F.col(label) == 0)).cast("bigint")) * F.lit(float(fp_cost))
    missed = F.sum(F.when(~flagged & (F.col(label) == 1), F.col(amount)).otherwise(0.0))
    return df.agg((false_alarm + missed).alias("cost"))


def cost_optimum(
    df: DataFrame,
    label: str,
    score: str,
    amount: str,
    f1_threshold: float = S.OPERATING_THRESHOLD,
    fp_costs: Sequence[float] = (S.COST_PER_FALSE_POSITIVE,),
) -> DataFrame:
    """Per false-positive price: first cheapest threshold, its cost, cost at the F1 threshold, saving.

    The F1 threshold joins the grid as one more border, so this is still a single scan.
    """
    grid = threshold_grid()
    both = cost_sweep(df, label, score, amount, fp_costs, sorted({*grid, float(f1_threshold)}))
    on_grid = F.col("threshold").isin(grid)
    out = both.groupBy("fp_cost").agg(
        F.min_by(F.when(on_grid, F.col("threshold")), F.when(on_grid, F.struct("total_cost", "threshold"))).alias("threshold_min_cost"),
        F.min(F.when(on_grid, F.col("total_cost"))).alias("cost_at_min"),
        F.max(F.when(F.col("threshold") == F.lit(float(f1_threshold)), F.col("total_cost"))).alias("cost_at_f1"),
    )
    return out.withColumn("saved_vs_f1", F.col("cost_at_f1") - F.col("cost_at_min"))


def value_extrapolation(
    saved: DataFrame, sizes: DataFrame, val_rows: str = "n_val", test_rows: str = "n_test", months: str = "test_months"
) -> DataFrame:
    """Monthly saving: validation saving scaled to the test rows over the months they really span."""
    s = saved.agg(F.max("saved_vs_f1").alias("s")).scalar()
    return sizes.withColumn("saved_vs_f1", s).select(
        "saved_vs_f1", val_rows, test_rows, months,
        (F.col(test_rows) / F.col(months)).alias("monthly_volume"),
        (F.col("saved_vs_f1") * (F.col(test_rows) / F.col(val_rows)) / F.col(months)).alias("monthly_savings"),
    )
