"""Model quality per business segment, all segments in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators.metrics import curve_summary, recall_at_fraction_by, score_curve
from riskloom.operators.ordered import ROWS_PER_KEY, null_safe
from riskloom.operators.profile import top_by_volume
from riskloom.operators.selection import exact_quantiles
from riskloom.session import materialize

KEYS = ["segment_type", "segment"]


def segment_rows(df: DataFrame, category: str, night: str, amount: str, age: str, keep: Sequence[str], **tuning: int) -> DataFrame:
    """One row per (row, segment it belongs to): top-5 category, day/night, amount quartile, age group."""
    top = [r[0] for r in top_by_volume(df, category, 5).collect()]
    quartiles = exact_quantiles(df, amount, [0.25, 0.50, 0.75], **tuning)[()]
    names = {
        "category": F.when(F.col(category).isin(top), F.col(category)),
        "time_of_day": F.when(F.col(night) == 1, "night").otherwise("day"),
        "amount_quartile": F.concat(F.lit("Q"), (X.digitize(F.col(amount), quartiles) + 1).cast("string")),
        "age_group": X.age_group(F.col(age)),
    }
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("segment_type"), s.alias("segment")) for t, s in names.items()]))
    return df.select(*keep, pairs.alias("_s")).select(*keep, "_s.*").filter(F.col("segment").isNotNull())


def segment_metrics(rows: DataFrame, label: str, score: str, tie: str, limit: int = ROWS_PER_KEY) -> DataFrame:
    """``segment_type, segment, n, n_pos, pr_auc, recall_at_1pct``; small segments get null metrics."""
    # Read three times below: written once instead of sorting the scores three times.
    curve = materialize(score_curve(rows, label, score, KEYS, limit), "segment_curve")
    summary = curve_summary(curve, KEYS)
    recall = recall_at_fraction_by(rows, curve, label, score, tie, KEYS, S.TOP_FRACTION, limit)
    enough = (F.col("n") >= S.SEGMENT_MIN_ROWS) & (F.col("n_pos") >= S.SEGMENT_MIN_POSITIVES)
    return null_safe(summary, recall, KEYS).select(
        *KEYS, "n", "n_pos", F.when(enough, F.col("pr_auc")).alias("pr_auc"),
        F.when(enough, F.col("recall_at_fraction")).alias("recall_at_1pct"),
    )


def weak_segments(metrics: DataFrame, margin: float = S.WEAK_SEGMENT_MARGIN) -> DataFrame:
    """Segments more than ``margin`` below the median average precision of the few segments."""
    median = metrics.agg(F.percentile("pr_auc", F.lit(0.5)).alias("m")).scalar()
    return metrics.withColumn("_median", median).filter(F.col("pr_auc") < F.col("_median") - F.lit(margin)).drop("_median")
