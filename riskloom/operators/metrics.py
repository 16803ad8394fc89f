"""Ranking, threshold and calibration metrics over ``(label, score)`` rows.

Rows are first combined to one record per distinct score, so tied scores of any size
cost one record per task, and running totals over scores use the sliced plan when the
distinct scores are too many for one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators.ordered import ROWS_PER_KEY, global_rank, many_valued_keys, null_safe, prior_totals
from riskloom.operators.selection import cut_points, exact_quantiles
from riskloom.session import materialize


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (), limit: int = ROWS_PER_KEY) -> DataFrame:
    """Cumulative rows and positives by descending distinct score: ``threshold, n, pos, cum_n, cum_pos``."""
    scored = df.filter(F.col(score).isNotNull())
    points = scored.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("pos")
    )
    return prior_totals(
        points, by, [F.col("threshold").desc()], {"cum_n": F.col("n"), "cum_pos": F.col("pos")}, inclusive=True,
        hot_keys=many_valued_keys(scored, by, score, limit),
    )


def _with_totals(curve: DataFrame, df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Add rows and positives per group, counted on the rows themselves: no shuffle by score.

    Groups are segments or versions, so few.
    """
    totals = F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("pos")).alias("_t")
    scored = df.filter(F.col(score).isNotNull())
    if by:
        with_t = null_safe(curve, scored.groupBy(*by).agg(totals), list(by), "inner")
    else:
        with_t = curve.withColumn("_t", scored.agg(totals).scalar())
    return with_t.withColumns({"_n": F.col("_t.n"), "_pos": F.col("_t.pos")}).drop("_t")


def ranking_summary(df: DataFrame, label: str, score: str, by: Sequence[str] = (), limit: int = ROWS_PER_KEY) -> DataFrame:
    """``n, n_pos, pr_auc, roc_auc`` per group; areas are null where a class is missing."""
    return curve_summary(score_curve(df, label, score, by, limit), by)


def curve_summary(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from a score curve.

    Average precision in step form over distinct scores; ROC area by trapezoids, so tied
    scores count half.
    """
    pos, neg = F.sum("pos"), F.sum(F.col("n") - F.col("pos"))
    step = F.sum(F.col("pos") * (F.col("cum_pos") / F.col("cum_n")))
    trapezoid = F.sum((F.col("n") - F.col("pos")) * (F.col("cum_pos") - F.col("pos") / F.lit(2.0)))
    aggregates = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(pos, F.lit(0)).alias("n_pos"),
        F.when(pos > 0, step / pos).alias("pr_auc"),
        F.when((pos > 0) & (neg > 0), trapezoid / (pos.cast("double") * neg.cast("double"))).alias("roc_auc"),
    ]
    return curve.groupBy(*by).agg(*aggregates) if by else curve.agg(*aggregates)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (), limit: int = ROWS_PER_KEY) -> DataFrame:
    curve = _with_totals(score_curve(df, label, score, by, limit), df, label, score, by)
    return curve.select(
        *by, "threshold", (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        F.when(F.col("_pos") > 0, F.col("cum_pos") / F.col("_pos")).alias("recall"),
    )


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (), limit: int = ROWS_PER_KEY) -> DataFrame:
    curve = _with_totals(score_curve(df, label, score, by, limit), df, label, score, by)
    negatives = F.col("_n") - F.col("_pos")
    return curve.select(
        *by, "threshold",
        F.when(negatives > 0, (F.col("cum_n") - F.col("cum_pos")) / negatives).alias("fpr"),
        F.when(F.col("_pos") > 0, F.col("cum_pos") / F.col("_pos")).alias("tpr"),
    )


def best_f1_threshold(df: DataFrame, label: str, score: str, limit: int = ROWS_PER_KEY, curve: DataFrame | None = None) -> DataFrame:
    """One row ``(threshold, f1)``: highest F1, lowest threshold on ties, (0.5, 0) without rows.

    ``curve`` is the rows' score curve, if it is there already.
    """
    curve = _with_totals(score_curve(df, label, score, (), limit) if curve is None else curve, df, label, score, ())
    f1 = F.lit(2.0) * F.col("cum_pos") / (F.col("cum_n") + F.col("_pos"))
    best = curve.withColumn("f1", f1).agg(
        F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), -F.col("threshold"))).alias("b")
    )
    return best.select(
        F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"), F.coalesce("b.f1", F.lit(0.0)).alias("f1")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion_at(df: DataFrame, label: str, score: str, threshold: float | Column, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp with precision, recall and F1 (zero when undefined), in one aggregate."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    # The threshold may be a scalar subquery, which is planned as a column, not inside an aggregate.
    predicted = df.withColumn("_cut", cut)
    flagged, positive = F.col(score) >= F.col("_cut"), F.col(label) == 1

    def count(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0)).alias(name)

    cells = [count(~flagged & ~positive, "tn"), count(flagged & ~positive, "fp"), count(~flagged & positive, "fn"), count(flagged & positive, "tp")]
    out = predicted.groupBy(*by).agg(*cells) if by else predicted.agg(*cells)
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return out.withColumns({
        "precision": precision, "recall": recall,
        "f1": _ratio(F.lit(2.0) * F.col("tp"), F.lit(2.0) * F.col("tp") + F.col("fp") + F.col("fn")),
    })


def brier(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    gap = F.col(score) - F.col(label)
    mean = F.avg(gap * gap).alias("brier")
    return df.groupBy(*by).agg(mean) if by else df.agg(mean)


def top_fractions(df: DataFrame, label: str, score: str, tie: str, fractions: Sequence[float], **tuning: int) -> DataFrame:
    """``fraction, k, hits, n_pos, recall, lift`` of the highest-scored k = max(1, ceil(n * fraction)) rows.

    The k-th row is found by histograms over the score (ties by id), then one aggregate
    counts the hits of all fractions: the rows are never sorted.
    """
    spark = df.sparkSession
    scored = df.filter(F.col(score).isNotNull())
    cuts = cut_points(scored, score, tie, lambda n: [max(1, math.ceil(n * f)) for f in fractions] if n else [], True, **tuning)
    if not cuts:
        return spark.createDataFrame([], "fraction double, k bigint, hits bigint, n_pos bigint, recall double, lift double")
    hits = scored.agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("n_pos"),
        *[
            F.sum(F.when(c.includes(F.col(score), F.col(tie)), F.col(label)).otherwise(0)).cast("bigint").alias(f"h{i}")
            for i, c in enumerate(cuts)
        ],
    )
    rows = F.inline(F.array(*[
        F.struct(F.lit(float(f)).alias("fraction"), F.lit(c.rank).cast("bigint").alias("k"), F.col(f"h{i}").alias("hits"))
        for i, (f, c) in enumerate(zip(fractions, cuts))
    ]))
    return hits.select("n", "n_pos", rows).select(
        "fraction", "k", "hits", "n_pos", _ratio(F.col("hits"), F.col("n_pos")).alias("recall"),
        F.when(F.col("n_pos") > 0, (F.col("hits") / F.col("k")) / (F.col("n_pos") / F.col("n"))).alias("lift"),
    )


def recall_at_fraction_by(
    df: DataFrame, curve: DataFrame, label: str, score: str, tie: str, by: Sequence[str], fraction: float = S.TOP_FRACTION, limit: int = ROWS_PER_KEY
) -> DataFrame:
    """Recall in the top fraction per group, from the group's score curve.

    Only rows whose score equals their group's cut score are ranked by id.
    """
    by = list(by)
    k = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(float(fraction))))
    cut = _with_totals(curve, df, label, score, by).withColumn("_k", k).filter(
        (F.col("cum_n") >= F.col("_k")) & (F.col("cum_n") - F.col("n") < F.col("_k"))
    ).select(
        *by, "_pos", F.col("threshold").alias("_cut"), (F.col("cum_pos") - F.col("pos")).alias("_above"),
        (F.col("_k") - F.col("cum_n") + F.col("n")).alias("_need"),
    )
    # One row per segment: broadcast, so that the rows need no exchange to meet it.
    tied = null_safe(df.select(*by, label, score, tie), F.broadcast(cut), by, "inner").filter(F.col(score) == F.col("_cut"))
    ranked = global_rank(tied, by, [F.col(tie)], "_rank", limit)
    at_cut = ranked.filter(F.col("_rank") <= F.col("_need")).groupBy(*by).agg(F.sum(label).cast("bigint").alias("_at_cut"))
    joined = null_safe(cut, at_cut, by)
    hits = F.col("_above") + F.coalesce("_at_cut", F.lit(0))
    return joined.select(*by, _ratio(hits, F.col("_pos")).alias("recall_at_fraction"))


def metrics_bundle(df: DataFrame, label: str, score: str, tie: str, threshold: float | Column | None = None) -> DataFrame:
    """Long ``(metric, value)`` table: pr_auc, roc_auc, recall_at_1pct, f1_at_thr, threshold."""
    # The scans below find the scores written; a lazy score would be made again in each of them.
    df = materialize(df.select(*dict.fromkeys([label, score, tie])), "scored")
    # One record per distinct score, written once and read by both.
    curve = materialize(score_curve(df, label, score, (), ROWS_PER_KEY), "curve")
    summary = curve_summary(curve)
    recall = top_fractions(df, label, score, tie, [S.TOP_FRACTION])
    if threshold is None:
        best = best_f1_threshold(df, label, score, curve=curve)
    else:
        cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
        best = confusion_at(df, label, score, threshold).select("f1").withColumn("threshold", cut)
    pairs = [
        (summary, {"pr_auc": "pr_auc", "roc_auc": "roc_auc"}),
        (recall, {"recall_at_1pct": "recall"}),
        (best, {"f1_at_thr": "f1", "threshold": "threshold"}),
    ]
    out = None
    for frame, names in pairs:
        long = frame.select(F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in names.items()
        ])))
        out = long if out is None else out.unionByName(long)
    return out


def gate_vs_base_rate(df: DataFrame, label: str, score: str, factor: float = S.MIN_LIFT_OVER_BASE_RATE, expected: float | None = None, tolerance: float = 0.01) -> DataFrame:
    """Does average precision exceed ``factor`` times the base rate (and match the expected value)?"""
    out = ranking_summary(df, label, score).withColumn("base_rate", F.col("n_pos") / F.col("n"))
    passed = F.coalesce(F.col("pr_auc") > F.lit(factor) * F.col("base_rate"), F.lit(False))
    if expected is not None:
        passed = passed & (F.abs(F.col("pr_auc") - F.lit(expected)) <= F.lit(tolerance))
    return out.select("pr_auc", "base_rate", passed.alias("passed"))


def require_gate(gate: DataFrame) -> None:
    row = gate.first()
    if not row.passed:
        raise RuntimeError(f"quality gate failed: average precision {row.pr_auc}, base rate {row.base_rate}")


def calibration_curve(df: DataFrame, label: str, score: str, bins: int = 10, **tuning: int) -> DataFrame:
    """Mean score and observed rate per non-empty quantile bin (right-closed)."""
    edges = exact_quantiles(df, score, [i / bins for i in range(1, bins)], **tuning)[()]
    return (
        df.withColumn("bin", X.bins_right_closed(F.col(score), edges))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("prob_pred"), F.avg(label).alias("prob_true"))
    )
