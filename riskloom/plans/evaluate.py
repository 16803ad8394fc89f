"""Keyed alignment of scores with readable metadata, and the whole evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.models.calibrate import Calibrator, compare_calibrators, fit_isotonic, fit_platt
from riskloom.models.explain import explain_rows, mean_abs_contribution, top_contributions
from riskloom.models.score import Bundle
from riskloom.models.train import append_run_log, metric_rows, raw_scores
from riskloom.operators import cost, metrics, sampling, segments
from riskloom.session import materialize
from riskloom.sources.sinks import write_report_csv


def attach_metadata(scored: DataFrame, meta: DataFrame, key: str, label: str, columns: Sequence[str]) -> DataFrame:
    """Join metadata by key; fail when a row has no partner, two partners, or another label.

    The join is written once; the guard counts the written table.
    """
    side = meta.select(F.col(key).alias("_key"), F.col(label).alias("_label"), *columns)
    scored = materialize(scored, "scored")
    joined = materialize(scored.join(side, F.col(key) == F.col("_key"), "left"), "joined")
    check = joined.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_key").isNull().cast("bigint")).alias("lost"),
        F.sum((~F.col(label).eqNullSafe(F.col("_label"))).cast("bigint")).alias("differs"),
    ).first()
    if check.lost or check.differs or check.n != scored.count():
        raise ValueError(f"metadata does not match: {check.lost or 0} rows without partner, {check.differs or 0} labels differ, {check.n} joined rows")
    return joined.drop("_key", "_label")


@dataclass(frozen=True)
class Evaluation:
    """Report tables; all small, all still DataFrames."""

    test_metrics: DataFrame
    confusion: DataFrame
    lift: DataFrame
    calibration: DataFrame
    calibration_curves: DataFrame
    segments: DataFrame
    weak_segments: DataFrame
    cost_curve: DataFrame
    cost_optimum: DataFrame
    monthly_value: DataFrame
    importance: DataFrame
    convincing_cases: DataFrame
    calibrator: Calibrator
    settings: dict[str, float]

    def log(self, path: str, run: str = "evaluation") -> None:
        """Add the evaluation to a run log: settings, test metrics, Brier values, chosen calibrator, cost optimum."""
        brier = {(r.kind, r.split): r.brier for r in self.calibration.collect()}
        chosen = self.calibrator.kind
        best = self.cost_optimum.first()
        rows = [
            *metric_rows(run, "param", self.settings),
            *metric_rows(run, "metric_test", {r.metric: r.value for r in self.test_metrics.collect()}),
            *metric_rows(run, "brier_test", {k: b for (k, split), b in brier.items() if split == "test"}),
            *metric_rows(run, "brier_test", {"chosen": brier[chosen, "test"]}),
            *metric_rows(run, "calibrator_chosen", {k: k == chosen for k, split in brier if split == "test"}),
            *metric_rows(run, "cost_val", {c: best[c] for c in ("threshold_min_cost", "cost_at_min", "cost_at_f1", "saved_vs_f1")}),
        ]
        append_run_log(self.test_metrics.sparkSession, path, rows)

    def write_reports(self, path: str) -> None:
        for name in ("segments", "cost_curve", "importance"):
            write_report_csv(getattr(self, name), f"{path}/{name}")


def evaluate(
    curated: DataFrame,
    transactions: DataFrame,
    bundle: Bundle,
    ticks_per_second: int = 1,
    sample_rows: int | None = None,
    expected_pr_auc: float | None = None,
) -> Evaluation:
    """Metrics, calibration, segments, cost and explanations of a model on val and test.

    ``transactions`` gives the readable columns (tx_id, us, is_fraud, category, amt).  Scores are
    written once next to the labels; every operator after that reads this table.
    """
    held_out = curated.filter(F.col("split").isin("val", "test"))
    with_meta = attach_metadata(
        raw_scores(held_out, bundle.model, bundle.features), transactions, "tx_id", S.TARGET, ["category", "amt", "us"]
    )
    scored = with_meta  # a written table
    val, test = (scored.filter(F.col("split") == s) for s in ("val", "test"))
    label, score = S.TARGET, "score_raw"
    if expected_pr_auc is not None:
        metrics.require_gate(metrics.gate_vs_base_rate(test, label, score, factor=0.0, expected=expected_pr_auc))

    calibrator, calibration = compare_calibrators(val, test, label, score)
    curve = metrics.calibration_curve(val, label, score).withColumn("kind", F.lit("raw"))
    for other in (fit_platt(val, label, score), fit_isotonic(val, label, score)):
        fitted = other.apply(val, score, "_calibrated")
        curve = curve.unionByName(metrics.calibration_curve(fitted, label, "_calibrated").withColumn("kind", F.lit(other.kind)))

    rows = segments.segment_rows(test, "category", "is_night", "log1p_amt", "age", ["tx_id", label, score])
    by_segment = materialize(segments.segment_metrics(rows, label, score, "tx_id"), "segments")

    optimum = cost.cost_optimum(val, label, score, "amt", bundle.operating_threshold)
    month = F.lit(ticks_per_second * 86_400 * 365.25 / 12)
    in_test = F.col("split") == "test"
    sizes = scored.agg(
        F.sum((~in_test).cast("bigint")).alias("n_val"), F.sum(in_test.cast("bigint")).alias("n_test"),
        ((F.max(F.when(in_test, F.col("us"))) - F.min(F.when(in_test, F.col("us")))) / month).alias("test_months"),
    )

    # All test rows, or a sample; a sample is written out, as both reads must see the same rows.
    sample = test if sample_rows is None else materialize(sampling.sample_n(test, "tx_id", sample_rows), "sample")
    explained = explain_rows(sample, bundle.model, features=bundle.features)
    cases = sampling.top_per_group(sample, label, [F.col(score).desc(), F.col("tx_id")], 3).select("tx_id", label, score, "rank")
    return Evaluation(
        test_metrics=metrics.metrics_bundle(test, label, score, "tx_id", bundle.operating_threshold),
        confusion=metrics.confusion_at(test, label, score, bundle.operating_threshold),
        lift=metrics.top_fractions(test, label, score, "tx_id", S.LIFT_FRACTIONS),
        calibration=calibration, calibration_curves=curve, segments=by_segment, weak_segments=segments.weak_segments(by_segment),
        cost_curve=cost.cost_sweep(val, label, score, "amt"), cost_optimum=optimum, monthly_value=cost.value_extrapolation(optimum, sizes),
        importance=mean_abs_contribution(explained, features=bundle.features).orderBy(F.desc("mean_abs"), "feature").limit(10),
        convincing_cases=cases.join(top_contributions(explained, bundle.features).select("tx_id", "base_value", "top"), "tx_id"),
        calibrator=calibrator,
        settings={
            "operating_threshold": bundle.operating_threshold, "cost_per_false_positive": S.COST_PER_FALSE_POSITIVE,
            **({} if sample_rows is None else {"explained_rows": sample_rows}),
        },
    )
