"""Curated table to a saved, calibrated model with its run log."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.models import train
from riskloom.models.calibrate import compare_calibrators
from riskloom.models.score import Bundle, save_bundle
from riskloom.sources.sinks import write_report_csv
from riskloom.sources.tables import load_splits


def train_model(
    curated: DataFrame,
    out: str,
    version: str,
    trials: int = 50,
    fixed: train.TreeParams = train.TreeParams(),
    gate: bool = True,
) -> Bundle:
    """Baseline and gate, search, final fit, calibration; writes model, importance and run log under ``out``."""
    spark = curated.sparkSession
    load_splits(curated)
    baseline = train.train_baseline(curated, fixed, gate=gate)
    params = train.tune_params(curated, trials, fixed=fixed)[0] if trials else fixed
    final = train.train_final(curated, params)
    val, test = (train.raw_scores(curated.filter(F.col("split") == s), final.model) for s in ("val", "test"))
    calibrator, table = compare_calibrators(val, test, S.TARGET, "score_raw")
    bundle = Bundle(final.model, calibrator, version, operating_threshold=final.val_metrics["threshold"])
    save_bundle(bundle, f"{out}/bundle")
    write_report_csv(train.feature_importance(final.model), f"{out}/feature_importance")
    brier = {f"brier_{r.kind}_{r.split}": r.brier for r in table.collect()}
    train.append_run_log(spark, f"{out}/runs", [
        *train.metric_rows("baseline", "metric_val", baseline.val_metrics),
        *train.metric_rows("best", "param", asdict(params)),
        *train.metric_rows("best", "metric_val", final.val_metrics),
        *train.metric_rows("best", "metric_test", final.test_metrics),
        *train.metric_rows("evaluation", "metric", brier),
    ])
    return bundle
