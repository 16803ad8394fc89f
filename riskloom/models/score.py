"""Batch scoring: features to raw score, calibrated score and two decisions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.models.calibrate import Calibrator, load_calibrator, save_calibrator
from riskloom.models.explain import explain_rows, explained_score, top_contributions
from riskloom.models.train import raw_scores
from riskloom.operators.metrics import ranking_summary
from riskloom.sources.gate import gate_rows


@dataclass(frozen=True)
class Bundle:
    """What scoring needs, under one version name."""

    model: PipelineModel
    calibrator: Calibrator
    version: str
    features: tuple[str, ...] = S.FEATURE_COLUMNS
    operating_threshold: float = S.OPERATING_THRESHOLD
    cost_threshold: float = S.COST_THRESHOLD

    @property
    def tree_count(self) -> int:
        return len(self.model.stages[-1].treeWeights)


def save_bundle(bundle: Bundle, path: str) -> None:
    bundle.model.write().overwrite().save(f"{path}/model")
    save_calibrator(bundle.calibrator, f"{path}/calibrator")
    SparkSession.active().createDataFrame(
        [(bundle.version, list(bundle.features), bundle.operating_threshold, bundle.cost_threshold, bundle.tree_count)],
        "version string, features array<string>, operating double, cost double, trees int",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load_bundle(path: str) -> Bundle:
    """Load a saved bundle; a model that lost trees on the way is an error."""
    about = SparkSession.active().read.parquet(f"{path}/about").first()
    bundle = Bundle(
        PipelineModel.load(f"{path}/model"), load_calibrator(f"{path}/calibrator"), about.version,
        tuple(about.features), about.operating, about.cost,
    )
    if bundle.tree_count != about.trees:
        raise ValueError(f"model has {bundle.tree_count} trees, {about.trees} were saved")
    return bundle


def score_batch(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Original columns plus ``score_raw, score_calibrated, decision_operating, decision_cost``.

    Every row is scored; nulls in optional features are missing values to the model.
    Decisions compare the raw score, on which the thresholds were chosen.
    """
    missing = sorted(set(bundle.features) - set(df.columns))
    if missing:
        raise ValueError(f"missing features: {missing}")
    scored = raw_scores(df, bundle.model, bundle.features)
    calibrated = bundle.calibrator.apply(scored, "score_raw", "score_calibrated")
    return calibrated.withColumns({
        "decision_operating": X.decision(F.col("score_raw"), bundle.operating_threshold).getField("is_fraud"),
        "decision_cost": X.decision(F.col("score_raw"), bundle.cost_threshold).getField("is_fraud"),
    })


def score_explained(df: DataFrame, bundle: Bundle, key: str = "tx_id", k: int = 5) -> DataFrame:
    """One response per row: scores, both decisions with their thresholds, top contributions, base value.

    One pass over the rows: the explanation gives the score too, and no key is joined.
    """
    explained = explain_rows(df, bundle.model, key, bundle.features).withColumn("score_raw", explained_score())
    scored = bundle.calibrator.apply(top_contributions(explained, bundle.features, k), "score_raw", "score_calibrated")
    return scored.select(
        key, "score_raw", "score_calibrated",
        X.decision(F.col("score_raw"), bundle.operating_threshold).alias("decision_operating"),
        X.decision(F.col("score_raw"), bundle.cost_threshold).alias("decision_cost"), "base_value", "top",
    )


def gate_and_score(df: DataFrame, bundle: Bundle, required: Sequence[str] = S.REQUIRED_FEATURES) -> tuple[DataFrame, DataFrame]:
    """``(scored rows, quarantined rows with a reason)``."""
    nullable = [c for c in bundle.features if c not in required]
    gated = gate_rows(df, [c for c in required if c in bundle.features], nullable)
    reason = F.col("reject_reason")
    return score_batch(gated.filter(reason.isNull()).drop("reject_reason"), bundle), gated.filter(reason.isNotNull())


def sanity_check(scored: DataFrame, target: str = S.TARGET, expected: float | None = None, tolerance: float = 0.01) -> DataFrame:
    """Ranking quality over answered rows, when labels are there, and whether it is the expected one."""
    found = ranking_summary(scored, target, "score_raw")
    if expected is None:
        return found
    return found.withColumn("as_expected", F.coalesce(F.abs(F.col("pr_auc") - F.lit(expected)) <= F.lit(tolerance), F.lit(False)))


def replay(log: DataFrame, bundle: Bundle, key: str = "tx_id") -> DataFrame:
    """Re-score logged inputs with the current model and count decision changes.

    The log holds the features, ``model_version`` and ``decision_operating`` as decided then.
    """
    then = log.withColumnRenamed("decision_operating", "_then").drop("score_raw", "score_calibrated", "decision_cost")
    now = score_batch(then, bundle)
    changed = (F.col("_then") != F.col("decision_operating")).cast("bigint")
    return now.groupBy("model_version", F.col("_then").alias("decided"), F.col("decision_operating").alias("now")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(changed).alias("n_changed")
    )
