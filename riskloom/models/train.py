"""Boosted-tree training on MLlib, with the checks around it."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.operators.metrics import best_f1_threshold, gate_vs_base_rate, metrics_bundle, ranking_summary, require_gate

MISSING = -1.0
#: Training rows that one task holds; MLlib keeps each partition's rows for all trees, some 700 bytes a row.
ROWS_PER_TASK = 200_000
VECTOR = "features_vector"


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters that MLlib trees have."""

    max_depth: int = 6
    learning_rate: float = 0.1
    min_rows_per_node: int = 1
    row_share: float = 1.0
    feature_share: float = 1.0
    #: Least loss reduction of a split, summed over the rows it parts.
    min_gain: float = 0.0
    max_trees: int = 500
    #: Rounds without a better average precision on val before boosting stops; 0 keeps all.
    patience: int = 30
    seed: int = 42


def positive_weight(train: DataFrame, label: str) -> DataFrame:
    """One row ``pos_weight``: negatives per positive in the training rows."""
    pos = F.sum(F.col(label).cast("bigint"))
    return train.agg(F.when(pos > 0, (F.count(F.lit(1)) - pos) / pos).otherwise(F.lit(1.0)).alias("pos_weight"))


def model_input(df: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """Features as doubles in fixed order, missing as a sentinel.

    Every nullable feature is non-negative, so one split below zero separates missing
    values: the trees learn their own branch for them.
    """
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(MISSING)) for c in features})


def assembler(features: Sequence[str] = S.FEATURE_COLUMNS) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR)


def spread_rows(rows: DataFrame, n: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows``, of which there are ``n``, dealt evenly over tasks of at most about ``per_task``; few rows stay as they came.

    A file scan gives few, large partitions: boosting would read each of them whole, once for every level of every tree.
    """
    if n <= per_task:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * -(-n // (per_task * cores)))


def gain_per_row(min_gain: float, n: int, pos_weight: float) -> float:
    """The ``minInfoGain`` of MLlib for a loss reduction summed over ``n`` rows, their positives weighted by ``pos_weight``.

    MLlib takes one gain per unit of weight for all nodes. For even scores the log loss falls by half of what a split takes off
    the squares of labels -1 and 1, so the first split asks for ``min_gain``; deeper ones and later trees for less, never more.
    """
    total = 2 * n * pos_weight / (1 + pos_weight)  # of the weights: as much on positives as on negatives
    return 2 * min_gain / total if total else 0.0


def fit_trees(
    table: DataFrame,
    params: TreeParams,
    features: Sequence[str] = S.FEATURE_COLUMNS,
    target: str = S.TARGET,
) -> PipelineModel:
    """Fit on the train rows of a split table; average precision on its val rows gives the length.

    MLlib boosts without a look at val, so ``max_trees`` are fitted and then cut.
    """
    from riskloom.models.staged import stop_early

    fitted = table.filter(F.col("split") == "train")
    weight = positive_weight(fitted, target).first().pos_weight
    n = fitted.count()
    rows = model_input(spread_rows(fitted.select(*features, target), n), features).select(
        *features, F.col(target).cast("double").alias("_label"),
        F.when(F.col(target) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)).alias("_weight"),
    )
    gather = assembler(features)
    trees = GBTClassifier(
        featuresCol=VECTOR, labelCol="_label", weightCol="_weight",
        maxIter=params.max_trees, maxDepth=params.max_depth, stepSize=params.learning_rate,
        minInstancesPerNode=params.min_rows_per_node, subsamplingRate=params.row_share,
        featureSubsetStrategy="all" if params.feature_share >= 1.0 else str(params.feature_share),
        minInfoGain=gain_per_row(params.min_gain, n, weight), seed=params.seed,
        maxMemoryInMB=512, cacheNodeIds=True, checkpointInterval=10,
    ).fit(gather.transform(rows))
    model = PipelineModel(stages=[gather, trees])
    held_out = table.filter(F.col("split") == "val")
    return stop_early(model, held_out, params.patience, target, features) if params.patience else model


def raw_scores(df: DataFrame, model: PipelineModel, features: Sequence[str] = S.FEATURE_COLUMNS, name: str = "score_raw") -> DataFrame:
    """Add the positive-class probability; original columns stay as they were."""
    kept = df.columns
    renamed = df.withColumns({f"_in_{c}": F.col(c) for c in features})
    scored = model.transform(model_input(renamed, features)).withColumn(name, vector_to_array("probability")[1])
    restored = [F.col(f"_in_{c}").alias(c) if c in features else F.col(c) for c in kept]
    return scored.select(*restored, name)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    val_metrics: dict[str, float]
    test_metrics: dict[str, float]


def _as_dict(bundle: DataFrame) -> dict[str, float]:
    return {r.metric: r.value for r in bundle.collect()}


def train_baseline(table: DataFrame, params: TreeParams = TreeParams(), features: Sequence[str] = S.FEATURE_COLUMNS, key: str = "tx_id", gate: bool = True) -> Trained:
    """Default-parameter model, rejected unless it clearly beats the base rate on val."""
    model = fit_trees(table, params, features)
    val = raw_scores(table.filter(F.col("split") == "val"), model, features)
    if gate:
        require_gate(gate_vs_base_rate(val, S.TARGET, "score_raw"))
    return Trained(model, _as_dict(metrics_bundle(val, S.TARGET, "score_raw", key)), {})


def train_final(table: DataFrame, params: TreeParams, features: Sequence[str] = S.FEATURE_COLUMNS, key: str = "tx_id") -> Trained:
    """Fit, choose the F1 threshold on val and keep it fixed for test."""
    model = fit_trees(table, params, features)
    scored = raw_scores(table.filter(F.col("split").isin("val", "test")), model, features)
    val, test = (scored.filter(F.col("split") == s) for s in ("val", "test"))
    chosen = best_f1_threshold(val, S.TARGET, "score_raw").first().threshold
    val_metrics = _as_dict(metrics_bundle(val, S.TARGET, "score_raw", key))
    return Trained(model, val_metrics, _as_dict(metrics_bundle(test, S.TARGET, "score_raw", key, chosen)))


def _draw(rng: random.Random, fixed: TreeParams) -> TreeParams:
    def log_uniform(low: float, high: float) -> float:
        return math.exp(rng.uniform(math.log(low), math.log(high)))

    return TreeParams(
        max_depth=rng.randint(4, 10), learning_rate=log_uniform(0.01, 0.3),
        min_rows_per_node=round(log_uniform(1.0, 100.0)), row_share=rng.uniform(0.6, 1.0),
        feature_share=rng.uniform(0.6, 1.0), min_gain=rng.uniform(0.0, 5.0),
        max_trees=fixed.max_trees, patience=fixed.patience, seed=fixed.seed,
    )


def tune_params(
    table: DataFrame,
    trials: int = 50,
    seed: int = 42,
    fixed: TreeParams = TreeParams(),
    features: Sequence[str] = S.FEATURE_COLUMNS,
    parallelism: int = 2,
    draws: Sequence[TreeParams] | None = None,
) -> tuple[TreeParams, DataFrame]:
    """Seeded random search on the fixed time split, maximising average precision on val.

    Returns the best parameters and a table of all trials.
    """
    rng = random.Random(seed)
    candidates = list(draws or [_draw(rng, fixed) for _ in range(trials)])
    val = table.filter(F.col("split") == "val")

    def run(params: TreeParams) -> float:
        scored = raw_scores(val, fit_trees(table, params, features), features)
        return ranking_summary(scored, S.TARGET, "score_raw").first().pr_auc or 0.0

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(run, candidates))
    best = max(range(len(candidates)), key=lambda i: found[i])
    rows = [{"trial": i, **asdict(p), "pr_auc": float(v)} for i, (p, v) in enumerate(zip(candidates, found))]
    return candidates[best], table.sparkSession.createDataFrame(rows)


def feature_importance(model: PipelineModel, features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """``feature, gain`` for every feature, unused ones as zero, largest first."""
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(g)) for f, g in zip(features, importances)]
    return SparkSession.active().createDataFrame(rows, "feature string, gain double").orderBy(F.desc("gain"), "feature")


def metric_rows(run: str, kind: str, values: Mapping[str, float]) -> list[tuple[str, str, str, float]]:
    return [(run, kind, name, float(v)) for name, v in values.items() if v is not None]


def append_run_log(spark, path: str, rows: Sequence[tuple[str, str, str, float]]) -> None:
    """Append ``(run, kind, name, value, logged_at)`` rows; earlier runs are never rewritten."""
    spark.createDataFrame(list(rows), "run string, kind string, name string, value double").withColumn(
        "logged_at", F.current_timestamp()
    ).write.mode("append").parquet(path)
