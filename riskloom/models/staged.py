"""Length of a boosted model, by average precision of every shorter model on held-out rows.

A model's first k trees are the model of k rounds. One scan of the held-out rows adds up the
trees and gives, for many lengths at once, the distinct scores of each batch with their rows
and positives. One aggregate then yields the average precision of all these lengths. Lengths
come in blocks, so what moves is bounded by a block and the scan ends soon after the best round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.models.explain import Forest, load_forest
from riskloom.models.train import model_input
from riskloom.operators.metrics import curve_summary
from riskloom.operators.ordered import ROWS_PER_KEY, many_valued_keys, prior_totals
from riskloom.session import Scratch

PATIENCE = 30
#: Lengths measured by one scan; each gives at most one record per distinct score.
LENGTHS_AT_ONCE = 64


def stage_points(rows: DataFrame, forest: Forest, lengths: range, label: str, features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """``trees, threshold, n, pos``: per model length the scores of each batch, equal ones combined.

    Rows without a label are left out.
    """
    columns = list(features)
    shared = rows.sparkSession.sparkContext.broadcast(vars(forest))
    ready = model_input(rows, columns).filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), *columns)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        left, right, feature, threshold, value = (trees[n] for n in ("left", "right", "feature", "threshold", "value"))
        for batch in batches:
            x, y = batch[columns].to_numpy(dtype=float), batch["_y"].to_numpy()
            margin, found = np.zeros(len(x)), []
            for length, root in enumerate(trees["roots"][: lengths.stop - 1], start=1):
                at = np.full(len(x), root)
                moving = np.flatnonzero(left[at] >= 0)
                while len(moving):
                    node = at[moving]
                    at[moving] = np.where(x[moving, feature[node]] <= threshold[node], left[node], right[node])
                    moving = moving[left[at[moving]] >= 0]
                margin += value[at]
                if length in lengths:
                    scores, which = np.unique(1 / (1 + np.exp(-margin)), return_inverse=True)
                    found.append(pd.DataFrame({
                        "trees": length, "threshold": scores, "n": np.bincount(which, minlength=len(scores)),
                        "pos": np.bincount(which, y, len(scores)).astype(np.int64),
                    }))
            if found:
                yield pd.concat(found)

    return ready.mapInPandas(score, "trees int, threshold double, n long, pos long")


def staged_precision(
    rows: DataFrame, forest: Forest, lengths: range, label: str = S.TARGET, features: Sequence[str] = S.FEATURE_COLUMNS, limit: int = ROWS_PER_KEY,
) -> dict[int, float | None]:
    """Average precision for each length; None where the rows hold no positive, nothing without rows."""
    with Scratch(rows.sparkSession) as scratch:
        points = scratch.table(
            stage_points(rows, forest, lengths, label, features).groupBy("trees", "threshold").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")), "stages")
        curve = prior_totals(
            points, ["trees"], [F.col("threshold").desc()], {"cum_n": F.col("n"), "cum_pos": F.col("pos")}, inclusive=True,
            hot_keys=many_valued_keys(points, ["trees"], "threshold", limit),
        )
        # One row per length of the block.
        return {r.trees: r.pr_auc for r in curve_summary(curve, ["trees"]).collect()}


def best_length(precisions: Iterable[float | None], patience: int = PATIENCE) -> tuple[int | None, bool]:
    """First length with the largest value before ``patience`` lengths without gain, and whether they have passed.

    Without any value there is no best length.
    """
    best, at, length = None, None, 0
    for length, found in enumerate(precisions, start=1):
        if found is not None and (best is None or found > best):
            best, at = found, length
        if at is not None and length - at >= patience:
            return at, True
    return at, False


def shorten(model: PipelineModel, length: int) -> PipelineModel:
    """The model of the first ``length`` trees, with the same settings."""
    trees = model.stages[-1]
    if length >= len(trees.treeWeights):
        return model
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, length)
    weights = gateway.new_array(jvm.double, length)
    for i, tree in enumerate(list(trees._java_obj.trees())[:length]):
        kept[i], weights[i] = tree, float(trees.treeWeights[i])
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(trees.uid, kept, weights, trees.numFeatures, trees.numClasses))
    return PipelineModel(stages=[*model.stages[:-1], trees._copyValues(cut)])


def stop_early(model: PipelineModel, held_out: DataFrame, patience: int = PATIENCE, label: str = S.TARGET, features: Sequence[str] = S.FEATURE_COLUMNS) -> PipelineModel:
    """The model cut at its best length on the held-out rows; whole where they cannot tell."""
    forest, found = load_forest(model), []
    total = len(forest.roots)
    best = None
    for start in range(1, total + 1, LENGTHS_AT_ONCE):
        block = range(start, min(start + LENGTHS_AT_ONCE, total + 1))
        measured = staged_precision(held_out, forest, block, label, features)
        found += [measured.get(length) for length in block]
        best, done = best_length(found, patience)
        if done or best is None:
            break
    return shorten(model, best or total)
