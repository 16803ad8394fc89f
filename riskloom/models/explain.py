"""Additive per-row explanations of a boosted-tree score.

Each tree moves a row from its root mean to a leaf value; every step is credited to the
feature that was split on.  Contributions plus the base value equal the score's logit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.models.train import model_input
from riskloom.session import work_dir

# The classifier's probability is the logistic of twice the summed tree output.
_MARGIN_FACTOR = 2.0


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees as arrays.  Size is set by the training limits, not by the data."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray


def load_forest(model: PipelineModel) -> Forest:
    """Read the node table that MLlib writes for a saved tree model (continuous features)."""
    spark = SparkSession.active()
    trees = model.stages[-1]
    path = work_dir(spark, "trees")
    trees.write().save(path)
    # Bounded by trees x 2^(depth + 1) nodes.
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
    ).orderBy("treeID", "id").toPandas()
    offset = nodes.groupby("treeID").id.transform("size").groupby(nodes.treeID).first().cumsum().shift(fill_value=0)
    start = nodes.treeID.map(offset).to_numpy()
    weight = np.asarray(trees.treeWeights)[nodes.treeID.to_numpy()] * _MARGIN_FACTOR

    def child(column: str) -> np.ndarray:
        own = nodes[column].to_numpy()
        return np.where(own >= 0, own + start, -1)

    return Forest(
        roots=offset.to_numpy(), left=child("leftChild"), right=child("rightChild"), feature=nodes.feature.to_numpy(),
        threshold=nodes.threshold.fillna(0.0).to_numpy(), value=nodes.prediction.to_numpy() * weight,
    )


def explain_rows(df: DataFrame, model: PipelineModel, key: str = "tx_id", features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """``key, base_value, contributions, values`` with one entry per feature, in feature order.

    ``values`` are the features as they came, so nothing has to be joined back.
    """
    forest = load_forest(model)
    # Plain arrays and a local function: tasks need numpy and pandas only.
    shared = df.sparkSession.sparkContext.broadcast(vars(forest))
    columns = list(features)
    given = df.withColumn("_values", F.array(*[F.col(c).cast("double") for c in columns]))
    rows = model_input(given, features).select(key, "_values", *columns)
    key_type = df.schema[key].dataType.simpleString()

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        left, right, feature, threshold, value = (trees[n] for n in ("left", "right", "feature", "threshold", "value"))
        base = float(value[trees["roots"]].sum())
        for batch in batches:
            x = batch[columns].to_numpy(dtype=float)
            found = np.zeros(x.shape)
            for root in trees["roots"]:
                at = np.full(len(x), root)
                moving = np.flatnonzero(left[at] >= 0)
                while len(moving):
                    node = at[moving]
                    split_on = feature[node]
                    child = np.where(x[moving, split_on] <= threshold[node], left[node], right[node])
                    found[moving, split_on] += value[child] - value[node]
                    at[moving] = child
                    moving = moving[left[child] >= 0]
            yield pd.DataFrame({key: batch[key], "base_value": base, "contributions": list(found), "values": batch["_values"]})

    return rows.mapInPandas(attribute, f"{key} {key_type}, base_value double, contributions array<double>, values array<double>")


def explained_score() -> Column:
    """The raw score of an explained row: contributions add up to its logit."""
    return 1 / (1 + F.exp(-F.aggregate("contributions", F.col("base_value"), lambda a, v: a + v)))


def top_contributions(explained: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS, k: int = 5) -> DataFrame:
    """All columns of the explained rows and ``top``: the k largest absolute contributions with value and direction."""
    names = F.array(*[F.lit(c) for c in features])

    def entry(parts: Column) -> Column:
        return F.struct(
            (-F.abs(parts["contributions"])).alias("order"), parts["names"].alias("feature"), parts["values"].alias("value"),
            parts["contributions"].alias("contribution"), X.contribution_direction(parts["contributions"]).alias("direction"),
        )

    zipped = explained.withColumn("names", names)
    ordered = F.array_sort(F.transform(F.arrays_zip("names", "values", "contributions"), entry))
    top = F.transform(F.slice(ordered, 1, k), lambda e: e.dropFields("order"))
    return zipped.withColumn("top", top).drop("names")


def long_contributions(explained: DataFrame, key: str = "tx_id", features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    pairs = F.arrays_zip(F.array(*[F.lit(c) for c in features]).alias("feature"), F.col("contributions"))
    return explained.select(key, F.explode(pairs).alias("_c")).select(
        key, F.col("_c.feature").alias("feature"), F.col("_c.contributions").alias("contribution")
    )


def mean_abs_contribution(explained: DataFrame, key: str = "tx_id", features: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """Average absolute contribution per feature."""
    return long_contributions(explained, key, features).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
