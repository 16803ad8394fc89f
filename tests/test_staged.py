"""Early stopping: chosen lengths against a plain loop over shortened models."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.models import staged, train
from riskloom.models.explain import load_forest
from riskloom.operators.metrics import ranking_summary

FEATURES = ("a", "b", "c")


def plain_best(values, patience):
    best, at = -1.0, None
    for length, v in enumerate(values, start=1):
        if v is not None and v > best:
            best, at = v, length
        if at is not None and length - at >= patience:
            break
    return at


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    n = 3_000
    x = rng.normal(size=(n, 3)).round(2)
    y = rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 0] * x[:, 1] - 1.5)))
    rows = pd.DataFrame(x, columns=list(FEATURES)).assign(tx_id=np.arange(n), is_fraud=y.astype(int), split=np.where(np.arange(n) < 1200, "train", "val"))
    rows.loc[rows.tx_id % 11 == 0, "c"] = np.nan
    return spark.createDataFrame(rows).cache()


@pytest.fixture(scope="module")
def whole(noisy):
    return train.fit_trees(noisy, train.TreeParams(max_depth=5, learning_rate=0.4, max_trees=14, patience=0), FEATURES)


@pytest.fixture(scope="module")
def precisions(noisy, whole):
    """Average precision of each length, one shortened model after the other."""
    val = noisy.filter("split = 'val'")
    return [ranking_summary(train.raw_scores(val, staged.shorten(whole, k), FEATURES), "is_fraud", "score_raw").first().pr_auc for k in range(1, 15)]


@pytest.mark.parametrize("limit", [1_000_000, 200])
def test_all_lengths_in_one_scan(noisy, whole, precisions, limit):
    val, forest = noisy.filter("split = 'val'"), load_forest(whole)
    found = staged.staged_precision(val, forest, range(1, 15), features=FEATURES, limit=limit)
    assert sorted(found) == list(range(1, 15))
    assert [found[k] for k in range(1, 15)] == pytest.approx(precisions, abs=1e-9)
    later = staged.staged_precision(val, forest, range(6, 9), features=FEATURES)
    assert later == pytest.approx({k: precisions[k - 1] for k in (6, 7, 8)}, abs=1e-9)


@pytest.mark.parametrize("patience, at_once", [(1, 64), (2, 3), (30, 5)])
def test_chosen_length(noisy, whole, precisions, patience, at_once, monkeypatch):
    monkeypatch.setattr(staged, "LENGTHS_AT_ONCE", at_once)
    cut = staged.stop_early(whole, noisy.filter("split = 'val'"), patience, features=FEATURES)
    assert len(cut.stages[-1].treeWeights) == plain_best(precisions, patience)


def test_training_cuts_its_model(noisy, precisions):
    model = train.fit_trees(noisy, train.TreeParams(max_depth=5, learning_rate=0.4, max_trees=14), FEATURES)
    assert len(model.stages[-1].treeWeights) == plain_best(precisions, 30)


def test_short_model_saves_scores_and_ranks_features(noisy, whole, tmp_path):
    from pyspark.ml import PipelineModel

    short = staged.shorten(whole, 3)
    assert staged.shorten(whole, 99) is whole
    short.write().save(str(tmp_path / "short"))
    again = PipelineModel.load(str(tmp_path / "short"))
    val = noisy.filter("split = 'val'")
    a, b = (train.raw_scores(val, m, FEATURES).select("tx_id", "score_raw").toPandas().sort_values("tx_id") for m in (short, again))
    assert (a.score_raw.values == b.score_raw.values).all() and len(again.stages[-1].treeWeights) == 3
    gains = train.feature_importance(short, FEATURES).toPandas()
    assert sorted(gains.feature) == sorted(FEATURES) and gains.gain.sum() == pytest.approx(1)


def test_rows_that_cannot_tell_keep_the_whole_model(noisy, whole):
    val = noisy.filter("split = 'val'")
    for rows in (val.filter("false"), val.withColumn("is_fraud", F.lit(0)), val.withColumn("is_fraud", F.lit(None).cast("int"))):
        assert staged.stop_early(whole, rows, 2, features=FEATURES) is whole


def test_best_length():
    assert staged.best_length([0.1, 0.3, 0.3, 0.2, 0.9], 2) == (2, True)
    assert staged.best_length([0.1, 0.3, 0.3, 0.2, 0.9], 3) == (5, False)
    assert staged.best_length([None, None], 1) == (None, False) and staged.best_length([], 1) == (None, False)


def test_training_rows_are_dealt_by_their_number(noisy):
    one = noisy.coalesce(1)
    assert train.spread_rows(one, 3_000, 3_000).rdd.getNumPartitions() == 1
    dealt = train.spread_rows(one, 3_000, 100)
    sizes = dealt.rdd.glom().map(len).collect()
    # A scan that gave one partition was trained on by one task.
    assert sum(sizes) == 3_000 and max(sizes) <= 110 and len(sizes) >= 30
    assert sorted(r.tx_id for r in dealt.select("tx_id").collect()) == list(range(3_000))


def test_dealt_rows_train_a_model_of_all_rows(noisy, whole, monkeypatch):
    monkeypatch.setattr(train.spread_rows, "__defaults__", (100,))
    again = train.fit_trees(noisy.coalesce(1), train.TreeParams(max_depth=5, learning_rate=0.4, max_trees=14, patience=0), FEATURES)
    trees = [m.stages[-1].trees for m in (whole, again)]
    counts = [[t.numNodes for t in found] for found in trees]
    assert len(counts[0]) == len(counts[1]) == 14
    held = noisy.filter("split = 'val'")
    a, b = (ranking_summary(train.raw_scores(held, m, FEATURES), "is_fraud", "score_raw").first() for m in (whole, again))
    assert a.n == b.n and a.pr_auc == pytest.approx(b.pr_auc, abs=0.05)


def test_scores_are_made_once_for_metrics_and_calibration(spark):
    from riskloom.models.calibrate import compare_calibrators
    from riskloom.operators.metrics import metrics_bundle

    made = spark.sparkContext.accumulator(0)

    def slow(i):
        made.add(1)
        return (i * 37 % 101) / 101

    score = F.udf(slow, "double").asNondeterministic()
    rows = spark.range(400).select(F.col("id").alias("tx_id"), (F.col("id") % 3 == 0).cast("int").alias("is_fraud")).withColumn("score_raw", score("tx_id"))
    assert {r.metric for r in metrics_bundle(rows, "is_fraud", "score_raw", "tx_id").collect()} == {"pr_auc", "roc_auc", "recall_at_1pct", "f1_at_thr", "threshold"}
    assert made.value == 400
    chosen, table = compare_calibrators(rows, rows, "is_fraud", "score_raw")
    assert made.value == 1_200 and table.count() == 6
