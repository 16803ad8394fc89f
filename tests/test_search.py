"""The search over boosting parameters: every draw leaves trees that split."""

import random

import numpy as np
import pandas as pd
import pytest

from riskloom.models import train

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def faint(spark):
    """Rows whose features say little of the label, as those of most transactions do."""
    rng = np.random.default_rng(5)
    n = 4_000
    x = rng.normal(size=(n, 3)).round(2)
    y = rng.random(n) < 0.3 + 0.04 * (x[:, 0] > 0)
    return spark.createDataFrame(pd.DataFrame(x, columns=list(FEATURES)).assign(tx_id=np.arange(n), is_fraud=y.astype(int), split=np.where(np.arange(n) < 3_000, "train", "val"))).cache()


def test_drawn_parameters_leave_trees_that_split(faint):
    rng = random.Random(42)
    for params in [train._draw(rng, train.TreeParams(max_trees=2, patience=0)) for _ in range(4)]:
        model = train.fit_trees(faint, params, FEATURES)
        # A least gain of up to 0.05 a row left one node in each.
        assert [t.numNodes > 1 for t in model.stages[-1].trees] == [True, True], params


def test_trials_differ(faint):
    best, trials = train.tune_params(faint, trials=4, fixed=train.TreeParams(max_trees=2), features=FEATURES)
    found = {r.trial: r for r in trials.collect()}
    assert sorted(found) == [0, 1, 2, 3] and len({r.pr_auc for r in found.values()}) > 1
    assert max(found.values(), key=lambda r: r.pr_auc).learning_rate == best.learning_rate


@pytest.mark.parametrize("share, splits", [(0.99, True), (1.01, False)])
def test_least_gain_is_a_sum_over_rows(spark, share, splits):
    rows = pd.DataFrame([(float(i % 2), int(i % 10 < (1 if i % 2 else 4))) for i in range(1_000)], columns=["a", "is_fraud"]).assign(split="train")
    weight = (rows.is_fraud == 0).sum() / rows.is_fraud.sum()
    rows["w"], rows["y"] = np.where(rows.is_fraud == 1, weight, 1.0), 2 * rows.is_fraud - 1

    def squares(part):
        return (part.w * (part.y - np.average(part.y, weights=part.w)) ** 2).sum()

    gain = (squares(rows) - sum(squares(part) for _, part in rows.groupby("a"))) / 2
    assert gain > 1
    params = train.TreeParams(max_depth=2, max_trees=1, patience=0, min_gain=gain * share)
    model = train.fit_trees(spark.createDataFrame(rows[["a", "is_fraud", "split"]]), params, ("a",))
    assert (model.stages[-1].trees[0].numNodes > 1) == splits


def test_least_gain_without_weights():
    assert train.gain_per_row(5.0, 0, 1.0) == train.gain_per_row(5.0, 100, 0.0) == 0.0
    assert train.gain_per_row(5.0, 100, 1.0) == pytest.approx(0.1)
