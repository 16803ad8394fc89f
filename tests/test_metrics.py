"""Metrics against brute force, with ties, on the plain and the sliced plan."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import cost, metrics, monitor, segments


def scored(n=400, seed=2, ties=True):
    rng = np.random.default_rng(seed)
    score = rng.random(n)
    if ties:
        score = np.round(score, 1)
        score[: n // 3] = 0.5
    label = (rng.random(n) < 0.1 + 0.5 * score).astype(int)
    return pd.DataFrame({"tx_id": rng.permutation(n), "label": label, "score": score, "amt": np.round(rng.random(n) * 90, 2)})


def brute_curve(pdf):
    out = []
    for t in sorted(pdf.score.unique(), reverse=True):
        top = pdf[pdf.score >= t]
        out.append((t, len(top), int(top.label.sum())))
    return out


def brute_ap(pdf):
    pos, last, total = pdf.label.sum(), 0, 0.0
    for _, n, tp in brute_curve(pdf):
        total += (tp - last) / pos * tp / n
        last = tp
    return total


def brute_roc(pdf):
    p, n = pdf[pdf.label == 1].score.to_numpy(), pdf[pdf.label == 0].score.to_numpy()
    return ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))


@pytest.mark.parametrize("limit", [10**6, 3])
@pytest.mark.parametrize("ties", [True, False])
def test_areas(spark, limit, ties):
    pdf = scored(ties=ties)
    row = metrics.ranking_summary(spark.createDataFrame(pdf), "label", "score", limit=limit).first()
    assert row.pr_auc == pytest.approx(brute_ap(pdf)) and row.roc_auc == pytest.approx(brute_roc(pdf))
    assert (row.n, row.n_pos) == (len(pdf), pdf.label.sum())


def test_average_precision_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, score double")
    assert metrics.ranking_summary(df, "label", "score").first().pr_auc == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_one_class_only_gives_null_areas(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.8)], "label int, score double")
    row = metrics.ranking_summary(df, "label", "score").first()
    assert row.pr_auc is None and row.roc_auc is None
    best = metrics.best_f1_threshold(df.limit(0), "label", "score").first()
    assert (best.threshold, best.f1) == (0.5, 0.0)


def test_best_f1_takes_lowest_threshold_on_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6)], "label int, score double")
    best = metrics.best_f1_threshold(df, "label", "score").first()
    # At 0.9 and at 0.6 F1 is 2/3.
    assert (best.threshold, best.f1) == (0.6, pytest.approx(2 / 3))


def test_top_fractions_break_ties_by_id(spark):
    pdf = scored()
    got = {r.fraction: r for r in metrics.top_fractions(spark.createDataFrame(pdf), "label", "score", "tx_id", [0.001, 0.01, 0.3, 1.0]).collect()}
    s = pdf.sort_values(["score", "tx_id"], ascending=[False, True])
    for f, row in got.items():
        k = max(1, math.ceil(len(pdf) * f))
        hits = s.label.head(k).sum()
        assert (row.k, row.hits) == (k, hits)
        assert row.lift == pytest.approx(hits / k / pdf.label.mean())


@pytest.mark.parametrize("limit", [10**6, 2])
def test_segment_metrics(spark, limit):
    pdf = scored(900)
    pdf["segment_type"], pdf["segment"] = "g", np.where(pdf.tx_id % 3 == 0, "a", "b")
    pdf.loc[pdf.tx_id < 20, "segment"] = "small"
    got = {r.segment: r for r in segments.segment_metrics(spark.createDataFrame(pdf), "label", "score", "tx_id", limit).collect()}
    for name, part in pdf.groupby("segment"):
        row = got[name]
        assert (row.n, row.n_pos) == (len(part), part.label.sum())
        if name == "small":
            assert row.pr_auc is None and row.recall_at_1pct is None
            continue
        assert row.pr_auc == pytest.approx(brute_ap(part))
        s = part.sort_values(["score", "tx_id"], ascending=[False, True])
        k = max(1, math.ceil(len(part) * 0.01))
        assert row.recall_at_1pct == pytest.approx(s.label.head(k).sum() / part.label.sum())


def test_grid_is_the_published_one():
    assert np.array_equal(np.array(cost.threshold_grid()), np.arange(0.05, 0.96, 0.01))


def test_cost_sweep_against_every_threshold(spark):
    pdf = scored()
    # Scores on grid values: an equal score is flagged.
    pdf.loc[pdf.index % 5 == 0, "score"] = np.arange(0.05, 0.96, 0.01)[pdf.index[pdf.index % 5 == 0] % 91]
    got = cost.cost_sweep(spark.createDataFrame(pdf), "label", "score", "amt").orderBy("threshold").collect()
    assert len(got) == 91
    for row, t in zip(got, np.arange(0.05, 0.96, 0.01)):
        flagged = pdf.score >= t
        fp, missed = (flagged & (pdf.label == 0)).sum(), pdf[~flagged & (pdf.label == 1)]
        assert (row.n_fp, row.n_fn) == (fp, len(missed))
        assert row.total_cost == pytest.approx(5 * fp + missed.amt.sum())
    best = cost.cost_optimum(spark.createDataFrame(pdf), "label", "score", "amt").first()
    first = min(got, key=lambda r: (round(r.total_cost, 6), r.threshold))
    assert best.threshold_min_cost == pytest.approx(first.threshold)
    assert best.cost_at_f1 == pytest.approx(cost.cost_at(spark.createDataFrame(pdf), "label", "score", "amt", 0.6642).first().cost)


@pytest.mark.parametrize("limit", [10**6, 5])
def test_ks_and_psi(spark, limit):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"v": np.round(np.concatenate([rng.normal(0, 1, 500), rng.normal(0.8, 1, 300)]), 2), "old": [True] * 500 + [False] * 300})
    df = spark.createDataFrame(pdf)
    a, b = pdf[pdf.old].v.to_numpy(), pdf[~pdf.old].v.to_numpy()
    want = max(abs((a <= x).mean() - (b <= x).mean()) for x in np.unique(pdf.v))
    assert monitor.ks_drift(df, "v", F.col("old"), limit).first().ks == pytest.approx(want)
    row = monitor.psi_drift(df, "v", F.col("old"), F.lit("w1")).first()
    edges = np.quantile(a, np.arange(1, 10) / 10)
    p = np.maximum(np.bincount(np.searchsorted(edges, b), minlength=10) / len(b), 1e-6)
    q = np.maximum(np.bincount(np.searchsorted(edges, a), minlength=10) / len(a), 1e-6)
    assert row.psi == pytest.approx(((p - q) * np.log(p / q)).sum()) and row.alert


def test_calibration_curve_bins(spark):
    pdf = scored(ties=False)
    got = metrics.calibration_curve(spark.createDataFrame(pdf), "label", "score").orderBy("bin").collect()
    edges = np.quantile(pdf.score, np.arange(1, 10) / 10)
    where = np.searchsorted(edges, pdf.score)
    for row in got:
        part = pdf[where == row.bin]
        assert row.n == len(part) and row.prob_true == pytest.approx(part.label.mean())
