"""The sliced plans give the same rows as plain windows and as brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordered, rolling, selection


def skewed(n=600, seed=3, null_key=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = 1 if rng.random() < 0.4 else rng.randrange(2, 9)
        if null_key and card == 1:
            card = None
        # Coarse instants give many ties.
        rows.append((i, card, rng.randrange(0, 40_000) * 7, round(rng.random() * 300, 2)))
    return pd.DataFrame(rows, columns=["tx", "card", "t", "amt"]).astype({"card": "Int64"})


def brute_rolling(pdf, windows):
    out = []
    for row in pdf.itertuples():
        same = pdf[(pdf.card == row.card) & (pdf.t < row.t)]
        rec = {"tx": row.tx}
        for label, w in windows.items():
            past = same[same.t >= row.t - w].amt
            rec[f"rolling_count_{label}"] = len(past)
            rec[f"rolling_amt_sum_{label}"] = past.sum()
            rec[f"rolling_amt_mean_{label}"] = past.mean() if len(past) else None
            rec[f"rolling_amt_std_{label}"] = past.std() if len(past) > 1 else None
        out.append(rec)
    return pd.DataFrame(out).sort_values("tx").reset_index(drop=True)


@pytest.mark.parametrize("limit", [10**6, 100, 1])
def test_rolling_plans_agree_with_brute_force(spark, limit):
    pdf = skewed()
    pdf.loc[pdf.index % 11 == 0, "t"] = pdf.loc[pdf.index % 11 == 0, "t"] // 3600 * 3600
    windows = {"1h": 3600, "24h": 86400, "7d": 604800}
    got = rolling.rolling_past(spark.createDataFrame(pdf), "card", "t", "amt", windows, limit=limit)
    want = brute_rolling(pdf, windows)
    got = got.toPandas().sort_values("tx").reset_index(drop=True)
    assert len(got) == len(pdf)
    for c in want.columns:
        a, b = got[c].astype(float).to_numpy(), want[c].astype(float).to_numpy()
        assert (np.isnan(a) == np.isnan(b)).all(), c
        np.testing.assert_allclose(a, b, atol=1e-5, err_msg=c)


def test_rolling_keeps_null_cards_on_both_plans(spark):
    df = spark.createDataFrame(skewed(null_key=True))
    windows = {"1h": 3600}
    plain = rolling.rolling_past(df, "card", "t", "amt", windows).toPandas().sort_values("tx")
    cells = rolling.rolling_past(df, "card", "t", "amt", windows, limit=1).toPandas().sort_values("tx")
    assert len(cells) == len(plain) == 600
    np.testing.assert_allclose(plain.rolling_amt_sum_1h, cells.rolling_amt_sum_1h, atol=1e-6)


def test_closed_form_single_card(spark):
    rows = [(i, 1, i * 600, float(i + 1)) for i in range(50)]
    df = spark.createDataFrame(rows, "tx long, card long, t long, amt double")
    for limit in (10**6, 1):
        got = rolling.rolling_past(df, "card", "t", "amt", {"1h": 3600}, limit=limit).orderBy("tx").collect()
        for i, r in enumerate(got):
            assert r.rolling_count_1h == min(i, 6)
            assert r.rolling_amt_sum_1h == pytest.approx(sum(range(max(1, i - 5), i + 1)))
        assert got[0].rolling_amt_mean_1h is None and got[1].rolling_amt_std_1h is None


@pytest.mark.parametrize("limit", [10**6, 50, 1])
@pytest.mark.parametrize("null_key", [False, True])
def test_window_operators_sliced_equal_plain(spark, limit, null_key):
    pdf = skewed(null_key=null_key)
    df = spark.createDataFrame(pdf)
    order = [F.col("t"), F.col("tx")]
    key = pdf.card.fillna(-1)
    s = pdf.assign(key=key).sort_values(["key", "t", "tx"])
    g = s.groupby("key")
    s["rank"] = g.cumcount() + 1
    s["total"] = g.amt.cumsum() - s.amt
    s["prev"] = g.amt.shift(1)
    want = s.sort_values("tx")

    ranked = ordered.global_rank(df, ["card"], order, limit=limit).toPandas().sort_values("tx")
    assert ranked["rank"].tolist() == want["rank"].tolist()
    totals = ordered.prior_totals(df, ["card"], order, {"total": F.col("amt")}, limit=limit).toPandas().sort_values("tx")
    np.testing.assert_allclose(totals.total, want.total, atol=1e-6)
    prev = ordered.previous_row(df, ["card"], order, {"amt": "prev"}, limit=limit).toPandas().sort_values("tx")
    np.testing.assert_allclose(prev.prev.astype(float), want.prev, atol=1e-9)
    recent = ordered.recent_values(df, ["card"], order, "amt", limit=limit).toPandas().sort_values("tx")
    by_key = {k: x.amt.tolist() for k, x in s.groupby("key")}
    for r, k, rank in zip(recent.recent, want.key, want["rank"]):
        assert list(r) == by_key[k][max(0, rank - 5):rank]


def test_rank_without_key(spark):
    df = spark.createDataFrame(skewed())
    for limit in (10**6, 10):
        got = ordered.global_rank(df, [], [F.col("amt").desc(), F.col("tx")], limit=limit).toPandas()
        want = got.sort_values(["amt", "tx"], ascending=[False, True])
        assert want["rank"].tolist() == list(range(1, 601))


@pytest.mark.parametrize("finish", [20_000, 5])
def test_quantiles_match_numpy(spark, finish):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 900), "v": np.round(rng.lognormal(3, 2, 900), 2)})
    pdf.loc[:300, "v"] = 5.0
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = selection.exact_quantiles(df, "v", probs, by=["g"], bins=7, finish_rows=finish)
    for g in (0, 1):
        np.testing.assert_allclose(got[(g,)], np.quantile(pdf[pdf.g == g].v, probs))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("finish", [20_000, 3])
def test_cut_points_take_exactly_k_rows(spark, descending, finish):
    pdf = skewed()
    pdf["v"] = pdf.t // 30_000
    df = spark.createDataFrame(pdf)
    ks = [1, 17, 300, 599, 600]
    cuts = selection.cut_points(df, "v", "tx", lambda n: ks, descending, bins=4, finish_rows=finish)
    s = pdf.sort_values(["v", "tx"], ascending=[not descending, True])
    for k, cut in zip(ks, cuts):
        got = {r.tx for r in df.filter(cut.includes(F.col("v"), F.col("tx"))).select("tx").collect()}
        assert got == set(s.tx.head(k))


@pytest.mark.parametrize("descending", [False, True])
def test_cut_points_with_text_ids(spark, descending):
    pdf = skewed(300)
    pdf["tx"] = [f"tx-{(i * 7919) % 300:04x}" for i in pdf.tx]
    pdf["v"] = 1.5
    df = spark.createDataFrame(pdf)
    for finish in (20_000, 3):
        cuts = selection.cut_points(df, "v", "tx", lambda n: [1, 120, 299], descending, finish_rows=finish)
        for k, cut in zip([1, 120, 299], cuts):
            got = {r.tx for r in df.filter(cut.includes(F.col("v"), F.col("tx"))).select("tx").collect()}
            assert got == set(sorted(pdf.tx)[:k])


def test_time_split_with_tied_borders(spark):
    from riskloom.operators.split import temporal_split

    df = spark.createDataFrame([(f"id{i:03d}", 5) for i in range(101)], "tx_id string, t long")
    got = temporal_split(df, "t", "tx_id", finish_rows=3).toPandas().sort_values("tx_id")
    assert got.split.tolist() == ["train"] * 70 + ["val"] * 15 + ["test"] * 16
    assert temporal_split(df.limit(1), "t", "tx_id").first().split == "test"


def test_slices_follow_the_rows_and_stay_tasks_of_a_fair_size():
    assert ordered.slice_count(600, 100) == 6 and ordered.slice_count(10, 1) == ordered.MIN_SLICES
    # A low limit on many rows gave one task per hundred rows.
    assert ordered.slice_count(36_000_000, 50) == 360
    assert ordered.slice_count(1_000_000, 50) == ordered.MANY_SLICES
    # Limits above the full slice are kept as they were.
    assert ordered.slice_count(36_000_000, 1_000_000) == 36 and ordered.slice_count(500_000_000, 1_000_000) == 500


def test_previous_row_and_rank_on_slices_larger_than_the_limit(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MANY_SLICES", 4)
    monkeypatch.setattr(ordered, "MIN_SLICE_ROWS", 10)
    pdf = skewed(null_key=True)
    df, order = spark.createDataFrame(pdf), [F.col("t"), F.col("tx")]
    for by in (["card"], []):
        plain = ordered.global_rank(ordered.previous_row(df, by, order, {"amt": "before"}, 10**6), by, order, limit=10**6)
        sliced = ordered.global_rank(ordered.previous_row(df, by, order, {"amt": "before"}, 1), by, order, limit=1)
        a, b = (x.select("tx", "before", "rank").toPandas().sort_values("tx").reset_index(drop=True) for x in (plain, sliced))
        pd.testing.assert_frame_equal(a, b)
