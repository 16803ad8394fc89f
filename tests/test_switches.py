"""Both sides of every size switch give the same rows, on several slices and odd values."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import decide, monitor, ordered, rolling, selection

WINDOWS = {"1h": 3600, "24h": 86400, "7d": 604800}


def one_card(amounts, seed=3):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.integers(0, 10 * 86400, len(amounts)))
    return pd.DataFrame({"tx": range(len(amounts)), "card": 1, "t": t, "amt": amounts})


@pytest.mark.parametrize("kind", ["tiny", "huge", "nan", "infinite", "null"])
def test_rolling_plans_agree_on_odd_amounts(spark, kind):
    rng = np.random.default_rng(1)
    steps = rng.integers(0, 50, 400).astype(float)
    amounts = {"tiny": steps * 1e-7, "huge": steps * 1e13}.get(kind, steps.copy())
    if kind in ("nan", "infinite", "null"):
        amounts[[17, 200]] = {"nan": math.nan, "infinite": math.inf, "null": 0}[kind]
    df = spark.createDataFrame(one_card(amounts))
    if kind == "null":
        df = df.withColumn("amt", F.when(~F.col("tx").isin(17, 200), F.col("amt")))
    plain, cells = (
        rolling.rolling_past(df, "card", "t", "amt", WINDOWS, limit=limit).orderBy("tx").collect() for limit in (10**6, 1)
    )
    scale = {"tiny": 1e-7, "huge": 1e13}.get(kind, 1.0)
    for a, b in zip(plain, cells, strict=True):
        for c in a.asDict():
            x, y = a[c], b[c]
            assert (x is None) == (y is None), (c, x, y)
            if x is not None:
                assert x == y or (math.isnan(x) and math.isnan(y)) or abs(x - y) <= 1e-6 * scale + 1e-9 * abs(x), (c, x, y)


def test_recent_values_keep_the_place_of_nulls(spark):
    rng = np.random.default_rng(2)
    df = spark.range(400).selectExpr("id AS tx", "1 AS card", "id AS t", "IF(id % 3 = 0 OR id BETWEEN 150 AND 290, NULL, id) AS v")
    order = [F.col("t"), F.col("tx")]
    plain, sliced = (
        {r.tx: r.recent for r in ordered.recent_values(df, ["card"], order, "v", limit=limit).collect()} for limit in (10**6, 1)
    )
    assert plain == sliced and plain[399] == [395, 397, 398] and sliced[291] == [] and rng is not None


@pytest.mark.parametrize("rows", [600, 5])
def test_slices_are_several(spark, rows):
    df = spark.range(rows).selectExpr("1 AS card", "id AS t")
    sliced = ordered.slice_rows(df, ["card"], [F.col("t")], limit=1)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) >= 3 and max(sizes) <= max(2 * ordered.MIN_SLICE_ROWS, rows // 2 + 1)


@pytest.mark.parametrize("odd", [[math.nan] * 30, [math.inf, -math.inf], [1.7e308, -1.7e308, math.inf], []])
def test_ranks_with_nan_and_infinity(spark, odd):
    rng = np.random.default_rng(5)
    values = [*rng.lognormal(0, 3, 2000).round(3).tolist(), *odd]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    known = sorted(v for v in values if not math.isnan(v))
    wanted = [1, 2, 700, len(known) - 1, len(known)]
    found = selection.select_ranks(df, "v", lambda _, n: wanted, finish_rows=10)[()]
    for k in wanted:
        assert found[k].value == known[k - 1] and found[k].below == sum(v < known[k - 1] for v in known)


def test_many_groups(spark):
    df = spark.range(3000).selectExpr("IF(id % 300 = 7, NULL, id % 300) AS g", "CAST(id * 7919 % 1000 AS DOUBLE) AS v")
    found = selection.exact_quantiles(df, "v", [0.0, 0.5, 1.0], by=["g"])
    pdf = df.toPandas()
    assert len(found) == 300
    for g, v in pdf.groupby("g", dropna=False):
        key = None if pd.isna(g) else int(g)
        np.testing.assert_allclose(found[(key,)], np.quantile(v.v, [0.0, 0.5, 1.0]))


@pytest.mark.parametrize("words", [["ab", "abé", "abü", "b", "éa", "éb"] * 9, [f"{i:05x}" for i in range(500)]])
def test_text_ranks(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "v string")
    found = selection.select_ranks(df, "v", lambda _, n: range(1, n + 1, 7), finish_rows=3)[()]
    assert {k: r.value for k, r in found.items()} == {k: sorted(words)[k - 1] for k in range(1, len(words) + 1, 7)}


def test_confirmed_labels_keep_equal_rows(spark):
    day = datetime(2024, 1, 1)
    tx = spark.createDataFrame([(1, day, 5.0), (1, day, 5.0), (2, day, None), (3, None, 1.0)], "tx_id long, ts timestamp, amt double")
    tx = tx.withColumn("tags", F.create_map(F.lit("a"), F.lit("b")))
    labels = spark.createDataFrame(
        [(1, day + timedelta(35), 1), (1, day + timedelta(50), 0), (2, day + timedelta(3), 1)], "tx_id long, arrived timestamp, confirmed int"
    )
    rows = decide.confirmed_labels(tx, labels, "tx_id", "ts").orderBy("tx_id").collect()
    assert [(r.tx_id, r.confirmed, r.status) for r in rows] == [(1, 1, "confirmed")] * 2 + [(2, None, "provisional"), (3, None, "provisional")]


def test_drift_leaves_out_rows_without_period(spark):
    rows = [("base", float(i % 10)) for i in range(500)] + [("now", float(i % 10) + 2) for i in range(300)]
    df = spark.createDataFrame(rows, "p string, v double")
    with_null = df.union(spark.createDataFrame([(None, 99.0)] * 100, "p string, v double"))
    base = F.col("p") == "base"
    a, b = (monitor.psi_drift(d, "v", base, F.col("p")).collect() for d in (df, with_null))
    assert a == b and len(a) == 1


def test_service_levels_of_a_null_shift(spark):
    at = datetime(2024, 1, 1)
    rows = [(float(i), at + timedelta(seconds=i), "day" if i % 2 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "ms double, ts timestamp, s string")
    found = {r.shift: r.p99 for r in monitor.service_levels(df, "ms", "ts", F.col("s")).collect()}
    assert found["day"] == pytest.approx(98.02) and found[None] == pytest.approx(97.02)


@pytest.mark.parametrize("limit", [1_000_000, 300])
def test_quantiles_of_many_groups_stay_in_spark(spark, limit, monkeypatch):
    """One group holds a third of the rows; keys and values may be null, NaN or infinite."""
    rng = np.random.default_rng(8)
    n = 6_000
    group = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 900, n))
    value = rng.normal(size=n).round(2)
    value[rng.random(n) < 0.05] = np.nan
    value[group == 7] = np.nan
    value[(group == 9)] = np.inf
    rows = [(None if g == 5 else int(g), "a" if g % 2 else None, None if i % 50 == 0 else float(v)) for i, (g, v) in enumerate(zip(group, value))]
    df = spark.createDataFrame(rows, "g long, h string, v double")
    wanted = {"first": 0.0, "q1": 0.25, "half": 0.5, "tail": 0.99, "last": 1.0}
    monkeypatch.setattr(selection, "ROWS_PER_KEY", limit)

    held = {}
    for g, h, v in rows:
        own = held.setdefault((g, h), [])
        if v is not None and not np.isnan(v):
            own.append(v)

    def plain(own, p):
        own, at = sorted(own), p * (len(own) - 1)
        low, high = own[int(at)], own[min(int(at) + 1, len(own) - 1)]
        return low + (high - low) * (at - int(at))

    def close(a, b):
        return (a is None) == (b is None) and (a is None or a == b or np.isnan(a) and np.isnan(b) or abs(a - b) < 1e-9)

    found = selection.quantile_table(df, "v", wanted, ["g", "h"]).collect()
    assert len(found) == len(held) > selection.MAX_GROUPS
    for r in found:
        own = held[r.g, r.h]
        for name, p in wanted.items():
            assert close(r[name], plain(own, p) if own else None), (r, name)
    few = df.filter("g < 60")
    one, other = (sorted(map(str, selection.quantile_table(few, "v", wanted, ["g", "h"], max_groups=m).collect())) for m in (256, 2))
    assert one == other


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "g long, v double")
    assert selection.quantile_table(df, "v", {"half": 0.5}, ["g"]).collect() == []
    assert selection.quantile_table(df, "v", {"half": 0.5}, ["g"], max_groups=-1).collect() == []
