"""The whole way from raw CSV to scored table, on generated card transactions."""


import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom import __main__ as cli
from riskloom import settings as S
from riskloom.models import calibrate, explain, score, train
from riskloom.plans import evaluate, features, ingest, scoring, training
from riskloom.plans.evaluate import attach_metadata
from riskloom.sources import sinks, tables


def raw_transactions(cards=6, per_card=250, seed=5):
    rng = np.random.default_rng(seed)
    n = cards * per_card
    category = rng.choice(["shop", "food", "fuel"], n)
    amt = np.round(rng.lognormal(3.5, 1.0, n), 2)
    rate = pd.Series(category).map({"shop": 0.25, "food": 0.05, "fuel": 0.02}).to_numpy() + (amt > 100) * 0.4
    seconds = 1_577_836_800 + np.arange(n) * 1800
    return pd.DataFrame({
        "Unnamed: 0": np.arange(n), "trans_date_trans_time": pd.to_datetime(seconds, unit="s"),
        "cc_num": rng.permutation(np.repeat(np.arange(cards) + 4_000_000_000_000_000, per_card)),
        "merchant": rng.choice(["m1", "m2", "m3", "m4"], n), "category": category, "amt": amt,
        "first": "a", "last": "b", "gender": "F", "street": "s", "city": "c", "state": rng.choice(["NY", "CA"], n), "zip": "01234",
        "lat": 40.0, "long": -74.0, "city_pop": 1000, "job": rng.choice(["x", "y"], n), "dob": "1990-01-01",
        "trans_num": [f"t{i:06d}" for i in range(n)], "unix_time": seconds,
        "merch_lat": 40 + rng.random(n), "merch_long": -74 + rng.random(n),
        "is_fraud": (rng.random(n) < rate).astype(int), "merch_zipcode": [None if i % 7 == 0 else "10001" for i in range(n)],
    })


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("flow")
    raw = raw_transactions()
    half = len(raw) // 2
    raw[:half].to_csv(base / "one.csv", index=False)
    # The second file has other column order and lacks one column.
    other = [c for c in raw.columns[::-1] if c != "merch_zipcode"]
    raw[half:].to_csv(base / "two.csv", index=False, columns=other)
    done = ingest.ingest(spark, [str(base / "one.csv"), str(base / "two.csv")], str(base / "staging"))
    staging = features.staging_to_transactions(spark.read.parquet(str(base / "staging")))
    sinks.write_curated(features.build_features(staging), str(base / "curated"))
    curated = spark.read.parquet(str(base / "curated"))
    quick = train.TreeParams(max_depth=3, max_trees=6, learning_rate=0.3)
    bundle = training.train_model(curated, str(base / "out"), "v1", trials=0, fixed=quick, gate=False)
    return {"base": base, "raw": raw, "done": done, "staging": staging, "curated": curated, "bundle": bundle}


def test_ingest_keeps_every_row_and_reports(flow, spark):
    raw, quality = flow["raw"], flow["done"].quality.first()
    assert quality.n_rows == len(raw) and quality.n_cards == 6
    assert quality.n_fraud == raw.is_fraud.sum() and quality.fraud_rate == pytest.approx(raw.is_fraud.mean())
    nulls = {r.column: r.n_null for r in flow["done"].nulls.collect()}
    half = len(raw) // 2
    assert nulls == {"merch_zipcode": int(raw[:half].merch_zipcode.isna().sum()) + len(raw) - half}


def test_staging_is_time_sorted_per_file(flow, spark):
    staged = spark.read.parquet(str(flow["base"] / "staging")).withColumns({"f": F.input_file_name(), "i": F.monotonically_increasing_id()})
    ranges = staged.groupBy("f").agg(F.min("unix_time").alias("a"), F.max("unix_time").alias("b")).orderBy("a").collect()
    assert all(x.b <= y.a for x, y in zip(ranges, ranges[1:]))


def test_curated_contract(flow):
    curated, n = flow["curated"], len(flow["raw"])
    assert set(curated.columns) == {"tx_id", *S.FEATURE_COLUMNS, S.TARGET, "split"}
    sizes = {r.split: r["count"] for r in curated.groupBy("split").count().collect()}
    assert sizes == {"train": int(n * 0.7), "val": int(n * 0.15), "test": n - int(n * 0.7) - int(n * 0.15)}
    types = dict(curated.dtypes)
    assert types["is_night"] == "tinyint" and types["hour"] == "smallint" and types["age"] == "float"
    joined = curated.join(flow["staging"].select("tx_id", "us"), "tx_id").groupBy("split").agg(F.min("us").alias("a"), F.max("us").alias("b"))
    r = {x.split: x for x in joined.collect()}
    assert r["train"].b <= r["val"].a and r["val"].b <= r["test"].a


def test_encoding_of_held_out_rows_uses_train_only(flow):
    cur = flow["curated"].join(flow["staging"].select("tx_id", "category"), "tx_id").toPandas()
    tr = cur[cur.split == "train"]
    gm = tr.is_fraud.mean()
    stats = tr.groupby("category").is_fraud.agg(["mean", "count"])
    want = (stats["count"] * stats["mean"] + 20 * gm) / (stats["count"] + 20)
    held = cur[cur.split != "train"]
    np.testing.assert_allclose(held.te_category, held.category.map(want), rtol=1e-5)
    # Training rows leave their own fold out, so one category has several values.
    assert tr.groupby("category").te_category.nunique().min() > 1


def test_amount_flag_uses_train_legit_ceiling(flow):
    cur = flow["curated"].join(flow["staging"].select("tx_id", "amt"), "tx_id").toPandas()
    p95 = cur[(cur.split == "train") & (cur.is_fraud == 0)].amt.quantile(0.95)
    assert (cur.amt_gt_p95_legit == (cur.amt > p95)).all()


def test_age_at_transaction_time(flow):
    row = flow["curated"].join(flow["staging"].select("tx_id", "us"), "tx_id").orderBy("us").first()
    assert row.age == pytest.approx((1_577_836_800 - pd.Timestamp("1990-01-01").timestamp()) / (365.25 * 86400), rel=1e-6)


def test_hot_cards_give_the_same_features(flow):
    names = ["tx_id", *S.FEATURE_COLUMNS]
    plain = features.build_features(flow["staging"]).select(names).toPandas().sort_values("tx_id")
    cells = features.build_features(flow["staging"], rows_per_card=10).select(names).toPandas().sort_values("tx_id")
    for c in S.FEATURE_COLUMNS:
        np.testing.assert_allclose(plain[c].astype(float), cells[c].astype(float), rtol=1e-4, atol=1e-3, err_msg=c)


def test_loader_contract(flow, spark):
    splits = tables.load_splits(flow["curated"])
    assert set(splits.features) == set(S.FEATURE_COLUMNS)
    ids = [set(r.tx_id for r in v.select("tx_id").collect()) for v in (splits.train, splits.val, splits.test)]
    assert not ids[0] & ids[1] and not ids[1] & ids[2] and not ids[0] & ids[2]
    with pytest.raises(ValueError, match="empty"):
        tables.load_splits(flow["curated"].filter("split <> 'val'"))
    with pytest.raises(ValueError, match="missing"):
        tables.load_splits(flow["curated"].drop("is_fraud"))


def test_model_beats_base_rate_and_survives_saving(flow):
    test = flow["curated"].filter("split = 'test'")
    again = score.load_bundle(str(flow["base"] / "out" / "bundle"))
    a = score.score_batch(test, flow["bundle"]).select("tx_id", "score_raw", "score_calibrated").toPandas().sort_values("tx_id")
    b = score.score_batch(test, again).select("tx_id", "score_raw", "score_calibrated").toPandas().sort_values("tx_id")
    np.testing.assert_allclose(a.score_raw, b.score_raw, rtol=1e-9)
    np.testing.assert_allclose(a.score_calibrated, b.score_calibrated, rtol=1e-9)
    summary = score.sanity_check(score.score_batch(test, again)).first()
    assert summary.pr_auc > 1.5 * summary.n_pos / summary.n


def test_calibration_does_not_hurt_on_val(flow):
    val, test = (train.raw_scores(flow["curated"].filter(f"split = '{s}'"), flow["bundle"].model) for s in ("val", "test"))
    _, table = calibrate.compare_calibrators(val, test, S.TARGET, "score_raw")
    found = {r.kind: r.brier for r in table.filter("split = 'val'").collect()}
    assert min(found["platt"], found["isotonic"]) <= found["raw"]


def test_contributions_add_up_to_the_logit(flow):
    test = flow["curated"].filter("split = 'test'")
    model = flow["bundle"].model
    explained = explain.explain_rows(test, model)
    both = explained.join(train.raw_scores(test, model).select("tx_id", "score_raw"), "tx_id").toPandas()
    total = both.base_value + both.contributions.map(sum)
    logit = np.log(both.score_raw / (1 - both.score_raw))
    np.testing.assert_allclose(total, logit, atol=1e-6)
    top = explain.top_contributions(explained).first().top
    sizes = [abs(e.contribution) for e in top]
    assert len(top) == 5 and sizes == sorted(sizes, reverse=True)
    assert all(e.direction == ("increases_fraud" if e.contribution >= 0 else "decreases_fraud") for e in top)


def test_explained_response_shape(flow):
    out = score.score_explained(flow["curated"].filter("split = 'test'"), flow["bundle"])
    for r in out.collect():
        assert len(r.top) == 5 and r.decision_cost.threshold == S.COST_THRESHOLD
        assert r.decision_operating.is_fraud == (r.score_raw >= r.decision_operating.threshold)


def test_missing_values_are_scored(flow):
    first = flow["curated"].filter(F.col("time_since_last_tx").isNull())
    scored = score.score_batch(first, flow["bundle"])
    assert scored.filter("score_raw is null").count() == 0
    # Inputs come back untouched, nulls included.
    assert scored.filter("time_since_last_tx is not null").count() == 0


def test_scoring_plan_and_cli(flow, capsys):
    base = flow["base"]
    out = str(base / "scored")
    n = flow["curated"].filter("split = 'test'").count()
    assert scoring.score_table(flow["curated"].sparkSession, str(base / "curated"), str(base / "out" / "bundle"), out, "test").first().n == n
    code = cli.main(["score", "--curated", str(base / "nowhere"), "--bundle", str(base / "out" / "bundle"), "--out", out])
    assert code == 2


def test_scoring_refuses_bad_rows(flow):
    base, spark = flow["base"], flow["curated"].sparkSession
    test = flow["curated"].filter("split = 'test'")
    first = test.agg(F.min("tx_id")).first()[0]
    bad = test.withColumn("log1p_amt", F.when(F.col("tx_id") == first, F.lit(float("nan"))).otherwise(F.col("log1p_amt")))
    bad.write.mode("overwrite").parquet(str(base / "bad"))
    found = scoring.score_table(spark, str(base / "bad"), str(base / "out" / "bundle"), str(base / "some"), expected_pr_auc=2.0).first()
    assert found.n == test.count() - 1 and not found.as_expected
    (refused,) = spark.read.parquet(str(base / "some_quarantine")).collect()
    assert refused.tx_id == first and "log1p_amt" in refused.reject_reason


def test_evaluation_tables(flow, tmp_path):
    found = evaluate.evaluate(flow["curated"], flow["staging"], flow["bundle"], sample_rows=60)
    bundle = {r.metric: r.value for r in found.test_metrics.collect()}
    assert set(bundle) == {"pr_auc", "roc_auc", "recall_at_1pct", "f1_at_thr", "threshold"}
    assert found.cost_curve.count() == 91
    best = found.cost_optimum.first()
    assert best.cost_at_min == pytest.approx(min(r.total_cost for r in found.cost_curve.collect()))
    assert found.segments.filter("segment_type = 'amount_quartile'").count() == 4
    assert found.importance.count() == 10 and found.convincing_cases.count() == 6
    assert found.monthly_value.first().n_test == flow["curated"].filter("split = 'test'").count()
    found.write_reports(str(tmp_path))
    found.log(str(tmp_path / "runs"))
    logged = {(r.kind, r.name): r.value for r in flow["curated"].sparkSession.read.parquet(str(tmp_path / "runs")).collect()}
    assert {n: v for (k, n), v in logged.items() if k == "metric_test"} == bundle
    assert logged["cost_val", "saved_vs_f1"] == pytest.approx(best.cost_at_f1 - best.cost_at_min) and logged["param", "explained_rows"] == 60
    kinds = {"raw", "platt", "isotonic"}
    assert {n for k, n in logged if k == "brier_test"} == kinds | {"chosen"}
    chosen = [n for n in kinds if logged["calibrator_chosen", n]]
    assert len(chosen) == 1 and logged["brier_test", "chosen"] == logged["brier_test", chosen[0]]


def test_metadata_guard(flow):
    small = flow["curated"].select("tx_id", "is_fraud")
    meta = flow["staging"].select("tx_id", "is_fraud", "amt")
    assert attach_metadata(small, meta, "tx_id", "is_fraud", ["amt"]).count() == small.count()
    with pytest.raises(ValueError, match="labels differ"):
        attach_metadata(small, meta.withColumn("is_fraud", 1 - F.col("is_fraud")), "tx_id", "is_fraud", ["amt"])
    with pytest.raises(ValueError, match="without partner"):
        attach_metadata(small, meta.filter("amt > 20"), "tx_id", "is_fraud", ["amt"])


def test_run_log_has_all_runs(flow, spark):
    log = spark.read.parquet(str(flow["base"] / "out" / "runs"))
    assert {r.run for r in log.select("run").distinct().collect()} == {"baseline", "best", "evaluation"}
    values = {(r.run, r.kind, r.name): r.value for r in log.collect()}
    assert values[("best", "metric_val", "threshold")] == values[("best", "metric_test", "threshold")]
