"""Contracts of readers, the feature gate and the decision rules."""

import json

import pytest
from pyspark.sql import types as T
from pyspark.sql import Row
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators import decide
from riskloom.sources import gate, tables
from riskloom.sources.decisions import DecisionLog

# --- fixed values: the stored scores of one known fraud and one known legitimate row ---
KNOWN_SCORES = {"fraud": (0.6700729727745056, True, True), "legit": (0.31541281938552856, False, False)}


def test_missing_raw_column_is_an_error(spark):
    df = spark.createDataFrame([(1, 2.0)], "cc_num long, amt double")
    with pytest.raises(ValueError, match="trans_num"):
        tables.validate_schema(df)
    with pytest.warns(UserWarning, match="amt"):
        tables.validate_schema(df, ["cc_num"])
    with pytest.raises(FileNotFoundError):
        tables.scan_csv_union(spark, [])


def body(**changes):
    row = {c: 1.0 for c in S.FEATURE_COLUMNS}
    row.update(changes)
    return row


def test_json_gate_accepts_nulls_only_where_allowed(spark):
    missing = body()
    del missing["amt_gt_p95_legit"]
    cases = {
        "ok": body(), "null_optional": body(rolling_amt_std_1h=None), "null_required": body(hour=None),
        "extra": body(surprise=1.0), "missing": missing,
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "name string, body string")
    got = {r.name: r.reject_reason for r in gate.gate_json(df, "body").collect()}
    assert got == {"ok": None, "null_optional": None, "null_required": "bad hour", "extra": "unknown surprise", "missing": "missing amt_gt_p95_legit"}
    # Both parts together are all rows.
    good, bad = gate.split_gate(gate.gate_json(df, "body"))
    assert good.count() + bad.count() == len(cases)


def test_column_gate(spark):
    df = spark.createDataFrame([Row(**body(), tx_id=1)])
    gate.gate_columns(df, other=["tx_id"])
    with pytest.raises(ValueError, match="unknown"):
        gate.gate_columns(df)
    with pytest.raises(ValueError, match="missing"):
        gate.gate_columns(df.drop("age"), other=["tx_id"])


def test_contract_sizes():
    assert len(S.FEATURE_COLUMNS) == 27 and len(S.NULLABLE_FEATURES) == 19
    assert S.TRAIN_FRACTION + S.VAL_FRACTION < 1 and len(S.RAW_COLUMNS) == 24


def test_decisions_on_known_scores(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in KNOWN_SCORES.items()], "name string, score double")
    got = df.select("name", X.decision(F.col("score"), S.OPERATING_THRESHOLD).alias("o"), X.decision(F.col("score"), S.COST_THRESHOLD).alias("c"))
    for r in got.collect():
        assert (r.o.is_fraud, r.c.is_fraud) == KNOWN_SCORES[r.name][1:]


def test_band_edges(spark):
    df = spark.createDataFrame([(0.2999,), (0.3,), (0.8499,), (0.85,), (None,)], "s double")
    got = [r.d for r in df.select(X.decision_band(F.col("s")).alias("d")).collect()]
    assert got == ["approve", "pending_review", "pending_review", "block", "pending_review"]


def test_haversine_known_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (1.0, 2.0, 1.0, 2.0), (None, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    got = [r.k for r in df.select(X.haversine_km(*[F.col(c) for c in "abcd"]).alias("k")).collect()]
    assert got[0] == pytest.approx(20015.1, abs=0.1) and got[1] == 0.0 and got[2] is None


def test_unreadable_birth_date_gives_null(spark):
    df = spark.createDataFrame([("1990-01-01",), ("not a date",)], "dob string").withColumn("ts", F.timestamp_seconds(F.lit(1_577_836_800)))
    got = [r.a for r in df.select(X.age_years(F.col("ts"), F.col("dob")).alias("a")).collect()]
    assert got[0] == pytest.approx(30.0, abs=0.01) and got[1] is None


def test_hashes_take_any_id(spark):
    df = spark.createDataFrame([(2**62,), (0,), (5,), (-7,)], "i long")
    rows = df.select(X.fold_of(F.col("i")).alias("f"), X.hash_order(F.col("i")).alias("h"), X.canary_bucket(F.col("i")).alias("c")).collect()
    assert [r.f for r in rows] == [((i * 2654435761) % 2**32) % 5 for i in (2**62, 0, 5, -7)]
    assert all(0 <= r.h < 2**31 and r.c in ("canary", "stable") for r in rows)


def test_lists_come_before_the_model(spark):
    tx = spark.createDataFrame([(1, 10, 0.9), (2, 11, 0.9), (3, 12, 0.1), (4, None, 0.5)], "tx_id long, card long, s double")
    deny = spark.createDataFrame([(12,), (10,), (12,)], "card long")
    allow = spark.createDataFrame([(11,), (10,)], "card long")
    got = {r.tx_id: (r.decision, r.rule) for r in decide.apply_lists(tx, "card", deny, allow, X.decision_band(F.col("s"))).collect()}
    assert got == {1: ("block", "denylist"), 2: ("approve", "allowlist"), 3: ("block", "denylist"), 4: ("pending_review", "model")}


def entry_rows(spark, rows):
    given = spark.createDataFrame(rows, "entry_id string, tx_id long, s long, decision string, corrects string")
    return given.select(
        "entry_id", "tx_id", F.timestamp_seconds("s").alias("recorded_at"), "decision", "corrects", F.lit("m").alias("model_version"),
        F.lit(0.5).alias("score_raw"), F.lit(0.5).alias("score_calibrated"), F.lit("{}").alias("inputs"), F.lit("[]").alias("top_features"),
        F.array(F.lit("model")).alias("rules"),
    )


def test_log_only_grows(spark, tmp_path):
    log = DecisionLog(spark, str(tmp_path / "log"))
    assert log.entries().count() == 0 and log.as_of("2100-01-01").count() == 0
    first = entry_rows(spark, [("a", 1, 0, "approve", None), ("b", 2, 0, "block", None)])
    assert log.append(first, "x") and not log.append(first, "x")
    # An attempt without manifest row, as of a writer that was lost.
    first.withColumn("dt", F.to_date("recorded_at")).write.partitionBy("dt").parquet(f"{log.path}/entries/attempt=lost")
    assert sorted(r.entry_id for r in log.entries().collect()) == ["a", "b"]
    assert log.append(entry_rows(spark, []), "empty") and log.holds("empty")


def test_corrections_stand_where_the_first_entry_stood(spark, tmp_path):
    log = DecisionLog(spark, str(tmp_path / "log"))
    log.append(entry_rows(spark, [("a", 1, 10, "approve", None), ("hand", 1, 20, "block", None), ("b", 2, 10, "approve", None)]), 0)
    log.append(entry_rows(spark, [("a2", 1, 30, "review", "a"), ("b2", 2, 30, "block", "b"), ("b3", 2, 40, "review", "b")]), 1)
    states = {t: {r.tx_id: (r.decision, r.n_entries) for r in log.as_of(f"1970-01-01 00:00:{t}").collect()} for t in ("09", "15", "30", "45")}
    assert states == {
        "09": {}, "15": {1: ("approve", 1), 2: ("approve", 1)}, "30": {1: ("block", 3), 2: ("block", 2)}, "45": {1: ("block", 3), 2: ("review", 3)},
    }


def test_entries_that_say_too_little_are_refused(spark, tmp_path):
    log = DecisionLog(spark, str(tmp_path / "log"))
    with pytest.raises(ValueError, match="inputs"):
        log.append(entry_rows(spark, []).drop("inputs"), 0)
    with pytest.raises(ValueError, match="1 decision entries"):
        log.append(entry_rows(spark, [("a", 1, 0, None, None)]), 0)
    with pytest.raises(ValueError, match="1 corrections"):
        log.append(entry_rows(spark, [("a", 1, 0, "block", None), ("c", 1, 1, "block", "nothing")]), 0)
    assert log.entries().count() == 0


def test_unreadable_values_are_kept(spark, tmp_path):
    for name, lines in {"a": "id,amt\n1,5.5\n2,abc", "b": 'amt,id\n"1,200",3\n,4', "c": "id,amt\n5,7"}.items():
        (tmp_path / f"{name}.csv").write_text(lines + "\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType())])
    read = tables.scan_csv_union(spark, [str(tmp_path / f"{n}.csv") for n in "abc"], schema, keep_unreadable=True)
    rows = {r.id: (r.amt, r[tables.UNREADABLE]) for r in read.collect()}
    assert rows == {1: (5.5, {}), 2: (None, {"amt": "abc"}), 3: (None, {"amt": "1,200"}), 4: (None, {}), 5: (7.0, {})}
    assert [(r["column"], r["n"]) for r in tables.unreadable_counts(read).collect()] == [("amt", 2)]
