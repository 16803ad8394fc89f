"""The stream gives the batch result, whatever the arrival order."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.rolling import rolling_past
from riskloom.streaming import monitor, runs
from riskloom.streaming.chain import DecisionStream
from riskloom.streaming.rolling import RollingStream
from tests.test_ordered import skewed

WINDOWS = {"1h": 3600, "24h": 86400}


def files(df, path, parts):
    for part in parts:
        df.filter(part).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("order, limit", [("in time", 10**6), ("shuffled", 10**6), ("shuffled", 20)])
def test_rolling_stream_equals_batch(spark, tmp_path, order, limit):
    # The dominant card is unknown (null) in one case.
    pdf = skewed(300, null_key=limit == 20).rename(columns={"tx": "tx_id", "t": "us"})
    df = spark.createDataFrame(pdf).select("tx_id", "card", "us", "amt")
    if order == "in time":
        parts = [F.col("us") < 90_000, F.col("us").between(90_000, 180_000), F.col("us") > 180_000]
    else:
        parts = [F.col("tx_id") % 3 == i for i in range(3)]
    files(df, str(tmp_path / "in"), parts)
    job = RollingStream(spark, str(tmp_path / "job"), WINDOWS, limit=limit)
    job.run(runs.tx_stream(spark, str(tmp_path / "in"), df.schema, 1))
    got = job.current().toPandas().sort_values("tx_id").reset_index(drop=True)
    want = rolling_past(df, "card", "us", "amt", WINDOWS).toPandas().sort_values("tx_id").reset_index(drop=True)
    assert len(got) == len(want)
    for w in WINDOWS:
        assert (got[f"rolling_count_{w}"] == want[f"rolling_count_{w}"]).all()
        for c in ("sum", "mean", "std"):
            np.testing.assert_allclose(got[f"rolling_amt_{c}_{w}"], want[f"rolling_amt_{c}_{w}"], atol=1e-5)


def test_retried_batch_is_idempotent(spark, tmp_path):
    pdf = skewed(100).rename(columns={"tx": "tx_id", "t": "us"})
    df = spark.createDataFrame(pdf).select("tx_id", "card", "us", "amt")
    job = RollingStream(spark, str(tmp_path / "job"), WINDOWS)
    first, second = df.filter("us < 120000"), df.filter("us >= 120000")
    job.step(first, 0)
    job.step(second, 1)
    before = job.current().orderBy("tx_id").collect()
    job.step(second, 1)
    assert job.current().orderBy("tx_id").collect() == before


def test_retries_count_once(spark, tmp_path):
    rows = [(i, 1_700_000_000 + i * 10) for i in range(50)] + [(7, 1_700_000_075), (8, 1_700_000_085)]
    df = spark.createDataFrame(rows, "tx_id long, s long").select("tx_id", F.timestamp_seconds("s").alias("ts"))
    files(df, str(tmp_path / "in"), [F.col("tx_id") < 8, F.col("tx_id") >= 8])
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    runs.run_to_table(monitor.drop_retries(runs.tx_stream(spark, str(tmp_path / "in"), df.schema, 1), "tx_id", "ts"), out, mark)
    assert sorted(r.tx_id for r in spark.read.parquet(out).collect()) == list(range(50))


def test_events_with_a_very_old_clock_are_set_aside(spark, tmp_path):
    pdf = skewed(120).rename(columns={"tx": "tx_id", "t": "us"})
    pdf["us"] += 10**9
    df = spark.createDataFrame(pdf).select("tx_id", "card", "us", "amt")
    old = spark.createDataFrame([(9_999, 1, 5, 1.0)], df.schema)
    for part in (df.filter("tx_id < 60"), df.filter("tx_id >= 60").union(old)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    job = RollingStream(spark, str(tmp_path / "job"), WINDOWS, max_days_late=30)
    job.run(runs.tx_stream(spark, str(tmp_path / "in"), df.schema, 1))
    got = {r.tx_id: r.rolling_count_24h for r in job.current().collect()}
    assert got == {r.tx_id: r.rolling_count_24h for r in rolling_past(df, "card", "us", "amt", WINDOWS).collect()}
    assert [r.tx_id for r in job.quarantine.read().collect()] == [9_999]


def test_long_first_batch_and_a_clock_in_the_future(spark, tmp_path):
    day = 86_400
    first = [(i, i % 2, i * day + 5, 1.0) for i in range(90)] + [(900, 1, 40_000 * day, 1.0)]
    schema = "tx_id long, card long, us long, amt double"
    job = RollingStream(spark, str(tmp_path / "job"), WINDOWS, max_days_late=30, last_day=101)
    job.step(spark.createDataFrame(first, schema), 0)
    job.step(spark.createDataFrame([(901, 1, 91 * day, 1.0), (902, 1, 10 * day, 1.0)], schema), 1)
    assert {r.tx_id for r in job.current().collect()} == {*range(90), 901}
    assert {r.tx_id for r in job.quarantine.read().collect()} == {900, 902}
    job.step(spark.createDataFrame(first, schema), 0)
    assert {r.tx_id for r in job.quarantine.read().collect()} == {900, 902}


def test_very_late_events_and_odd_clocks_without_a_limit(spark, tmp_path):
    day = 86_400
    schema = "tx_id long, card long, us long, amt double"
    rows = [(i, 1, (i * 37 % 200) * day // 4, float(i)) for i in range(120)] + [(900, 1, 40_000 * day, 1.0), (901, 1, None, 1.0), (902, None, -5, 1.0)]
    df = spark.createDataFrame(rows, schema)
    job = RollingStream(spark, str(tmp_path / "job"), WINDOWS)
    for i in range(3):
        job.step(df.filter(F.col("tx_id") % 3 == i), i)
    want = rolling_past(df.filter("us IS NOT NULL"), "card", "us", "amt", WINDOWS)
    pick = ["tx_id", "rolling_count_24h", "rolling_amt_sum_24h"]
    assert sorted(job.current().select(*pick).collect()) == sorted(want.select(*pick).collect())
    assert [r.tx_id for r in job.quarantine.read().collect()] == [901]


def test_many_batches_are_merged_and_old_days_go(spark, tmp_path):
    day = 86_400
    schema = "tx_id long, card long, us long, amt double"
    rows = [(i, i % 3, i * day // 4, float(i)) for i in range(20)]
    job = RollingStream(spark, str(tmp_path / "job"), WINDOWS, max_days_late=1, max_parts=2)
    for i in range(20):
        job.step(spark.createDataFrame(rows[i : i + 1], schema), i)
        if i == 11:  # a merge that has no mark, as after a failure, is not read
            stray = f"{job.history.path}/day=2/upto=1"
            spark.createDataFrame([(99, 0, 2 * day, 1.0)], schema).write.parquet(stray)
    want = rolling_past(spark.createDataFrame(rows, schema), "card", "us", "amt", WINDOWS)
    pick = ["tx_id", "rolling_count_24h", "rolling_amt_sum_24h"]
    assert sorted(job.current().select(*pick).collect()) == sorted(want.select(*pick).collect())
    parts = {d: len(job.history._parts(d, 20)) for d in job.history.days()}
    assert min(parts) >= 2 and max(parts.values()) <= 4


class PlainScores(DecisionStream):
    """The chain with a formula in place of a model."""

    def _score(self, came, batch_id):
        made = self.rolling.features.read_batch(batch_id).select("tx_id", "rolling_count_24h")
        score = F.col("rolling_count_24h") / 100
        return came.join(made, "tx_id", "left").select(
            "tx_id", F.col("ts").alias("recorded_at"), F.to_json(F.struct("amt", "rolling_count_24h")).alias("inputs"),
            score.alias("score_raw"), score.alias("score_calibrated"), F.lit("[]").alias("top_features"),
        )


@pytest.mark.parametrize("broken", ["features", "history", "scores", "entries", "none"])
def test_chain_logs_each_row_once_after_a_failure_at_any_write(spark, tmp_path, monkeypatch, broken):
    pdf = skewed(60).rename(columns={"tx": "tx_id", "t": "us"})
    df = spark.createDataFrame(pdf).select("tx_id", "card", "us", "amt", F.timestamp_seconds("us").alias("ts"))
    job = PlainScores(spark, str(tmp_path / "job"), SimpleNamespace(version="v", features=("amt",)), WINDOWS)
    first, second = df.filter("us < 120000"), df.filter("us >= 120000")
    job.step(first, 0)
    owner, name = {
        "features": (job.rolling.features, "write"), "history": (job.rolling.history, "write"), "scores": (job.scores, "write"),
        "entries": (job.log, "append"), "none": (job.scores, "read"),
    }[broken]
    if broken != "none":
        write = getattr(owner, name)

        def lost(rows, batch_id):
            write(rows.limit(5), batch_id) if broken != "entries" else None
            raise RuntimeError("lost")

        monkeypatch.setattr(owner, name, lost)
        with pytest.raises(RuntimeError):
            job.step(second, 1)
        monkeypatch.setattr(owner, name, write)
        assert job.log.entries().count() == first.count() == job.scored().count() == job.features().count()
    job.step(second, 1)
    job.step(second, 1)
    want = {r.tx_id: r.rolling_count_24h for r in rolling_past(df, "card", "us", "amt", WINDOWS).collect()}
    got = job.log.entries().select("tx_id", F.get_json_object("inputs", "$.rolling_count_24h").cast("long").alias("n")).collect()
    assert len(got) == len(want) and {r.tx_id: r.n for r in got} == want
    assert job.scored().count() == job.features().count() == len(want)


def test_labels_come_from_the_stream_alone(spark, tmp_path):
    day = 86_400
    # Spark drops what is not after 1970-01-01, where a watermark begins.
    tx = spark.createDataFrame([(i, i * day) for i in range(1, 40)], "tx_id long, s long").select("tx_id", F.timestamp_seconds("s").alias("ts"))
    # Early, in time and twice, at the last day, too late, of an unknown transaction; the rest have none.
    given = [(1, 1 + 5, 1), (2, 2 + 30, 0), (2, 2 + 40, 1), (3, 3 + 60, 1), (4, 4 + 61, 1), (99, 50, 1), (5, 5 + 45, 0), (5, 5 + 45, 1)]
    labels = spark.createDataFrame([(t, d * day, c) for t, d, c in given], "label_tx_id long, s long, confirmed long").select(
        "label_tx_id", F.timestamp_seconds("s").alias("arrived"), "confirmed"
    )
    ends = monitor.closing_rows(tx, labels, "ts")
    for name, df, end, cut in (("tx", tx, ends[0], "ts < timestamp_seconds(1728000)"), ("labels", labels, ends[1], "arrived < timestamp_seconds(4000000)")):
        for part in (df.filter(cut), df.filter(f"NOT {cut}"), end):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    streams = [runs.tx_stream(spark, str(tmp_path / n), d.schema, 1) for n, d in (("tx", tx), ("labels", labels))]
    versions = runs.BatchTable(spark, str(tmp_path / "out"))
    runs.run_batches(monitor.late_label_join(*streams, "ts"), str(tmp_path / "mark"), versions.write)
    found = {r.tx_id: (r.status, r.confirmed) for r in monitor.label_status(versions.read()).collect()}
    assert found == {i: {2: ("confirmed", 0), 3: ("confirmed", 1), 5: ("confirmed", 1)}.get(i, ("provisional", None)) for i in range(1, 40)}
    history = sorted((r.tx_id, r.version, r.confirmed) for r in monitor.label_versions(versions.read()).collect() if r.version)
    assert history == [(2, 1, 0), (2, 2, 1), (3, 1, 1), (5, 1, 1), (5, 2, 0)]


def test_steps_of_many_rows_arrive_in_more_files(spark, monkeypatch):
    import glob
    from riskloom.catalog import streams

    monkeypatch.setattr(streams, "ROWS_PER_FILE", 100)
    seen = []
    monkeypatch.setattr(streams.runs, "tx_stream", lambda spark, path, schema, files: seen.append((path, files)))
    rows = spark.range(3_000).select("id", F.timestamp_seconds("id").alias("ts"))
    streams.arriving(rows, "ts")
    path, files = seen[0]
    assert files == 10 and len(glob.glob(f"{path}/*.parquet")) == 30
    assert spark.read.parquet(path).distinct().count() == 3_000
    # Small steps keep their few files.
    assert streams.files_per_step(rows.limit(50)) == streams.FILES


def test_state_tasks_follow_the_rows_not_the_session(spark, tmp_path):
    df = spark.range(1, 40).select(F.col("id").alias("tx_id"), F.timestamp_seconds(F.col("id") * 100).alias("ts"))
    files(df, str(tmp_path / "in"), [F.col("tx_id") < 20, F.col("tx_id") >= 20])
    seen, name = [], "spark.sql.shuffle.partitions"
    before = {n: spark.conf.get(n, None) for n in (name, "spark.sql.streaming.maxBatchesToRetainInMemory")}
    stream = monitor.drop_retries(runs.tx_stream(spark, str(tmp_path / "in"), df.schema, 1), "tx_id", "ts")

    def step(rows, batch_id):
        seen.append((rows.rdd.getNumPartitions(), rows.sparkSession.conf.get(name)))
        rows.collect()

    try:
        spark.conf.set(name, "3")
        runs.run_batches(stream, str(tmp_path / "mark"), step, settings={name: "5"})
        assert set(seen) == {(5, "5")} and len(seen) >= 2
        # The session has its own again, also after a stream that cannot start.
        assert spark.conf.get(name) == "3"
        with pytest.raises(Exception):
            runs.run_batches(df, str(tmp_path / "other"), step, settings={name: "5"})
        assert spark.conf.get(name) == "3"
    finally:
        spark.conf.set(name, before[name])
    assert {n: spark.conf.get(n, None) for n in before} == before


def test_state_tasks_by_rows_and_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    tasks = lambda rows: int(runs.state_settings(spark, rows)["spark.sql.shuffle.partitions"])
    assert tasks(0) == tasks(1) == cores
    monkeypatch.setattr(runs, "ROWS_PER_STATE_TASK", 10)
    assert tasks(10 * cores) == cores and tasks(10 * cores + 1) == 2 * cores


def label_tables(spark, path, n=600):
    """Orders of 300 days, some of one day, and confirmations around the window, some twice and some of unknown orders."""
    orders = spark.range(1, n + 1).selectExpr("id AS o_orderkey", "date_add(DATE'1995-01-01', CAST(IF(id % 10 = 0, 150, id * 37 % 300) AS INT)) AS o_orderdate")
    lines = orders.crossJoin(spark.range(3).withColumnRenamed("id", "line")).selectExpr(
        "IF(o_orderkey % 50 = 7, o_orderkey + 100000, o_orderkey) AS l_orderkey",
        "date_add(o_orderdate, CAST((o_orderkey * 7 + line * 13) % 70 + 5 AS INT)) AS l_shipdate", "IF((o_orderkey + line) % 3 = 0, 'R', 'N') AS l_returnflag")
    orders.write.parquet(f"{path}/orders.parquet")
    lines.union(lines.filter("l_orderkey % 9 = 0")).write.parquet(f"{path}/lineitem.parquet")


def test_late_labels_of_many_rows_come_in_bounded_steps(spark, tmp_path, monkeypatch):
    import os
    from riskloom.catalog import streams

    label_tables(spark, str(tmp_path))
    batches, run = [], streams.runs.run_batches

    def watched(joined, checkpoint, *given, **kept):
        run(joined, checkpoint, *given, **kept)
        batches.append(len([f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]))

    def found():
        joined = streams.labelled(spark, str(tmp_path))
        return [sorted(df.collect(), key=str) for df in (monitor.label_versions(joined), monitor.label_status(joined))]

    monkeypatch.setattr(streams.runs, "run_batches", watched)
    few = found()
    assert len(few[1]) == 600 and {r.status for r in few[1]} == {"provisional", "confirmed"}
    monkeypatch.setattr(streams, "ROWS_PER_STEP", 500)
    # Steps were two however many rows there were, so state held half of a table of any size.
    assert found() == few and batches[1] >= batches[0] + 3


def test_many_steps_hold_each_row_once_in_order(spark, monkeypatch):
    import glob
    import os
    from riskloom.catalog import streams

    seen = []
    monkeypatch.setattr(streams.runs, "tx_stream", lambda spark, path, schema, files: seen.append((path, files)))
    # A tenth of the rows at one instant; those without a time are in no step, as before.
    rows = spark.range(5_000).selectExpr("id", "IF(id % 100 = 3, NULL, timestamp_seconds(IF(id % 10 = 0, 900, id * 31 % 5000))) AS ts")
    streams.arriving(rows, "ts", 9)
    path, files = seen[0]
    names = sorted(glob.glob(f"{path}/*.parquet"), key=os.path.getmtime)
    assert len(names) == 9 * files and files == streams.FILES
    spans = [spark.read.parquet(*names[i : i + files]).agg(F.min("ts"), F.max("ts"), F.count("*")).first() for i in range(0, len(names), files)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and max(s[2] for s in spans) < 1_700
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [i for i in range(5_000) if i % 100 != 3]
    # The table in order goes when the steps are written.
    assert not glob.glob(f"{os.path.dirname(path)}/scratch-*/*in-order")
