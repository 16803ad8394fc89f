"""Checks of the streaming jobs: the given tables are staged as arriving files."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.bindings import DAY_MICROS, EVENT_WINDOWS, TX_EVENTS_SQL, table, tx_events
from riskloom.catalog.features import off_border, rolling_sql
from riskloom.catalog.modelling import SPLIT_SQL, bundle, curated
from riskloom.catalog.registry import once, query, rounded
from riskloom.functions import scalar as X
from riskloom.models import calibrate, train
from riskloom.models.score import Bundle, score_batch
from riskloom.operators import rolling
from riskloom.operators.selection import exact_quantiles
from riskloom.operators.split import temporal_split
from riskloom.session import Scratch, materialize, work_dir
from riskloom.streaming import monitor, runs
from riskloom.streaming.chain import DecisionStream
from riskloom.streaming.rolling import RollingStream


#: Files per step of an arriving stream, at least; a step is one micro-batch.
FILES = 4
#: Rows of an arriving file; larger steps come in more files, as one task writes or reads a file.
ROWS_PER_FILE = 200_000
#: Steps up to which each scans the whole table for its rows; for more it is put in order first.
SCANS = 3
#: Rows of a step of late labels, both streams together: state holds a step's rows and those whose window is open.
ROWS_PER_STEP = 6_000_000


def files_per_step(df: DataFrame, parts: int = 3, files: int = FILES) -> int:
    """Files of each of ``parts`` steps of about the same number of rows."""
    return max(files, -(-df.count() // (parts * ROWS_PER_FILE)))


def arriving(df: DataFrame, clock: str, parts: int = 3, files: int = FILES, last: DataFrame | None = None) -> DataFrame:
    """Write the rows in time order as a few successive steps of files, ``last`` behind them, and open them as a stream."""
    spark = df.sparkSession
    path = work_dir(spark, "arriving")
    micros = df.withColumn("_at", F.unix_micros(clock))
    files = files_per_step(df, parts, files)
    # Whole numbers, so that a scan can skip files by them.
    inner = [at if at is None else math.ceil(at) for at in exact_quantiles(micros, "_at", [i / parts for i in range(1, parts)])[()]]
    borders = [None, *inner, None]
    with Scratch(spark) as scratch:
        if parts > SCANS:
            # Files of a short range of time each: a step reads those of its own.
            micros = scratch.table(micros.repartitionByRange(2 * FILES * parts, "_at"), "in-order")
        for low, high in zip(borders, borders[1:]):
            inside = F.lit(True)
            inside = inside & (F.col("_at") >= F.lit(low)) if low is not None else inside
            inside = inside & (F.col("_at") < F.lit(high)) if high is not None else inside
            micros.filter(inside).drop("_at").repartition(files).write.mode("append").parquet(path)
    if last is not None:
        last.coalesce(1).write.mode("append").parquet(path)
    return runs.tx_stream(spark, path, df.schema, files)


@query("st_rolling_state", f"WITH {TX_EVENTS_SQL} {rolling_sql(EVENT_WINDOWS)}")
def st_rolling_state(spark, sf):
    job = RollingStream(spark, work_dir(spark, "rolling"), EVENT_WINDOWS, DAY_MICROS)
    job.run(arriving(tx_events(spark, sf).select("tx_id", "card", "ts", "us", "amt"), "ts"))
    names = [n for w in EVENT_WINDOWS for n in rolling.statistic_names(w).values()]
    out = off_border(job.current().select("tx_id", *names), EVENT_WINDOWS)
    return rounded(out, **{n: 4 for n in names if "_count_" not in n})


@query("stream_source_tx", f"WITH {TX_EVENTS_SQL} SELECT tx_id, card, amt FROM tx")
def stream_source_tx(spark, sf):
    path = work_dir(spark, "ingested")
    stream = arriving(tx_events(spark, sf).select("tx_id", "card", "ts", "amt"), "ts")
    runs.run_to_table(stream, path, f"{path}-checkpoint")
    return spark.read.parquet(path).select("tx_id", "card", "amt")


@query("st_score_decide", f"{SPLIT_SQL} SELECT tx_id, 'small-1' AS model_version, true AS as_in_batch, true AS reason_known FROM p")
def st_score_decide(spark, sf):
    """Every row is decided once, with the scores and the decision of the batch job."""
    path = work_dir(spark, "decided")
    source = curated(spark, sf)
    staged = work_dir(spark, "features")
    source.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(staged)
    decided = monitor.score_and_decide(runs.tx_stream(spark, staged, source.schema, files_per_step(source)), bundle(spark, sf))
    runs.run_to_table(decided, path, f"{path}-checkpoint", partition="model_version")
    batch = score_batch(source, bundle(spark, sf)).select("tx_id", F.col("score_raw").alias("_raw"), F.col("score_calibrated").alias("_calibrated"))
    out = spark.read.parquet(path).join(batch, "tx_id", "left")
    same = (F.col("score_raw") == F.col("_raw")) & (F.col("decision") == X.decision_band(F.col("_calibrated")))
    return out.select("tx_id", "model_version", same.alias("as_in_batch"), F.col("reason_code").isNotNull().alias("reason_known"))


@query("st_tumbling_report", f"""WITH {TX_EVENTS_SQL}
SELECT strftime(ts, '%Y-%m-%d') AS day, category, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_pos, ROUND(AVG(label),6) AS rate FROM tx GROUP BY ALL""")
def st_tumbling_report(spark, sf):
    path = work_dir(spark, "tumbling")
    stream = arriving(tx_events(spark, sf).select("ts", "category", "label"), "ts")
    versions = runs.BatchTable(spark, path)
    # Update mode writes every changed window, so open windows are reported too.
    runs.run_batches(monitor.tumbling_report(stream, "ts", "category", "label"), f"{path}-checkpoint", versions.write, "update")
    out = versions.latest("window_start", "category")
    return rounded(out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "category", "n", "n_pos", "rate"), rate=6)


@query("st_sliding_rate_limit", f"""WITH {TX_EVENTS_SQL}, w AS (
SELECT card, date_trunc('hour', ts) - to_hours(CAST(h AS BIGINT)) AS start FROM tx, range(6) r(h))
SELECT strftime(start, '%Y-%m-%d %H:%M') AS window_start, card, COUNT(*) AS n FROM w GROUP BY ALL HAVING COUNT(*) > 3""")
def st_sliding_rate_limit(spark, sf):
    path = work_dir(spark, "sliding")
    stream = arriving(tx_events(spark, sf).select("ts", "card"), "ts")
    versions = runs.BatchTable(spark, path)
    alarms = monitor.sliding_rate_limit(stream, "ts", "card", 3, "6 hours", "1 hour")
    runs.run_batches(alarms, f"{path}-checkpoint", versions.write, "update")
    return versions.latest("window_start", "card").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "card", "n"
    )


@query("st_dedup", f"WITH {TX_EVENTS_SQL} SELECT tx_id, amt FROM tx")
def st_dedup(spark, sf):
    path = work_dir(spark, "deduplicated")
    sent = tx_events(spark, sf).select("tx_id", "ts", "amt", "category")
    # Sent again ten days later: mostly in another micro-batch, so the state has to know them.
    again = sent.filter(F.col("category") == "error").withColumn("ts", F.col("ts") + F.expr("INTERVAL 10 DAYS"))
    stream = arriving(sent.unionByName(again), "ts")
    runs.run_to_table(monitor.drop_retries(stream, "tx_id", "ts", "30 days"), path, f"{path}-checkpoint")
    return spark.read.parquet(path).select("tx_id", "amt")


@query("st_late_labels", """
SELECT o_orderkey AS tx_id, CASE WHEN MIN(l_shipdate) IS NULL THEN 'provisional' ELSE 'confirmed' END AS status,
 CAST(arg_min(r, l_shipdate) AS BIGINT) AS confirmed FROM orders LEFT JOIN
 (SELECT l_orderkey, l_shipdate, MAX(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS r FROM lineitem GROUP BY ALL)
 ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate + INTERVAL 30 DAY AND o_orderdate + INTERVAL 60 DAY GROUP BY o_orderkey""")
def st_late_labels(spark, sf):
    """States from the rows of the stream alone, those without a confirmation included."""
    return monitor.label_status(labelled(spark, sf)).select("tx_id", "status", "confirmed")


@query("st_label_versions", """
SELECT o_orderkey AS tx_id, CASE WHEN l_shipdate IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate, r DESC) END AS version,
 CASE WHEN l_shipdate IS NULL THEN 'provisional' ELSE 'confirmed' END AS status, strftime(l_shipdate, '%Y-%m-%d') AS arrived, CAST(r AS BIGINT) AS confirmed
FROM orders LEFT JOIN (SELECT l_orderkey, l_shipdate, CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS r FROM lineitem)
 ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate + INTERVAL 30 DAY AND o_orderdate + INTERVAL 60 DAY""")
def st_label_versions(spark, sf):
    out = monitor.label_versions(labelled(spark, sf))
    return out.select("tx_id", "version", "status", F.date_format("arrived", "yyyy-MM-dd").alias("arrived"), "confirmed")


def labelled(spark, sf):
    """Orders joined with their shipments as a stream of transactions and one of late confirmations."""
    path = work_dir(spark, "labelled")
    tx = table(spark, sf, "orders").select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    labels = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("label_tx_id"), F.col("l_shipdate").cast("timestamp").alias("arrived"),
        (F.col("l_returnflag") == "R").cast("bigint").alias("confirmed"),
    )
    last_tx, last_label = monitor.closing_rows(tx, labels, "ts")
    n = tx.count() + labels.count()
    steps = max(2, -(-n // ROWS_PER_STEP))
    with ThreadPoolExecutor(2) as pool:
        came = [pool.submit(arriving, df, clock, steps, last=last) for df, clock, last in ((tx, "ts", last_tx), (labels, "arrived", last_label))]
    joined = monitor.late_label_join(*(stream.result() for stream in came), "ts")
    versions = runs.BatchTable(spark, path)
    runs.run_batches(joined, f"{path}-checkpoint", versions.write, settings=runs.state_settings(spark, n // steps))
    return versions.read()


CHAIN_FEATURES = ("amt", "k", *(n for w in EVENT_WINDOWS for n in rolling.statistic_names(w).values()))


def event_bundle(spark, sf):
    """A small model over the rolling features of the events, trained by the batch job."""
    def make():
        rows = rolling.rolling_past(tx_events(spark, sf), "card", "us", "amt", EVENT_WINDOWS)
        rows = materialize(temporal_split(rows.withColumn("is_fraud", F.col("label_rare")), "us", "tx_id"), "events-train")
        model = train.fit_trees(rows, train.TreeParams(max_depth=4, learning_rate=0.2, max_trees=10), CHAIN_FEATURES)
        val = train.raw_scores(rows.filter(F.col("split") == "val"), model, CHAIN_FEATURES)
        return Bundle(model, calibrate.fit_platt(val, "is_fraud", "score_raw"), "events-1", CHAIN_FEATURES)
    return once(spark, sf, "event-bundle", make)


@query("st_decision_chain", f"""WITH {TX_EVENTS_SQL}, f AS ({rolling_sql(EVENT_WINDOWS)})
SELECT f.tx_id, rolling_count_1h, rolling_count_24h, rolling_amt_sum_24h, 1 AS n_entries, 'events-1' AS model_version, true AS as_scored, true AS as_decided
FROM f""")
def st_decision_chain(spark, sf):
    """Raw transactions to log entries in one stream; the entry's inputs are the batch job's features."""
    bundle_ = event_bundle(spark, sf)
    job = DecisionStream(spark, work_dir(spark, "chain"), bundle_, EVENT_WINDOWS, DAY_MICROS)
    job.run(arriving(tx_events(spark, sf).select("tx_id", "card", "ts", "us", "amt", "k"), "ts"))
    inputs = "amt double, k int, " + ", ".join(f"{n} double" for n in CHAIN_FEATURES[2:])
    log = job.log.as_of("2999-01-01").select(
        "tx_id", F.from_json("inputs", inputs).alias("i"), "score_raw", "score_calibrated", "decision", "model_version", "n_entries"
    )
    # The logged inputs, scored again by the batch job.
    again = train.raw_scores(log.select("tx_id", "score_raw", "score_calibrated", "decision", "model_version", "n_entries", "i.*")
                             .withColumnRenamed("score_raw", "_logged"), bundle_.model, CHAIN_FEATURES)
    out = again.select(
        "tx_id", *[F.col(n) for n in CHAIN_FEATURES[2:]], "n_entries", "model_version",
        (F.abs(F.col("score_raw") - F.col("_logged")) < 1e-9).alias("as_scored"),
        (F.col("decision") == X.decision_band(F.col("score_calibrated"))).alias("as_decided"),
    )
    rows = rounded(off_border(out, EVENT_WINDOWS), rolling_amt_sum_24h=4)
    return rows.select(
        "tx_id", F.col("rolling_count_1h").cast("bigint").alias("rolling_count_1h"), F.col("rolling_count_24h").cast("bigint").alias("rolling_count_24h"),
        "rolling_amt_sum_24h", "n_entries", "model_version", "as_scored", "as_decided",
    )
