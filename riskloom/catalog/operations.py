"""Checks of sources and sinks, keyed joins, decisions, monitoring and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.catalog.bindings import TX_EVENTS_SQL, TX_ORDERS_SQL, table, tx_events, tx_orders
from riskloom.catalog.expressions import AGE, age_group_sql
from riskloom.catalog.features import SPLIT_SQL, card_order
from riskloom.catalog.registry import as_long, query, rounded
from riskloom.functions import scalar as X
from riskloom.operators import decide, monitor
from riskloom.operators.sampling import sample_per_class
from riskloom.operators.split import temporal_split
from riskloom.session import work_dir
from riskloom.sources import gate, sinks, tables
from riskloom.sources.decisions import DecisionLog

OP = "CAST(0.6642 AS DOUBLE)"
BAND = "CASE WHEN score < CAST(0.3 AS DOUBLE) THEN 'approve' WHEN score >= CAST(0.85 AS DOUBLE) THEN 'block' ELSE 'pending_review' END"


def band():
    return X.decision_band(F.col("score"))


@query("scan_csv_union", """SELECT event_id, user_id, value, event_type, CASE WHEN event_type='error' THEN NULL ELSE props END AS props FROM events""")
def scan_csv_union(spark, sf):
    """Two CSV sets with different columns in different order, read back as one table.

    A third file holds one unreadable value; its row is told apart by it.
    """
    path = work_dir(spark, "csv")
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type", "props")
    full, short = F.col("event_type") != "error", ["value", "event_type", "event_id", "user_id"]
    events.filter(full).write.option("escape", '"').csv(f"{path}/full", header=True)
    events.filter(~full).select(*short).write.csv(f"{path}/short", header=True)
    schema = events.schema
    bad = spark.createDataFrame([("1,200", "click", "-1", "0")], "value string, event_type string, event_id string, user_id string")
    bad.write.csv(f"{path}/bad", header=True)
    read = tables.scan_csv_union(spark, [f"{path}/{p}" for p in ("full", "short", "bad")], schema, keep_unreadable=True)
    return read.where(F.size(tables.UNREADABLE) == 0).select(*events.columns)


@query("schema_validate", "SELECT 'extra: k' AS difference, COUNT(*) AS n_rows FROM events")
def schema_validate(spark, sf):
    events = table(spark, sf, "events").withColumn("k", F.length("props"))
    expected = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    diff = tables.schema_difference(events, expected)
    kept = tables.validate_schema(events, expected)
    text = "; ".join(f"{k}: {','.join(v)}" for k, v in (("missing", diff.missing), ("extra", diff.extra)) if v)
    return kept.agg(F.count("k").alias("n_rows")).withColumn("difference", F.lit(text))


@query("sink_sorted_parquet", f"WITH {TX_EVENTS_SQL} SELECT tx_id, us, amt FROM tx")
def sink_sorted_parquet(spark, sf):
    path = work_dir(spark, "staging")
    sinks.write_sorted(tx_events(spark, sf).select("tx_id", "us", "amt"), path, "us", "tx_id")
    return spark.read.parquet(path)


@query("sink_curated", f"WITH {TX_EVENTS_SQL}, {SPLIT_SQL} SELECT tx_id, amt, CAST(label AS BIGINT) AS is_fraud, split FROM sp")
def sink_curated(spark, sf):
    path = work_dir(spark, "curated")
    split = temporal_split(tx_events(spark, sf), "us", "tx_id")
    sinks.write_curated(split.select("tx_id", "amt", F.col("label").cast("bigint").alias("is_fraud"), "split"), path)
    return spark.read.parquet(path)


@query("sink_scored", f"""WITH {TX_EVENTS_SQL} SELECT tx_id, amt, ROUND(score,9) AS score_raw, ROUND(score*score,9) AS score_calibrated,
 score >= {OP} AS decision_operating, score >= CAST(0.52 AS DOUBLE) AS decision_cost FROM tx""")
def sink_scored(spark, sf):
    path = work_dir(spark, "scored")
    out = tx_events(spark, sf).select(
        "tx_id", "amt", F.col("score").alias("score_raw"), (F.col("score") * F.col("score")).alias("score_calibrated"),
        (F.col("score") >= S.OPERATING_THRESHOLD).alias("decision_operating"), (F.col("score") >= S.COST_THRESHOLD).alias("decision_cost"),
    )
    sinks.write_scored(out, path)
    return rounded(spark.read.parquet(path), score_raw=9, score_calibrated=9)


@query("sink_report_csv", f"WITH {TX_EVENTS_SQL} SELECT category AS value, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_pos FROM tx GROUP BY category")
def sink_report_csv(spark, sf):
    from riskloom.operators.profile import rate_by_keys
    path = work_dir(spark, "report")
    sinks.write_report_csv(rate_by_keys(tx_events(spark, sf), "label", {"category": F.col("category")}), path)
    return spark.read.schema("key string, value string, n bigint, n_pos bigint, rate double").csv(path, header=True).select("value", "n", "n_pos")


@query("load_splits", f"WITH {TX_EVENTS_SQL}, {SPLIT_SQL} SELECT split, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_pos, CAST(2 AS BIGINT) AS n_features FROM sp GROUP BY split")
def load_splits(spark, sf):
    path = work_dir(spark, "curated")
    split = temporal_split(tx_events(spark, sf), "us", "tx_id")
    sinks.write_curated(split.select("tx_id", "amt", "k", F.col("label").alias("is_fraud"), "split"), path)
    loaded = tables.load_splits(path, spark)
    out = None
    for name in S.SPLITS:
        part = getattr(loaded, name).agg(F.count(F.lit(1)).alias("n"), F.sum("is_fraud").cast("bigint").alias("n_pos")).withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("n_features", F.lit(len(loaded.features)).cast("bigint"))


@query("feature_schema_gate", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CASE WHEN category='error' AND k < 20 THEN 'bad amt; bad k' WHEN category='error' THEN 'bad amt' WHEN k < 20 THEN 'bad k' END AS reject_reason,
 CASE WHEN category <> 'view' THEN ROUND(score,9) END AS score FROM tx""")
def feature_schema_gate(spark, sf):
    tx = tx_events(spark, sf).select(
        "tx_id", F.when(F.col("category") != "error", F.col("amt")).alias("amt"),
        F.when(F.col("k") < 20, F.lit(float("inf"))).otherwise(F.col("k").cast("double")).alias("k"),
        F.when(F.col("category") == "view", F.lit(float("nan"))).otherwise(F.col("score")).alias("score"),
    )
    gated = gate.gate_rows(tx, ["amt", "k"], ["score"])
    return rounded(gated.select("tx_id", "reject_reason", "score"), score=9)


@query("feature_schema_gate_json", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CASE category WHEN 'error' THEN 'missing score' WHEN 'view' THEN 'unknown extra' WHEN 'click' THEN 'bad amt' END AS reject_reason FROM tx""")
def feature_schema_gate_json(spark, sf):
    category = F.col("category")
    body = F.concat(
        F.lit('{"amt": '), F.when(category == "click", "null").otherwise(F.col("amt").cast("string")),
        F.when(category != "error", F.concat(F.lit(', "score": '), F.col("score").cast("string"))).otherwise(""),
        F.when(category == "view", ', "extra": 1').otherwise(""), F.lit("}"),
    )
    out = gate.gate_json(tx_events(spark, sf).select("tx_id", body.alias("body")), "body", ["amt"], ["score"])
    return out.select("tx_id", "reject_reason")


@query("decision_log_append", f"""WITH {TX_EVENTS_SQL}
SELECT strftime(ts, '%Y-%m-%d') AS day, {BAND} AS decision, COUNT(*) + COUNT(*) FILTER (WHERE category='error') AS n_entries FROM tx GROUP BY ALL""")
def decision_log_append(spark, sf):
    log = DecisionLog(spark, work_dir(spark, "decisions"))
    decided = entries(tx_events(spark, sf), "auto")
    # A correction is a second entry; the first one stays.  What is sent again changes nothing.
    corrected = entries(tx_events(spark, sf).filter(F.col("category") == "error"), "corrected").withColumn("corrects", entry_id("auto"))
    for batch_id, batch in (("auto", decided), ("auto", decided), ("corrected", corrected), ("corrected", corrected)):
        log.append(batch, batch_id)
    return log.entries().groupBy(F.col("dt").cast("string").alias("day"), "decision").agg(F.count(F.lit(1)).alias("n_entries"))


def entry_id(kind):
    return F.concat_ws("-", F.lit(kind), "tx_id")


def entries(tx, kind):
    """Log entries of the given transactions."""
    return tx.select(
        entry_id(kind).alias("entry_id"), "tx_id", F.col("ts").alias("recorded_at"), band().alias("decision"), F.lit("m-1").alias("model_version"),
        F.col("score").alias("score_raw"), F.col("score").alias("score_calibrated"), F.to_json(F.struct("amt", "k")).alias("inputs"),
        F.lit("[]").alias("top_features"), F.array(F.lit("model")).alias("rules"),
    )


@query("decision_log_as_of", f"""WITH {TX_EVENTS_SQL}, t AS (SELECT ((MIN(us)+MAX(us))//2000000)*1000000 AS moment FROM tx)
SELECT tx_id, CASE WHEN category='view' AND us + 7200000000 <= moment THEN 'approve' WHEN k < 50 AND us + 10800000000 <= moment THEN 'block' ELSE {BAND} END AS decision,
 CASE WHEN category='view' AND us + 7200000000 <= moment THEN 'analyst' END AS analyst,
 1 + CASE WHEN category='view' AND us + 7200000000 <= moment THEN 1 ELSE 0 END + CASE WHEN k < 50 AND us + 10800000000 <= moment THEN 1 ELSE 0 END AS n_entries
FROM tx, t WHERE us <= moment""")
def decision_log_as_of(spark, sf):
    """An analyst decides after two hours; an error found after three corrects the model's entry, not the analyst's."""
    tx = tx_events(spark, sf)
    log = DecisionLog(spark, work_dir(spark, "decisions"))
    log.append(entries(tx, "auto"), 0)
    later = F.col("recorded_at")
    by_hand = entries(tx.filter(F.col("category") == "view"), "hand").withColumns(
        {"recorded_at": later + F.expr("INTERVAL 2 HOURS"), "decision": F.lit("approve"), "analyst": F.lit("analyst"), "reason": F.lit("known customer")})
    log.append(by_hand, 1)
    fixed = entries(tx.filter(F.col("k") < 50), "fixed").withColumns(
        {"recorded_at": later + F.expr("INTERVAL 3 HOURS"), "decision": F.lit("block"), "corrects": entry_id("auto")})
    log.append(fixed, 2)
    middle = tx.agg(F.floor((F.min("us") + F.max("us")) / F.lit(2 * X.MICROS)).alias("s")).select(F.timestamp_seconds("s").cast("string").alias("t")).first().t
    return log.as_of(middle).select("tx_id", "decision", "analyst", "n_entries")


@query("join_meta_to_test", f"""WITH {TX_EVENTS_SQL}, {SPLIT_SQL}
SELECT tx_id, category, amt, CAST(label AS BIGINT) AS label, ROUND(score,9) AS score FROM sp WHERE split='test'""")
def join_meta_to_test(spark, sf):
    from riskloom.plans.evaluate import attach_metadata
    tx = temporal_split(tx_events(spark, sf), "us", "tx_id")
    scored = tx.filter(F.col("split") == "test").select("tx_id", "label", "score")
    out = attach_metadata(scored, tx.select("tx_id", "label", "category", "amt"), "tx_id", "label", ["category", "amt"])
    return rounded(as_long(out, "label"), score=9)


@query("join_val_amount", f"""WITH {TX_EVENTS_SQL}, {SPLIT_SQL} SELECT tx_id, amt, ROUND(score,9) AS score FROM sp WHERE split='val'""")
def join_val_amount(spark, sf):
    from riskloom.plans.evaluate import attach_metadata
    tx = temporal_split(tx_events(spark, sf), "us", "tx_id")
    scored = tx.filter(F.col("split") == "val").select("tx_id", "label", "score")
    out = attach_metadata(scored, tx.select("tx_id", "label", "amt"), "tx_id", "label", ["amt"])
    return rounded(out.select("tx_id", "amt", "score"), score=9)


@query("join_readable_sample", f"""WITH {TX_EVENTS_SQL}, {SPLIT_SQL}, r AS (
SELECT tx_id, CAST(label AS BIGINT) AS label, k, category, amt, row_number() OVER (PARTITION BY label ORDER BY ((((tx_id % 2147483647)*48271 + 42*7919) % 2147483647)*69621) % 2147483647, tx_id) AS pick
FROM sp WHERE split='test') SELECT tx_id, label, k, category, amt FROM r WHERE pick <= CASE label WHEN 1 THEN 50 ELSE 200 END""")
def join_readable_sample(spark, sf):
    from riskloom.plans.evaluate import attach_metadata
    tx = temporal_split(tx_events(spark, sf), "us", "tx_id")
    features = tx.filter(F.col("split") == "test").select("tx_id", "label", "k")
    joined = attach_metadata(features, tx.select("tx_id", "label", "category", "amt"), "tx_id", "label", ["category", "amt"])
    out = sample_per_class(joined, "tx_id", "label", {1: 50, 0: 200})
    return as_long(out.select("tx_id", "label", "k", "category", "amt"), "label")


@query("semi_anti_lists", f"""WITH {TX_ORDERS_SQL},
deny AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), allow AS (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)
SELECT tx_id, CASE WHEN card IN (SELECT * FROM deny) THEN 'block' WHEN card IN (SELECT * FROM allow) THEN 'approve' ELSE {BAND} END AS decision,
 CASE WHEN card IN (SELECT * FROM deny) THEN 'denylist' WHEN card IN (SELECT * FROM allow) THEN 'allowlist' ELSE 'model' END AS rule FROM tx""")
def semi_anti_lists(spark, sf):
    c = table(spark, sf, "customer")
    deny = c.filter(F.col("c_acctbal") < 0).select("c_custkey")
    allow = c.filter(F.col("c_acctbal") > 9000).select("c_custkey")
    return decide.apply_lists(tx_orders(spark, sf), "card", deny, allow, band()).select("tx_id", "decision", "rule")


@query("asof_label_delay", """
SELECT o_orderkey AS tx_id, CASE WHEN MIN(l_shipdate) IS NULL THEN 'provisional' ELSE 'confirmed' END AS status,
 CAST(arg_min(r, l_shipdate) AS BIGINT) AS confirmed FROM orders LEFT JOIN
 (SELECT l_orderkey, l_shipdate, MAX(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS r FROM lineitem GROUP BY ALL)
 ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate + INTERVAL 30 DAY AND o_orderdate + INTERVAL 60 DAY GROUP BY o_orderkey""")
def asof_label_delay(spark, sf):
    tx = table(spark, sf, "orders").select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    labels = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").cast("timestamp").alias("arrived"),
        (F.col("l_returnflag") == "R").cast("bigint").alias("confirmed"),
    )
    return decide.confirmed_labels(tx, labels, "tx_id", "ts").select("tx_id", "status", "confirmed")


QUEUE_SQL = f"""WITH {TX_ORDERS_SQL}
SELECT tx_id, state AS analyst, row_number() OVER (PARTITION BY state ORDER BY score DESC, amt DESC, us, tx_id) AS position
FROM tx WHERE {BAND} = 'pending_review'"""


def queue(spark, sf, **limit):
    waiting = tx_orders(spark, sf).filter(band() == "pending_review")
    order = [F.col("score").desc(), F.col("amt").desc(), *card_order()]
    out = decide.review_queue(waiting, "state", order, **limit)
    return out.select("tx_id", F.col("state").alias("analyst"), "position")


@query("win_queue_rank", QUEUE_SQL)
def win_queue_rank(spark, sf):
    return queue(spark, sf)


@query("win_queue_rank_dense", QUEUE_SQL)
def win_queue_rank_dense(spark, sf):
    """The plan for analysts with too many cases for one task, forced by a low limit."""
    return queue(spark, sf, limit=20)


@query("psi_drift", f"""WITH {TX_EVENTS_SQL}, e AS (SELECT quantile_cont(amt,[0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS q FROM tx WHERE us < {1_705_276_800_000_000}),
b AS (SELECT us >= {1_705_276_800_000_000} AS cur, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, len(list_filter(q, lambda x: x < amt)) AS bin FROM tx, e),
bb AS (SELECT bin, COUNT(*) AS n FROM b WHERE NOT cur GROUP BY 1), cc AS (SELECT week, bin, COUNT(*) AS n FROM b WHERE cur GROUP BY 1,2),
w AS (SELECT DISTINCT week FROM cc),
s AS (SELECT week, GREATEST(COALESCE(c.n,0)/CAST(SUM(COALESCE(c.n,0)) OVER (PARTITION BY week) AS DOUBLE),CAST(1e-6 AS DOUBLE)) AS p,
 GREATEST(COALESCE(bb.n,0)/CAST((SELECT SUM(n) FROM bb) AS DOUBLE),CAST(1e-6 AS DOUBLE)) AS q
 FROM (SELECT week, bin FROM w, range(10) r(bin)) g LEFT JOIN cc c USING (week, bin) LEFT JOIN bb USING (bin))
SELECT week AS period, ROUND(SUM((p-q)*ln(p/q)),6) AS psi, SUM((p-q)*ln(p/q)) > CAST(0.2 AS DOUBLE) AS alert FROM s GROUP BY week""")
def psi_drift(spark, sf):
    tx = tx_events(spark, sf)
    week = F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")
    out = monitor.psi_drift(tx, "amt", F.col("us") < F.lit(1_705_276_800_000_000), week)
    return rounded(out, psi=6)


@query("ks_drift", f"""WITH {TX_EVENTS_SQL}, v AS (SELECT amt, SUM(CASE WHEN us < {1_705_276_800_000_000} THEN 1 ELSE 0 END) AS b, SUM(CASE WHEN us < {1_705_276_800_000_000} THEN 0 ELSE 1 END) AS c FROM tx GROUP BY amt),
r AS (SELECT SUM(b) OVER (ORDER BY amt)/CAST(SUM(b) OVER () AS DOUBLE) AS f, SUM(c) OVER (ORDER BY amt)/CAST(SUM(c) OVER () AS DOUBLE) AS g FROM v)
SELECT ROUND(MAX(abs(f-g)),6) AS ks, (SELECT CAST(SUM(b) AS BIGINT) FROM v) AS n_baseline, (SELECT CAST(SUM(c) AS BIGINT) FROM v) AS n_current FROM r""")
def ks_drift(spark, sf):
    return rounded(monitor.ks_drift(tx_events(spark, sf), "amt", F.col("us") < F.lit(1_705_276_800_000_000)), ks=6)


FAIR = {"state": "state", "age_group": age_group_sql(AGE), "category": "category"}


@query("fairness_by_group", f"""WITH {TX_ORDERS_SQL}, g AS ({' UNION ALL '.join(f"SELECT '{d}' AS dimension, {e} AS value, label, score FROM tx" for d, e in FAIR.items())}),
r AS (SELECT dimension, value, COUNT(*) AS n, SUM(CASE WHEN score >= {OP} AND label=0 THEN 1 ELSE 0 END)/CAST(SUM(1-label) AS DOUBLE) AS fpr,
 SUM(CASE WHEN score >= {OP} AND label=1 THEN 1 ELSE 0 END)/CAST(SUM(label) AS DOUBLE) AS tpr FROM g WHERE value IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 100),
m AS (SELECT dimension, quantile_cont(fpr,0.5) AS mf, quantile_cont(tpr,0.5) AS mt, CASE dimension WHEN 'age_group' THEN CAST(1.5 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END AS k FROM r GROUP BY dimension)
SELECT dimension, value, n, ROUND(fpr,6) AS fpr, ROUND(tpr,6) AS recall, fpr > k*mf OR fpr*k < mf AS fpr_flag, tpr > k*mt OR tpr*k < mt AS recall_flag FROM r JOIN m USING (dimension)""")
def fairness_by_group(spark, sf):
    groups = {"state": F.col("state"), "age_group": X.age_group(X.age_years(F.col("ts"), F.col("dob"))), "category": F.col("category")}
    out = monitor.fairness_by_group(tx_orders(spark, sf), "label", "score", groups)
    return rounded(out, fpr=6, recall=6)


@query("report_period_rollup", f"""WITH {TX_ORDERS_SQL}, d AS (SELECT *, {BAND} AS decision, strftime(ts, '%Y-%m') || CASE WHEN EXTRACT(day FROM ts) <= 15 THEN '-A' ELSE '-B' END AS period FROM tx)
SELECT state AS merchant, period, CAST(GROUPING_ID(state, period) AS BIGINT) AS level, COUNT(*) AS n_reviewed, CAST(SUM(CASE WHEN decision='approve' THEN 1 ELSE 0 END) AS BIGINT) AS n_auto_approved,
 CAST(SUM(CASE WHEN decision='block' THEN 1 ELSE 0 END) AS BIGINT) AS n_auto_blocked, CAST(SUM(CASE WHEN decision='pending_review' THEN 1 ELSE 0 END) AS BIGINT) AS n_escalated,
 ROUND(SUM(CASE WHEN decision='block' AND label=1 THEN amt ELSE 0 END),2) AS saved_amount, CAST(SUM(CASE WHEN decision='block' AND label=0 THEN 1 ELSE 0 END) AS BIGINT) AS n_false_positives
FROM d GROUP BY ROLLUP(state, period)""")
def report_period_rollup(spark, sf):
    decided = tx_orders(spark, sf).withColumn("decision", band())
    return rounded(monitor.period_report(decided, "state", "ts", "decision", "label", "amt"), saved_amount=2)


@query("sla_percentiles", f"""WITH {TX_EVENTS_SQL}, s AS (SELECT *, CASE WHEN EXTRACT(hour FROM ts) BETWEEN 9 AND 17 THEN 'office' ELSE 'off' END AS shift FROM tx),
p AS (SELECT shift, date_trunc('second', ts) AS sec, COUNT(*) AS n FROM s GROUP BY ALL)
SELECT shift, COUNT(*) AS n, (SELECT MAX(n) FROM p WHERE p.shift=s.shift) AS peak_per_second, ROUND(AVG(amt),4) AS mean_latency, ROUND(quantile_cont(amt,0.99),4) AS p99 FROM s GROUP BY shift""")
def sla_percentiles(spark, sf):
    hour = F.hour("ts")
    shift = F.when(hour.between(9, 17), "office").otherwise("off")
    return rounded(monitor.service_levels(tx_events(spark, sf), "amt", "ts", shift), mean_latency=4, p99=4)


@query("canary_compare", f"""WITH {TX_EVENTS_SQL}, v AS (SELECT CASE WHEN ((card % 1000003)*7919) % 100 < 5 THEN 'canary' ELSE 'stable' END AS version, label, score FROM tx),
k AS (SELECT version, COUNT(*) AS n, SUM(CASE WHEN score >= {OP} AND label=1 THEN 1 ELSE 0 END) AS tp, SUM(CASE WHEN score >= {OP} AND label=0 THEN 1 ELSE 0 END) AS fp,
 SUM(CASE WHEN score < {OP} AND label=1 THEN 1 ELSE 0 END) AS fn FROM v GROUP BY version),
f AS (SELECT version, n, CASE WHEN 2*tp+fp+fn > 0 THEN CAST(2*tp AS DOUBLE)/(2*tp+fp+fn) ELSE 0 END AS f1 FROM k)
SELECT version, n, ROUND(f1,6) AS f1, CASE WHEN version='stable' THEN 'baseline' WHEN f1 >= (SELECT f1 FROM f WHERE version='stable') - CAST(0.05 AS DOUBLE) THEN 'promote' ELSE 'rollback' END AS action FROM f""")
def canary_compare(spark, sf):
    out = decide.canary_metrics(tx_events(spark, sf), "card", "label", "score")
    n = (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n")
    return rounded(out.select("version", n, "f1", "action"), f1=6)
