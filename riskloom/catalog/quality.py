"""Checks of ranking, threshold, calibration, segment and cost metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.catalog.bindings import TX_EVENTS_SQL, tx_events
from riskloom.catalog.expressions import AGE, HOUR, age_group_sql
from riskloom.catalog.features import SPLIT_SQL
from riskloom.catalog.registry import as_long, query, rounded
from riskloom.functions import scalar as X
from riskloom.operators import cost, metrics, segments
from riskloom.operators.split import temporal_split

OP = "CAST(0.6642 AS DOUBLE)"


def curve_sql(source: str = "tx", by: str = "") -> str:
    part, lead = (f"PARTITION BY {by} ", f"{by}, ") if by else ("", "")
    return f"""h AS (SELECT {lead}score AS threshold, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS pos FROM {source} GROUP BY ALL),
c AS (SELECT *, SUM(n) OVER ({part}ORDER BY threshold DESC) AS cum_n, SUM(pos) OVER ({part}ORDER BY threshold DESC) AS cum_pos,
  SUM(n) OVER ({part}) AS tot_n, SUM(pos) OVER ({part}) AS tot_pos FROM h)"""


AP = "SUM(pos*(CAST(cum_pos AS DOUBLE)/cum_n))/SUM(pos)"
ROC = "SUM((n-pos)*(cum_pos-pos/CAST(2 AS DOUBLE)))/(CAST(SUM(pos) AS DOUBLE)*SUM(n-pos))"
F1 = "CAST(2 AS DOUBLE)*cum_pos/(cum_n+tot_pos)"
BEST = f"best AS (SELECT threshold, {F1} AS f1 FROM c ORDER BY {F1} DESC, threshold LIMIT 1)"


def confusion_sql(threshold: str, source: str = "tx") -> str:
    return f"""k AS (SELECT CAST(SUM(CASE WHEN score < {threshold} AND label=0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
 CAST(SUM(CASE WHEN score >= {threshold} AND label=0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
 CAST(SUM(CASE WHEN score < {threshold} AND label=1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
 CAST(SUM(CASE WHEN score >= {threshold} AND label=1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM {source})"""


def top_sql(fractions, source: str = "tx", label: str = "label") -> str:
    grid = ",".join(f"(CAST({f} AS DOUBLE))" for f in fractions)
    return f"""r AS (SELECT *, row_number() OVER (ORDER BY score DESC, tx_id) AS rn, COUNT(*) OVER () AS cnt, SUM({label}) OVER () AS p FROM {source}),
q AS (SELECT f.fraction, ANY_VALUE(CAST(GREATEST(1,CEIL(cnt*f.fraction)) AS BIGINT)) AS k, CAST(SUM(CASE WHEN rn <= GREATEST(1,CEIL(cnt*f.fraction)) THEN {label} ELSE 0 END) AS BIGINT) AS hits,
  CAST(ANY_VALUE(p) AS BIGINT) AS n_pos, ANY_VALUE(cnt) AS n FROM r, (VALUES {grid}) f(fraction) GROUP BY f.fraction)"""


@query("agg_confusion", f"WITH {TX_EVENTS_SQL}, {confusion_sql(OP)} SELECT * FROM k")
def agg_confusion(spark, sf):
    return metrics.confusion_at(tx_events(spark, sf), "label", "score", S.OPERATING_THRESHOLD).select("tn", "fp", "fn", "tp")


@query("agg_prf_at_thr", f"""WITH {TX_EVENTS_SQL}, {confusion_sql(OP)}
SELECT ROUND(CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0 END,6) AS precision, ROUND(CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0 END,6) AS recall,
 ROUND(CASE WHEN 2*tp+fp+fn > 0 THEN CAST(2*tp AS DOUBLE)/(2*tp+fp+fn) ELSE 0 END,6) AS f1 FROM k""")
def agg_prf_at_thr(spark, sf):
    out = metrics.confusion_at(tx_events(spark, sf), "label", "score", S.OPERATING_THRESHOLD)
    return rounded(out.select("precision", "recall", "f1"), precision=6, recall=6, f1=6)


@query("agg_brier", f"WITH {TX_EVENTS_SQL} SELECT ROUND(AVG((score-label)*(score-label)),6) AS brier FROM tx")
def agg_brier(spark, sf):
    return rounded(metrics.brier(tx_events(spark, sf), "label", "score"), brier=6)


@query("win_cum_curve", f"WITH {TX_EVENTS_SQL}, {curve_sql()} SELECT ROUND(threshold,9) AS threshold, n, pos, CAST(cum_n AS BIGINT) AS cum_n, CAST(cum_pos AS BIGINT) AS cum_pos FROM c")
def win_cum_curve(spark, sf):
    return rounded(metrics.score_curve(tx_events(spark, sf), "label", "score"), threshold=9)


@query("win_cum_curve_sliced", f"WITH {TX_EVENTS_SQL}, {curve_sql()} SELECT ROUND(threshold,9) AS threshold, n, pos, CAST(cum_n AS BIGINT) AS cum_n, CAST(cum_pos AS BIGINT) AS cum_pos FROM c")
def win_cum_curve_sliced(spark, sf):
    """The many-scores plan, forced by a low limit."""
    return rounded(metrics.score_curve(tx_events(spark, sf), "label", "score", limit=100), threshold=9)


@query("pr_auc", f"WITH {TX_EVENTS_SQL}, {curve_sql()} SELECT CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(pos) AS BIGINT) AS n_pos, ROUND({AP},6) AS pr_auc FROM c")
def pr_auc(spark, sf):
    return rounded(metrics.ranking_summary(tx_events(spark, sf), "label", "score").select("n", "n_pos", "pr_auc"), pr_auc=6)


@query("roc_auc", f"WITH {TX_EVENTS_SQL}, {curve_sql()} SELECT ROUND({ROC},6) AS roc_auc FROM c")
def roc_auc(spark, sf):
    return rounded(metrics.ranking_summary(tx_events(spark, sf), "label", "score").select("roc_auc"), roc_auc=6)


@query("pr_curve", f"WITH {TX_EVENTS_SQL}, {curve_sql()} SELECT ROUND(threshold,9) AS threshold, ROUND(CAST(cum_pos AS DOUBLE)/cum_n,6) AS precision, ROUND(CAST(cum_pos AS DOUBLE)/tot_pos,6) AS recall FROM c")
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(tx_events(spark, sf), "label", "score"), threshold=9, precision=6, recall=6)


@query("roc_curve", f"WITH {TX_EVENTS_SQL}, {curve_sql()} SELECT ROUND(threshold,9) AS threshold, ROUND(CAST(cum_n-cum_pos AS DOUBLE)/(tot_n-tot_pos),6) AS fpr, ROUND(CAST(cum_pos AS DOUBLE)/tot_pos,6) AS tpr FROM c")
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(tx_events(spark, sf), "label", "score"), threshold=9, fpr=6, tpr=6)


@query("best_f1_threshold", f"WITH {TX_EVENTS_SQL}, {curve_sql()}, {BEST} SELECT ROUND(threshold,9) AS threshold, ROUND(f1,6) AS f1 FROM best")
def best_f1_threshold(spark, sf):
    return rounded(metrics.best_f1_threshold(tx_events(spark, sf), "label", "score"), threshold=9, f1=6)


@query("recall_at_frac", f"WITH {TX_EVENTS_SQL}, {top_sql([0.01])} SELECT fraction, k, hits, n_pos, ROUND(CAST(hits AS DOUBLE)/n_pos,6) AS recall FROM q")
def recall_at_frac(spark, sf):
    out = metrics.top_fractions(tx_events(spark, sf), "label", "score", "tx_id", [0.01])
    return rounded(out.select("fraction", "k", "hits", "n_pos", "recall"), recall=6)


@query("lift_at_frac", f"WITH {TX_EVENTS_SQL}, {top_sql([0.01, 0.05, 0.1])} SELECT fraction, k, hits, ROUND((CAST(hits AS DOUBLE)/k)/(CAST(n_pos AS DOUBLE)/n),6) AS lift FROM q")
def lift_at_frac(spark, sf):
    out = metrics.top_fractions(tx_events(spark, sf), "label", "score", "tx_id", S.LIFT_FRACTIONS)
    return rounded(out.select("fraction", "k", "hits", "lift"), lift=6)


def bundle_sql(source: str, threshold_ctes: str, threshold: str, f1: str) -> str:
    return f"""{top_sql([0.01], source)}, {threshold_ctes}
SELECT 'pr_auc' AS metric, ROUND({AP},6) AS value FROM c UNION ALL SELECT 'roc_auc', ROUND({ROC},6) FROM c
UNION ALL SELECT 'recall_at_1pct', ROUND(CAST(hits AS DOUBLE)/n_pos,6) FROM q
UNION ALL SELECT 'f1_at_thr', ROUND({f1},6) UNION ALL SELECT 'threshold', ROUND({threshold},6)"""


@query("metrics_bundle", f"WITH {TX_EVENTS_SQL}, {curve_sql()}, " + bundle_sql("tx", BEST, "(SELECT threshold FROM best)", "(SELECT f1 FROM best)"))
def metrics_bundle(spark, sf):
    return rounded(metrics.metrics_bundle(tx_events(spark, sf), "label", "score", "tx_id"), value=6)


@query("metrics_transfer_threshold", f"""WITH {TX_EVENTS_SQL}, {SPLIT_SQL}, v AS (SELECT tx_id, label, score FROM sp WHERE split='val'), te AS (SELECT tx_id, label, score FROM sp WHERE split='test'),
hv AS (SELECT score AS threshold, COUNT(*) AS n, SUM(label) AS pos FROM v GROUP BY ALL),
cv AS (SELECT threshold, SUM(n) OVER (ORDER BY threshold DESC) AS cum_n, SUM(pos) OVER (ORDER BY threshold DESC) AS cum_pos, SUM(pos) OVER () AS tot_pos FROM hv),
best AS (SELECT threshold FROM cv ORDER BY {F1} DESC, threshold LIMIT 1), {curve_sql('te')}, """ + bundle_sql(
    "te", confusion_sql("(SELECT threshold FROM best)", "te"), "(SELECT threshold FROM best)", "(SELECT CAST(2*tp AS DOUBLE)/(2*tp+fp+fn) FROM k)"))
def metrics_transfer_threshold(spark, sf):
    tx = temporal_split(tx_events(spark, sf), "us", "tx_id")
    chosen = metrics.best_f1_threshold(tx.filter(F.col("split") == "val"), "label", "score").select("threshold").scalar()
    return rounded(metrics.metrics_bundle(tx.filter(F.col("split") == "test"), "label", "score", "tx_id", chosen), value=6)


@query("gate_vs_base_rate", f"""WITH {TX_EVENTS_SQL}, {curve_sql()}
SELECT ROUND({AP},6) AS pr_auc, ROUND(CAST(SUM(pos) AS DOUBLE)/SUM(n),6) AS base_rate, {AP} > 5*CAST(SUM(pos) AS DOUBLE)/SUM(n) AS passed FROM c""")
def gate_vs_base_rate(spark, sf):
    return rounded(metrics.gate_vs_base_rate(tx_events(spark, sf), "label", "score"), pr_auc=6, base_rate=6)


@query("sanity_scored", f"""WITH {TX_EVENTS_SQL}, s AS (SELECT * FROM tx WHERE category <> 'error'), {curve_sql('s')}
SELECT CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(pos) AS BIGINT) AS n_pos, ROUND({AP},6) AS pr_auc, ROUND({ROC},6) AS roc_auc FROM c""")
def sanity_scored(spark, sf):
    # Rows the model did not answer have no score and are left out by the metric.
    partly = tx_events(spark, sf).withColumn("score", F.when(F.col("category") != "error", F.col("score")))
    return rounded(metrics.ranking_summary(partly, "label", "score"), pr_auc=6, roc_auc=6)


SEGMENT_ROWS_SQL = f"""seg AS (
SELECT tx_id, label, score, 'category' AS segment_type, category AS segment FROM tx WHERE category IN (SELECT category FROM tx GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 5)
UNION ALL SELECT tx_id, label, score, 'time_of_day', CASE WHEN {HOUR} >= 22 OR {HOUR} <= 2 THEN 'night' ELSE 'day' END FROM tx
UNION ALL SELECT tx_id, label, score, 'amount_quartile', 'Q' || CAST(1 + CASE WHEN amt >= q[3] THEN 3 WHEN amt >= q[2] THEN 2 WHEN amt >= q[1] THEN 1 ELSE 0 END AS VARCHAR)
  FROM tx, (SELECT quantile_cont(amt,[0.25,0.5,0.75]) AS q FROM tx)
UNION ALL SELECT tx_id, label, score, 'age_group', {age_group_sql(AGE)} FROM tx)"""
SEGMENT_SQL = f"""{SEGMENT_ROWS_SQL}, {curve_sql('seg', 'segment_type, segment')},
a AS (SELECT segment_type, segment, CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(pos) AS BIGINT) AS n_pos, {AP} AS ap FROM c GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY segment_type, segment ORDER BY score DESC, tx_id) AS rn, COUNT(*) OVER (PARTITION BY segment_type, segment) AS cnt FROM seg),
rc AS (SELECT segment_type, segment, CAST(SUM(CASE WHEN rn <= GREATEST(1,CEIL(cnt*CAST(0.01 AS DOUBLE))) THEN label ELSE 0 END) AS DOUBLE)/SUM(label) AS rec FROM rk GROUP BY ALL),
m AS (SELECT segment_type, segment, n, n_pos, CASE WHEN n >= 50 AND n_pos >= 5 THEN ap END AS pr_auc,
 CASE WHEN n >= 50 AND n_pos >= 5 THEN rec END AS recall_at_1pct FROM a JOIN rc USING (segment_type, segment))"""


def event_segments(spark, sf):
    tx = tx_events(spark, sf).withColumns({
        "night": X.is_night(X.hour_of_day(F.col("ts"))), "age": X.age_years(F.col("ts"), F.col("dob")),
    })
    return segments.segment_rows(tx, "category", "night", "amt", "age", ["tx_id", "label", "score"])


@query("segment_metrics", f"WITH {TX_EVENTS_SQL}, {SEGMENT_SQL} SELECT segment_type, segment, n, n_pos, ROUND(pr_auc,6) AS pr_auc, ROUND(recall_at_1pct,6) AS recall_at_1pct FROM m")
def segment_metrics(spark, sf):
    out = segments.segment_metrics(event_segments(spark, sf), "label", "score", "tx_id")
    return rounded(out, pr_auc=6, recall_at_1pct=6)


@query("weak_segments", f"""WITH {TX_EVENTS_SQL}, {SEGMENT_SQL}
SELECT segment_type, segment, n_pos, ROUND(pr_auc,6) AS pr_auc FROM m WHERE pr_auc < (SELECT quantile_cont(pr_auc,0.5) FROM m) - CAST(0.002 AS DOUBLE)""")
def weak_segments(spark, sf):
    # Stand-in scores are unrelated to labels, so the margin is set to where some segments fall.
    found = segments.segment_metrics(event_segments(spark, sf), "label", "score", "tx_id")
    return rounded(segments.weak_segments(found, 0.002).select("segment_type", "segment", "n_pos", "pr_auc"), pr_auc=6)


@query("calibration_curve", f"""WITH {TX_EVENTS_SQL}, e AS (SELECT quantile_cont(score,[0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS q FROM tx),
b AS (SELECT score, label, len(list_filter(q, lambda x: x < score)) AS bin FROM tx, e)
SELECT bin, COUNT(*) AS n, ROUND(AVG(score),6) AS prob_pred, ROUND(AVG(label),6) AS prob_true FROM b GROUP BY bin""")
def calibration_curve(spark, sf):
    out = metrics.calibration_curve(tx_events(spark, sf), "label", "score")
    return rounded(as_long(out, "bin"), prob_pred=6, prob_true=6)


GRID_SQL = "g AS (SELECT CAST(0.05 AS DOUBLE)+i*(CAST(0.05 AS DOUBLE)+CAST(0.01 AS DOUBLE)-CAST(0.05 AS DOUBLE)) AS threshold FROM range(91) t(i))"


def sweep_sql(fp_costs) -> str:
    costs = ",".join(f"(CAST({c} AS DOUBLE))" for c in fp_costs)
    return f"""{GRID_SQL}, w AS (
SELECT fp_cost, threshold, CAST(SUM(CASE WHEN score >= threshold AND label=0 THEN 1 ELSE 0 END) AS BIGINT) AS n_fp,
 CAST(SUM(CASE WHEN score < threshold AND label=1 THEN 1 ELSE 0 END) AS BIGINT) AS n_fn, SUM(CASE WHEN score < threshold AND label=1 THEN amt ELSE 0 END) AS cost_fn
FROM tx, g, (VALUES {costs}) f(fp_cost) GROUP BY ALL)"""


@query("cost_sweep", f"""WITH {TX_EVENTS_SQL}, {sweep_sql([5])}
SELECT ROUND(threshold,6) AS threshold, n_fp, n_fn, ROUND(cost_fn,3) AS cost_fn, ROUND(n_fp*fp_cost+cost_fn,3) AS total_cost FROM w""")
def cost_sweep(spark, sf):
    out = cost.cost_sweep(tx_events(spark, sf), "label", "score", "amt").drop("fp_cost")
    return rounded(as_long(out, "n_fp", "n_fn"), threshold=6, cost_fn=3, total_cost=3)


def optimum_sql(fp_costs) -> str:
    return f"""{sweep_sql(fp_costs)}, o AS (SELECT fp_cost, threshold, n_fp*fp_cost+cost_fn AS total,
 row_number() OVER (PARTITION BY fp_cost ORDER BY n_fp*fp_cost+cost_fn, threshold) AS rn FROM w),
f AS (SELECT SUM(CASE WHEN score >= {OP} AND label=0 THEN 1 ELSE 0 END) AS n_fp, SUM(CASE WHEN score < {OP} AND label=1 THEN amt ELSE 0 END) AS cost_fn FROM tx)
SELECT o.fp_cost, ROUND(o.threshold,6) AS threshold_min_cost, ROUND(total,3) AS cost_at_min, ROUND(f.n_fp*o.fp_cost+f.cost_fn,3) AS cost_at_f1,
 ROUND(f.n_fp*o.fp_cost+f.cost_fn-total,3) AS saved_vs_f1 FROM o, f WHERE rn=1"""


@query("cost_optimum", f"WITH {TX_EVENTS_SQL}, {optimum_sql([5])}")
def cost_optimum(spark, sf):
    out = cost.cost_optimum(tx_events(spark, sf), "label", "score", "amt")
    return rounded(out, threshold_min_cost=6, cost_at_min=3, cost_at_f1=3, saved_vs_f1=3)


@query("cost_sensitivity", f"WITH {TX_EVENTS_SQL}, {optimum_sql([1, 2, 5, 10, 20])}")
def cost_sensitivity(spark, sf):
    out = cost.cost_optimum(tx_events(spark, sf), "label", "score", "amt", fp_costs=(1.0, 2.0, 5.0, 10.0, 20.0))
    return rounded(out, threshold_min_cost=6, cost_at_min=3, cost_at_f1=3, saved_vs_f1=3)


@query("join_threshold_grid", f"""WITH {TX_EVENTS_SQL}, {GRID_SQL}
SELECT ROUND(threshold,6) AS threshold, CAST(COUNT(*) FILTER (WHERE score >= threshold) AS BIGINT) AS n_flagged FROM tx, g GROUP BY threshold""")
def join_threshold_grid(spark, sf):
    out = cost.cost_sweep(tx_events(spark, sf).withColumn("negative", F.lit(0)), "negative", "score", "amt")
    return rounded(out.select("threshold", F.col("n_fp").cast("bigint").alias("n_flagged")), threshold=6)


@query("weight_pos_class", f"""WITH {TX_EVENTS_SQL}, {SPLIT_SQL}
SELECT ROUND(CAST(COUNT(*)-SUM(label) AS DOUBLE)/SUM(label),6) AS pos_weight FROM sp WHERE split='train'""")
def weight_pos_class(spark, sf):
    from riskloom.models.train import positive_weight
    train = temporal_split(tx_events(spark, sf), "us", "tx_id").filter(F.col("split") == "train")
    return rounded(positive_weight(train, "label"), pos_weight=6)
