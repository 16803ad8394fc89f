"""Checks of training, calibration, scoring and explanation on the given orders.

Tree results have no SQL form, so these jobs return the rows they cover with checks computed
from the results (bounds, order, additivity, agreement of two ways), which SQL expects to
hold.  A small model is trained once per session and data set and shared by these jobs.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.catalog.bindings import EVENT_WINDOWS, ORDER_WINDOWS, TX_EVENTS_SQL, TX_ORDERS_SQL, staged_orders, tx_events
from riskloom.catalog.expressions import HOUR
from riskloom.catalog.features import GEO_SQL, OFF_BORDER, rolling_sql
from riskloom.catalog.registry import as_long, once, query, rounded
from riskloom.functions import scalar as X
from riskloom.models import calibrate, explain, score, train
from riskloom.plans.features import build_features
from riskloom.session import materialize, work_dir

# Isotonic fit in closed form: the largest, over block starts, of the smallest block mean.
ISOTONIC_SQL = f"""WITH {TX_EVENTS_SQL}, h AS (
SELECT score, row_number() OVER (ORDER BY score) AS i, SUM(COUNT(*)) OVER (ORDER BY score) AS n, SUM(SUM(label)) OVER (ORDER BY score) AS p FROM tx GROUP BY score),
s AS (SELECT i + 1 AS i, n, p FROM h UNION ALL SELECT 1, 0, 0),
a AS (SELECT s.i AS j, h.i AS k, CAST(h.p - s.p AS DOUBLE)/CAST(h.n - s.n AS DOUBLE) AS mean FROM s JOIN h ON h.i >= s.i),
m AS (SELECT j, k, MIN(mean) OVER (PARTITION BY j ORDER BY k DESC) AS low FROM a),
f AS (SELECT k, MAX(low) AS fitted FROM m GROUP BY k)
SELECT tx_id, ROUND(fitted,6) AS calibrated FROM tx JOIN h USING (score) JOIN f ON f.k = h.i"""

# A small run: parameters of the shared model, and trials and trees of the search.
SMALL_RUN = train.TreeParams(max_depth=4, learning_rate=0.2, max_trees=20)
TRIALS, TRIAL_TREES = 4, 8

SPLIT_SQL = f"""WITH {TX_ORDERS_SQL}, o AS (SELECT *, row_number() OVER (ORDER BY us, tx_id) AS rn, COUNT(*) OVER () AS cnt FROM tx),
p AS (SELECT tx_id, CAST(label AS BIGINT) AS is_fraud, CASE WHEN rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train'
  WHEN rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT)+CAST(floor(cnt*CAST(0.15 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM o)"""
FEATURES_SQL = "(VALUES " + ", ".join(f"('{f}')" for f in S.FEATURE_COLUMNS) + ") f(feature)"
RUN_METRICS = ("pr_auc", "roc_auc", "recall_at_1pct", "f1_at_thr", "threshold")


def curated(spark, sf):
    """The orders' feature table, written once to the shared folder."""
    return once(spark, sf, "curated", lambda: materialize(build_features(
        staged_orders(spark, sf).withColumnRenamed("label", "is_fraud"), ORDER_WINDOWS, X.MICROS), "curated"))


def trained(spark, sf):
    return once(spark, sf, "model", lambda: train.fit_trees(curated(spark, sf), SMALL_RUN))


def scored_split(spark, sf, split):
    return train.raw_scores(curated(spark, sf).filter(F.col("split") == split), trained(spark, sf))


def bundle(spark, sf):
    def make():
        chosen, _ = calibrate.compare_calibrators(scored_split(spark, sf, "val"), scored_split(spark, sf, "test"), S.TARGET, "score_raw")
        return score.Bundle(trained(spark, sf), chosen, "small-1")
    return once(spark, sf, "bundle", make)


@query("train_gbt", f"{SPLIT_SQL} SELECT split, COUNT(*) AS n, CAST(SUM(is_fraud) AS BIGINT) AS n_pos, split = 'train' AS fits FROM p WHERE split <> 'test' GROUP BY split")
def train_gbt(spark, sf):
    """Rows and positives of train and val; on train, average precision must beat the base rate."""
    from riskloom.operators.metrics import ranking_summary
    rows = scored_split(spark, sf, "train").unionByName(scored_split(spark, sf, "val"))
    found = ranking_summary(rows, S.TARGET, "score_raw", by=["split"])
    fits = (F.col("split") == "train") & (F.col("pr_auc") > F.col("n_pos") / F.col("n"))
    return as_long(found.select("split", "n", "n_pos", fits.alias("fits")), "n", "n_pos")


@query("tune_params", f"SELECT i AS trial, true AS within_search, i = 0 AS best_is_largest FROM range({TRIALS}) t(i)")
def tune_params(spark, sf):
    """Each trial's parameters lie in the search; the chosen ones are those of the best trial."""
    best, trials = train.tune_params(curated(spark, sf), trials=TRIALS, fixed=train.TreeParams(max_trees=TRIAL_TREES))
    within = F.col("max_depth").between(4, 10) & F.col("learning_rate").between(0.01, 0.3) & F.col("pr_auc").between(0, 1)
    largest = trials.orderBy(F.desc("pr_auc"), "trial").first()
    chosen = (largest["max_depth"], largest["learning_rate"]) == (best.max_depth, best.learning_rate)
    return trials.select(F.col("trial").cast("bigint").alias("trial"), within.alias("within_search"), ((F.col("trial") == 0) & F.lit(chosen)).alias("best_is_largest"))


@query("topk_importance", f"SELECT feature, true AS not_negative, true AS in_order, CAST(1 AS DOUBLE) AS total FROM {FEATURES_SQL}")
def topk_importance(spark, sf):
    gains = train.feature_importance(trained(spark, sf))
    listed = gains.collect()  # one row per model feature
    in_order = [(-r["gain"], r["feature"]) for r in listed] == sorted((-r["gain"], r["feature"]) for r in listed)
    return gains.select("feature", (F.col("gain") >= 0).alias("not_negative"), F.lit(in_order).alias("in_order"), F.lit(round(sum(r["gain"] for r in listed), 6)).alias("total"))


@query("assemble_features", f"""WITH {TX_ORDERS_SQL}, {GEO_SQL}, roll AS ({rolling_sql(ORDER_WINDOWS, 3)})
SELECT tx_id, CAST(27 AS BIGINT) AS n_features, CAST((s IS NULL)::INT + (km IS NULL)::INT + (kmh IS NULL)::INT
 + {' + '.join(f'(rolling_amt_{x}_{w} IS NULL)::INT' for w in ORDER_WINDOWS for x in ('mean', 'std'))} AS BIGINT) AS n_missing FROM geo JOIN roll USING (tx_id)""")
def assemble_features(spark, sf):
    rows = train.assembler().transform(train.model_input(curated(spark, sf)))
    values = vector_to_array(train.VECTOR)
    missing = F.size(F.filter(values, lambda v: v == train.MISSING))
    return rows.select("tx_id", F.size(values).cast("bigint").alias("n_features"), missing.cast("bigint").alias("n_missing"))


@query("model_roundtrip", f"{SPLIT_SQL} SELECT COUNT(*) AS n, CAST(0 AS DOUBLE) AS max_difference FROM p WHERE split = 'test'")
def model_roundtrip(spark, sf):
    path = work_dir(spark, "bundle")
    first = bundle(spark, sf)
    score.save_bundle(first, path)
    again = score.load_bundle(path)
    test = curated(spark, sf).filter(F.col("split") == "test")
    a = score.score_batch(test, first).select("tx_id", F.col("score_raw").alias("before"))
    b = score.score_batch(test, again).select("tx_id", F.col("score_raw").alias("after"))
    return a.join(b, "tx_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("max_difference")
    )


def decided(name: str, threshold: float, flag: str | None = None):
    """The decision agrees with the raw score and the threshold."""
    return (F.col(flag or name).cast("boolean") == (F.col("score_raw") >= F.lit(threshold))).alias(name)


@query("score_batch", f"{SPLIT_SQL} SELECT tx_id, is_fraud, true AS probabilities, true AS decision_operating, true AS decision_cost FROM p WHERE split = 'test'")
def score_batch(spark, sf):
    test = curated(spark, sf).filter(F.col("split") == "test")
    used = bundle(spark, sf)
    probabilities = F.col("score_raw").between(0, 1) & F.col("score_calibrated").between(0, 1)
    return as_long(score.score_batch(test, used).select(
        "tx_id", S.TARGET, probabilities.alias("probabilities"),
        decided("decision_operating", used.operating_threshold), decided("decision_cost", used.cost_threshold),
    ), S.TARGET)


@query("score_explained", f"{SPLIT_SQL} SELECT tx_id, true AS operating, true AS cost, CAST(5 AS BIGINT) AS n_top, true AS adds_up FROM p WHERE split = 'test'")
def score_explained(spark, sf):
    """Both decisions, and that the strongest contributions do not exceed what all add up to."""
    test = curated(spark, sf).filter(F.col("split") == "test")
    used = bundle(spark, sf)
    out = score.score_explained(test, used)
    full = explain.explain_rows(test, used.model, features=used.features).select("tx_id", "base_value", "contributions").withColumnRenamed("base_value", "_base")
    logit = F.log(F.col("score_raw") / (1 - F.col("score_raw")))
    total = F.aggregate("contributions", F.col("_base"), lambda a, v: a + v)
    strongest = F.abs(F.element_at("top", 1).getField("contribution")) == F.array_max(F.transform("contributions", F.abs))
    return out.join(full, "tx_id").select(
        "tx_id", decided("operating", used.operating_threshold, "decision_operating.is_fraud"),
        decided("cost", used.cost_threshold, "decision_cost.is_fraud"), F.size("top").cast("bigint").alias("n_top"),
        ((F.abs(total - logit) < 1e-6) & (F.col("base_value") == F.col("_base")) & strongest).alias("adds_up"),
    )


@query("calibrate_platt", f"WITH {TX_EVENTS_SQL} SELECT COUNT(*) AS n, CAST(0 AS DOUBLE) AS mean_residual, CAST(0 AS DOUBLE) AS mean_weighted_residual FROM tx")
def calibrate_platt(spark, sf):
    """At the fit, residuals add up to zero, alone and weighted with the score's logit."""
    tx = tx_events(spark, sf)
    fitted = calibrate.fit_platt(tx, "label", "score").apply(tx, "score", "calibrated")
    residual = F.col("calibrated") - F.col("label")
    return fitted.agg(
        F.count(F.lit(1)).alias("n"), F.abs(F.round(F.avg(residual), 4)).alias("mean_residual"),
        F.abs(F.round(F.avg(residual * X.clip_logit(F.col("score"))), 4)).alias("mean_weighted_residual"),
    )


@query("calibrate_isotonic", ISOTONIC_SQL)
def calibrate_isotonic(spark, sf):
    tx = tx_events(spark, sf)
    out = calibrate.fit_isotonic(tx, "label", "score").apply(tx, "score", "calibrated")
    return rounded(out.select("tx_id", "calibrated"), calibrated=6)


@query("calibrator_select", f"""WITH fitted AS ({ISOTONIC_SQL}), {TX_EVENTS_SQL}
SELECT kind, ROUND(AVG((CASE kind WHEN 'raw' THEN score ELSE calibrated END - label)*(CASE kind WHEN 'raw' THEN score ELSE calibrated END - label)), 5) AS brier, true AS least_is_chosen FROM tx JOIN fitted USING (tx_id), (VALUES ('raw'), ('isotonic')) k(kind) GROUP BY kind""")
def calibrator_select(spark, sf):
    """Brier scores of the raw and the isotonic scores; the kind with the least one is chosen."""
    tx = tx_events(spark, sf)
    _, found = calibrate.compare_calibrators(tx, tx, "label", "score")
    val = found.where("split = 'val'")
    least = val.agg(F.min("brier").alias("least")).scalar()
    kept = val.withColumn("_least", least).where("kind <> 'platt'")
    return rounded(kept.select("kind", "brier", (F.col("chosen") == (F.col("brier") == F.col("_least"))).alias("least_is_chosen")), brier=5)


@query("calibrate_apply", ISOTONIC_SQL)
def calibrate_apply(spark, sf):
    path = work_dir(spark, "calibrator")
    tx = tx_events(spark, sf)
    calibrate.save_calibrator(calibrate.fit_isotonic(tx, "label", "score"), path)
    out = calibrate.load_calibrator(path).apply(tx, "score", "calibrated")
    return rounded(out.select("tx_id", "calibrated"), calibrated=6)


@query("explain_rows", f"{SPLIT_SQL} SELECT tx_id, true AS adds_up, CAST({len(S.FEATURE_COLUMNS)} AS BIGINT) AS n_features FROM p WHERE split = 'test'")
def explain_rows(spark, sf):
    test = curated(spark, sf).filter(F.col("split") == "test")
    explained = explain.explain_rows(test, trained(spark, sf))
    logit = F.log(F.col("score_raw") / (1 - F.col("score_raw")))
    total = F.aggregate("contributions", F.col("base_value"), lambda a, v: a + v)
    return explained.join(train.raw_scores(test, trained(spark, sf)).select("tx_id", "score_raw"), "tx_id").select(
        "tx_id", (F.abs(total - logit) < 1e-6).alias("adds_up"), F.size("contributions").cast("bigint").alias("n_features")
    )


@query("topk_contrib_per_row", f"{SPLIT_SQL} SELECT tx_id, CAST(5 AS BIGINT) AS n, true AS in_order, true AS directions FROM p WHERE split = 'test'")
def topk_contrib_per_row(spark, sf):
    test = curated(spark, sf).filter(F.col("split") == "test")
    top = explain.top_contributions(explain.explain_rows(test, trained(spark, sf)))
    sizes = F.transform("top", lambda e: F.abs(e["contribution"]))
    agrees = F.forall("top", lambda e: e["direction"].eqNullSafe(X.contribution_direction(e["contribution"])) & e["feature"].isin(*S.FEATURE_COLUMNS))
    return top.select("tx_id", F.size("top").cast("bigint").alias("n"), (F.sort_array(sizes, asc=False) == sizes).alias("in_order"), agrees.alias("directions"))


@query("agg_mean_abs_contrib", f"SELECT feature, true AS not_negative, true AS agrees FROM {FEATURES_SQL}")
def agg_mean_abs_contrib(spark, sf):
    """One mean per feature, the same as from a sum per position of the contribution arrays."""
    test = curated(spark, sf).filter(F.col("split") == "test")
    explained = materialize(explain.explain_rows(test, trained(spark, sf)), "explained")
    sums = explained.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f) for i, f in enumerate(S.FEATURE_COLUMNS)]).first().asDict()
    other = spark.createDataFrame(list(sums.items()), "feature string, other double")
    found = explain.mean_abs_contribution(explained).join(F.broadcast(other), "feature")
    return found.select("feature", (F.col("mean_abs") >= 0).alias("not_negative"), (F.abs(F.col("mean_abs") - F.col("other")) < 1e-9).alias("agrees"))


@query("run_log", f"SELECT 'small-1' AS run, kind, name, true AS known FROM (VALUES {', '.join(f'({chr(39)}{m}{chr(39)})' for m in RUN_METRICS)}) m(name), (VALUES ('metric_val'), ('metric_test')) k(kind)")
def run_log(spark, sf):
    from riskloom.operators.metrics import metrics_bundle
    path = work_dir(spark, "runs")
    for split in ("val", "test"):
        found = metrics_bundle(scored_split(spark, sf, split), S.TARGET, "score_raw", "tx_id").collect()
        train.append_run_log(spark, path, train.metric_rows("small-1", f"metric_{split}", {r.metric: r.value for r in found}))
    return spark.read.parquet(path).select("run", "kind", "name", (F.col("value").between(0, 1) & F.col("logged_at").isNotNull()).alias("known"))


@query("replay_current_model", f"{SPLIT_SQL} SELECT 'small-0' AS model_version, COUNT(*) AS n, true AS consistent FROM p")
def replay_current_model(spark, sf):
    earlier = score.Bundle(trained(spark, sf), bundle(spark, sf).calibrator, "small-0", operating_threshold=0.5)
    log = score.score_batch(curated(spark, sf), earlier).withColumn("model_version", F.lit("small-0"))
    found = score.replay(log, bundle(spark, sf))
    changed = F.when(F.col("decided") != F.col("now"), F.col("n")).otherwise(0)
    return found.groupBy("model_version").agg(F.sum("n").alias("n"), F.bool_and(F.col("n_changed") == changed).alias("consistent"))


@query("expr_reason_text", f"""WITH {TX_EVENTS_SQL}, c AS (
SELECT tx_id, 'amt' AS feature, amt AS value, amt - 50 AS contribution FROM tx UNION ALL SELECT tx_id, 'k', CAST(k AS DOUBLE), CAST(k - 50 AS DOUBLE) FROM tx
UNION ALL SELECT tx_id, 'score', score, (score - 0.5)*100 FROM tx),
r AS (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY abs(contribution) DESC, feature) AS rn FROM c)
SELECT tx_id, string_agg(CASE feature WHEN 'amt' THEN 'amount is ' || format('{{:,.2f}}', value) WHEN 'k' THEN 'activity index ' || format('{{:,.2f}}', value)
 ELSE 'model score ' || format('{{:,.2f}}', value) END, '; ' ORDER BY rn) AS reasons FROM r WHERE rn <= 2 GROUP BY tx_id""")
def expr_reason_text(spark, sf):
    from riskloom.operators.decide import reason_sentences
    tx = tx_events(spark, sf)
    entries = F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), v.cast("double").alias("value"), c.cast("double").alias("contribution"))
        for f, v, c in (("amt", F.col("amt"), F.col("amt") - 50), ("k", F.col("k"), F.col("k") - 50), ("score", F.col("score"), (F.col("score") - 0.5) * 100))
    ]))
    templates = spark.createDataFrame(
        [("amt", "amount is %s"), ("k", "activity index %s"), ("score", "model score %s")], "feature string, template string"
    )
    return reason_sentences(tx.select("tx_id", entries), "tx_id", templates, top=2)


# Stand-ins for contributions: whole numbers from the row id, so both engines order them alike.
CASE_FEATURES = ("log1p_amt", "rolling_amt_mean_24h", "amt_gt_p95_legit", "hour", "is_night", "hour_sin", "hour_cos")
CASE_STEPS = ((7, 11), (3, 7), (5, 9), (2, 3), (1, 5), (1, 3), (2, 5))


def _case_weight_sql(*features: str) -> str:
    steps = dict(zip(CASE_FEATURES, CASE_STEPS))
    return " + ".join(f"(tx_id*{a} % {m} - {m // 2})" for a, m in (steps[f] for f in features))


@query("expr_reason_case", f"""WITH {TX_EVENTS_SQL},
roll AS (SELECT *, AVG(amt) OVER (PARTITION BY card ORDER BY us RANGE BETWEEN {EVENT_WINDOWS['24h']} PRECEDING AND 1 PRECEDING) + CAST({OFF_BORDER} AS DOUBLE) AS usual FROM tx),
v AS (SELECT tx_id, CASE WHEN usual > 0 THEN amt/usual END AS times, k < 30 AS above, {HOUR} AS hour FROM roll),
said AS (
SELECT tx_id, 0 AS place, {_case_weight_sql("log1p_amt", "rolling_amt_mean_24h")} AS weight, CASE WHEN times >= 2 THEN 'amount ' || format('{{:,.1f}}', times) || ' times the 24 h mean of this card' END AS sentence FROM v
UNION ALL SELECT tx_id, 1, {_case_weight_sql("amt_gt_p95_legit")}, CASE WHEN above THEN 'above the p95 of legitimate transactions' END FROM v
UNION ALL SELECT tx_id, 2, {_case_weight_sql("hour", "is_night", "hour_sin", "hour_cos")}, CASE WHEN hour >= 22 OR hour <= 2 THEN 'at night, when the base rate of fraud is high' END FROM v),
r AS (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY weight DESC, place) AS rn FROM said WHERE weight > 0 AND sentence IS NOT NULL)
SELECT v.tx_id, string_agg(sentence, '; ' ORDER BY rn) AS reasons FROM v LEFT JOIN r ON r.tx_id = v.tx_id AND rn <= 2 GROUP BY v.tx_id""")
def expr_reason_case(spark, sf):
    """Sentences over several features of a case: amount against the card's own mean, ceiling, time of day."""
    from riskloom.operators.decide import case_reasons
    from riskloom.operators.rolling import rolling_past
    rolled = rolling_past(tx_events(spark, sf), "card", "us", "amt", {"24h": EVENT_WINDOWS["24h"]})
    hour = X.hour_of_day(F.col("ts"))
    values = [F.log1p("amt"), F.col("rolling_amt_mean_24h") + F.lit(OFF_BORDER), F.col("k") < 30, hour, X.is_night(hour), *X.cyclic_hour(hour)]
    weights = [F.pmod(F.col("tx_id") * a, F.lit(m)) - m // 2 for a, m in CASE_STEPS]
    explained = rolled.select(
        "tx_id", F.array(*[v.cast("double") for v in values]).alias("values"), F.array(*[w.cast("double") for w in weights]).alias("contributions"))
    return explained.select("tx_id", case_reasons(CASE_FEATURES, top=2).alias("reasons"))
