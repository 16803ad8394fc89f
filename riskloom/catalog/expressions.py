"""Checks of the scalar expressions, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.catalog.bindings import TX_EVENTS_SQL, TX_ORDERS_SQL, table, tx_events, tx_orders
from riskloom.catalog.registry import query, rounded
from riskloom.functions import scalar as X
from riskloom.operators import encode, profile, sampling

HOUR, DOW = "CAST(EXTRACT(hour FROM ts) AS BIGINT)", "CAST(EXTRACT(isodow FROM ts) - 1 AS BIGINT)"
NIGHT = f"CASE WHEN {HOUR} >= 22 OR {HOUR} <= 2 THEN 1 ELSE 0 END"
AGE = "CAST(us - epoch_us(CAST(dob AS TIMESTAMP)) AS DOUBLE) / (CAST(1000000 AS DOUBLE)*CAST(86400 AS DOUBLE)*CAST(365.25 AS DOUBLE))"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin(radians({lat2}-{lat1})/2),2)+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2),2)"
    )
    return f"(2*CAST({S.EARTH_RADIUS_KM} AS DOUBLE)*asin(sqrt(CASE WHEN {a} IS NULL THEN NULL ELSE LEAST(CAST(1 AS DOUBLE),GREATEST(CAST(0 AS DOUBLE),{a})) END)))"


HOLDER_KM = haversine_sql("lat", "long", "merch_lat", "merch_long")


def cut_sql(value: str, buckets) -> str:
    return "CASE " + " ".join(f"WHEN {value} > {a} AND {value} <= {b} THEN '{n}'" for a, b, n in buckets) + " END"


def age_group_sql(age: str) -> str:
    return f"CASE WHEN {age} < 30 THEN '<30' WHEN {age} < 50 THEN '30-50' WHEN {age} >= 50 THEN '50+' END"


@query("expr_hour_dow", f"WITH {TX_EVENTS_SQL} SELECT tx_id, {HOUR} AS hour, {DOW} AS dow FROM tx")
def expr_hour_dow(spark, sf):
    return tx_events(spark, sf).select(
        "tx_id", X.hour_of_day(F.col("ts")).cast("bigint").alias("hour"), X.day_of_week(F.col("ts")).cast("bigint").alias("dow")
    )


@query("expr_is_night", f"WITH {TX_EVENTS_SQL} SELECT tx_id, CAST({NIGHT} AS BIGINT) AS is_night FROM tx")
def expr_is_night(spark, sf):
    return tx_events(spark, sf).select("tx_id", X.is_night(X.hour_of_day(F.col("ts"))).cast("bigint").alias("is_night"))


@query("expr_cyclic_hour", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, ROUND(sin(2*pi()*{HOUR}/CAST(24 AS DOUBLE)),6)+0 AS hour_sin, ROUND(cos(2*pi()*{HOUR}/CAST(24 AS DOUBLE)),6)+0 AS hour_cos FROM tx""")
def expr_cyclic_hour(spark, sf):
    sin, cos = X.cyclic_hour(X.hour_of_day(F.col("ts")))
    # "+ 0" turns a rounded negative zero into zero.
    return tx_events(spark, sf).select(
        "tx_id", (F.round(sin, 6) + 0).alias("hour_sin"), (F.round(cos, 6) + 0).alias("hour_cos")
    )


@query("expr_epoch_to_ts", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, strftime(make_timestamp((us // 1000000) * 1000000), '%Y-%m-%d %H:%M:%S') AS ts_text FROM tx""")
def expr_epoch_to_ts(spark, sf):
    seconds = F.floor(F.col("us") / X.MICROS).cast("bigint")
    return tx_events(spark, sf).select(
        "tx_id", F.date_format(X.epoch_to_timestamp(seconds), "yyyy-MM-dd HH:mm:ss").alias("ts_text")
    )


@query("expr_age_years", f"WITH {TX_EVENTS_SQL} SELECT tx_id, ROUND({AGE},6) AS age FROM tx")
def expr_age_years(spark, sf):
    return tx_events(spark, sf).select("tx_id", F.round(X.age_years(F.col("ts"), F.col("dob")), 6).alias("age"))


@query("expr_age_days_floor", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, ROUND(CAST((epoch(ts)::BIGINT - epoch(CAST(dob AS TIMESTAMP))::BIGINT) // 86400 AS DOUBLE)/CAST(365.25 AS DOUBLE),6) AS age
FROM (SELECT tx_id, date_trunc('second', ts) AS ts, dob FROM tx)""")
def expr_age_days_floor(spark, sf):
    return tx_events(spark, sf).select("tx_id", F.round(X.age_whole_days(F.col("ts"), F.col("dob")), 6).alias("age"))


@query("expr_log1p", f"WITH {TX_EVENTS_SQL} SELECT tx_id, ROUND(ln(1+amt),6) AS log1p_amt FROM tx")
def expr_log1p(spark, sf):
    return tx_events(spark, sf).select("tx_id", F.round(F.log1p("amt"), 6).alias("log1p_amt"))


@query("expr_haversine", f"""WITH {TX_ORDERS_SQL}
SELECT tx_id, ROUND({haversine_sql('merch_lat', 'merch_long', 'CASE WHEN label=1 THEN lat END', 'long')},5) AS km FROM tx""")
def expr_haversine(spark, sf):
    known = F.when(F.col("label") == 1, F.col("lat"))
    return tx_orders(spark, sf).select(
        "tx_id", F.round(X.haversine_km(F.col("merch_lat"), F.col("merch_long"), known, F.col("long")), 5).alias("km")
    )


@query("expr_holder_merchant_km", f"WITH {TX_EVENTS_SQL} SELECT tx_id, ROUND({HOLDER_KM},5) AS distance_km FROM tx")
def expr_holder_merchant_km(spark, sf):
    km = X.haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    return tx_events(spark, sf).select("tx_id", F.round(km, 5).alias("distance_km"))


@query("expr_safe_ratio", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, ROUND(CASE WHEN s > 0 THEN amt/(s/CAST(3600 AS DOUBLE)) END,4) AS kmh
FROM (SELECT tx_id, amt, CASE WHEN k = 0 THEN NULL ELSE CAST(k-50 AS DOUBLE) END AS s FROM tx)""")
def expr_safe_ratio(spark, sf):
    seconds = F.when(F.col("k") != 0, (F.col("k") - 50).cast("double"))
    return tx_events(spark, sf).select("tx_id", F.round(X.speed_kmh(F.col("amt"), seconds), 4).alias("kmh"))


@query("expr_cut_right_closed", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, {cut_sql(AGE, S.AGE_BUCKETS)} AS age_bucket, {cut_sql('city_pop', S.POPULATION_BUCKETS)} AS pop_bucket,
  {cut_sql('k', [(0, 25, 'a'), (25, 75, 'b')])} AS k_bucket FROM tx""")
def expr_cut_right_closed(spark, sf):
    return tx_events(spark, sf).select(
        "tx_id",
        X.cut_right_closed(X.age_years(F.col("ts"), F.col("dob")), S.AGE_BUCKETS).alias("age_bucket"),
        X.cut_right_closed(F.col("city_pop"), S.POPULATION_BUCKETS).alias("pop_bucket"),
        X.cut_right_closed(F.col("k"), [(0, 25, "a"), (25, 75, "b")]).alias("k_bucket"),
    )


@query("expr_digitize", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CAST(CASE WHEN k>=75 THEN 3 WHEN k>=50 THEN 2 WHEN k>=25 THEN 1 ELSE 0 END AS BIGINT) AS bin FROM tx""")
def expr_digitize(spark, sf):
    return tx_events(spark, sf).select("tx_id", X.digitize(F.col("k"), [25, 50, 75]).cast("bigint").alias("bin"))


@query("expr_age_group", f"WITH {TX_EVENTS_SQL} SELECT tx_id, {age_group_sql(AGE)} AS age_group FROM tx")
def expr_age_group(spark, sf):
    return tx_events(spark, sf).select("tx_id", X.age_group(X.age_years(F.col("ts"), F.col("dob"))).alias("age_group"))


@query("expr_clip_logit", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, ROUND(ln(p/(1-p)),6) AS z FROM (SELECT tx_id, LEAST(CAST(0.999999 AS DOUBLE), GREATEST(CAST(0.000001 AS DOUBLE), score)) AS p FROM tx)""")
def expr_clip_logit(spark, sf):
    return tx_events(spark, sf).select("tx_id", F.round(X.clip_logit(F.col("score")), 6).alias("z"))


@query("expr_threshold_decision", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CAST(0.6642 AS DOUBLE) AS op_threshold, score >= CAST(0.6642 AS DOUBLE) AS op_fraud,
  CAST(0.52 AS DOUBLE) AS cost_threshold, score >= CAST(0.52 AS DOUBLE) AS cost_fraud FROM tx""")
def expr_threshold_decision(spark, sf):
    return tx_events(spark, sf).select(
        "tx_id", X.decision(F.col("score"), S.OPERATING_THRESHOLD).alias("op"), X.decision(F.col("score"), S.COST_THRESHOLD).alias("cost")
    ).select(
        "tx_id", F.col("op.threshold").alias("op_threshold"), F.col("op.is_fraud").alias("op_fraud"),
        F.col("cost.threshold").alias("cost_threshold"), F.col("cost.is_fraud").alias("cost_fraud"),
    )


@query("expr_lift_vs_base", f"WITH {TX_EVENTS_SQL} SELECT tx_id, ROUND(score/CAST(0.0058 AS DOUBLE),6) AS lift FROM tx")
def expr_lift_vs_base(spark, sf):
    return tx_events(spark, sf).select("tx_id", F.round(X.lift_over_base(F.col("score")), 6).alias("lift"))


@query("expr_minmax_scale_clip", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, ROUND(LEAST(CAST(1 AS DOUBLE),GREATEST(CAST(0 AS DOUBLE),(score-CAST(0.3 AS DOUBLE))/(CAST(0.7 AS DOUBLE)-CAST(0.3 AS DOUBLE)))),6) AS progress FROM tx""")
def expr_minmax_scale_clip(spark, sf):
    return tx_events(spark, sf).select("tx_id", F.round(X.scale_clip(F.col("score")), 6).alias("progress"))


@query("expr_decision_correct", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, (score >= CAST(0.6642 AS DOUBLE)) = (label = 1) AS correct FROM tx""")
def expr_decision_correct(spark, sf):
    flagged = X.decision(F.col("score"), S.OPERATING_THRESHOLD).getField("is_fraud")
    return tx_events(spark, sf).select("tx_id", X.decision_correct(flagged, F.col("label")).alias("correct"))


@query("expr_direction", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CASE WHEN k-50 >= 0 THEN 'increases_fraud' ELSE 'decreases_fraud' END AS direction FROM tx""")
def expr_direction(spark, sf):
    return tx_events(spark, sf).select("tx_id", X.contribution_direction(F.col("k") - 50).alias("direction"))


@query("filter_split", f"""WITH {TX_EVENTS_SQL}, r AS (
SELECT tx_id, amt, row_number() OVER (ORDER BY us, tx_id) AS rn, COUNT(*) OVER () AS n FROM tx)
SELECT tx_id, amt FROM r WHERE rn > CAST(floor(n*CAST(0.7 AS DOUBLE)) AS BIGINT)+CAST(floor(n*CAST(0.15 AS DOUBLE)) AS BIGINT)""")
def filter_split(spark, sf):
    from riskloom.operators.split import temporal_split
    return temporal_split(tx_events(spark, sf), "us", "tx_id").filter(F.col("split") == "test").select("tx_id", "amt")


@query("filter_limit", f"WITH {TX_EVENTS_SQL} SELECT tx_id, amt FROM tx ORDER BY us, tx_id LIMIT 500")
def filter_limit(spark, sf):
    return sampling.first_n(tx_events(spark, sf), [F.col("us"), F.col("tx_id")], 500).select("tx_id", "amt")


@query("expr_decision_band", f"""WITH {TX_EVENTS_SQL}, b AS (
SELECT tx_id, CASE WHEN score < CAST(0.3 AS DOUBLE) THEN 'approve' WHEN score >= CAST(0.85 AS DOUBLE) THEN 'block' ELSE 'pending_review' END AS decision FROM tx)
SELECT tx_id, decision, CASE decision WHEN 'approve' THEN 'auto_approve' WHEN 'block' THEN 'auto_block' ELSE 'manual_review' END AS reason_code FROM b""")
def expr_decision_band(spark, sf):
    return tx_events(spark, sf).select("tx_id", X.decision_band(F.col("score")).alias("decision")).withColumn(
        "reason_code", X.reason_code(F.col("decision"))
    )


@query("expr_degraded_default", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CASE WHEN category='error' THEN 'pending_review' WHEN score < CAST(0.3 AS DOUBLE) THEN 'approve'
 WHEN score >= CAST(0.85 AS DOUBLE) THEN 'block' ELSE 'pending_review' END AS decision FROM tx""")
def expr_degraded_default(spark, sf):
    answered = F.when(F.col("category") != "error", F.col("score"))
    return tx_events(spark, sf).select("tx_id", X.decision_band(answered).alias("decision"))


@query("join_scalar_broadcast", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, CAST(CASE WHEN amt > (SELECT quantile_cont(amt, 0.95) FROM tx WHERE label=0) THEN 1 ELSE 0 END AS BIGINT) AS amt_gt_p95 FROM tx""")
def join_scalar_broadcast(spark, sf):
    tx = tx_events(spark, sf)
    p95 = profile.conditional_quantile(tx, "amt", 0.95, F.col("label") == 0)
    return tx.select("tx_id", (F.col("amt") > F.lit(p95)).cast("bigint").alias("amt_gt_p95"))


@query("join_map_default", f"""WITH {TX_ORDERS_SQL}, m AS (
SELECT merchant, (SUM(label)+20*(SELECT AVG(label) FROM tx WHERE category <> '1-URGENT'))/(COUNT(*)+CAST(20 AS DOUBLE)) AS encoded
FROM tx WHERE category <> '1-URGENT' AND merchant IS NOT NULL GROUP BY merchant)
SELECT tx_id, ROUND(COALESCE(encoded, (SELECT AVG(label) FROM tx WHERE category <> '1-URGENT')),6) AS te
FROM tx LEFT JOIN m ON tx.merchant = m.merchant""")
def join_map_default(spark, sf):
    tx = tx_orders(spark, sf)
    stats = encode.encoding_stats(tx, ["merchant"], "label", "fold", F.col("category") != "1-URGENT")
    mapped = encode.map_default(tx, "merchant", encode.encoding_map(stats, "merchant"), "te", encode.global_mean(stats))
    return rounded(mapped.select("tx_id", "te"), te=6)


@query("scan_parquet_pruned", "SELECT event_id, value FROM events WHERE value > CAST(100 AS DOUBLE)")
def scan_parquet_pruned(spark, sf):
    return table(spark, sf, "events").select("event_id", "value").filter(F.col("value") > 100.0)
