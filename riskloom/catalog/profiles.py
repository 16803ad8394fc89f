"""Checks of quality reports and exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.catalog.bindings import TX_EVENTS_SQL, TX_ORDERS_SQL, tx_events, tx_orders
from riskloom.catalog.expressions import AGE, DOW, HOLDER_KM, HOUR, cut_sql
from riskloom.catalog.registry import as_long, query, rounded
from riskloom.functions import scalar as X
from riskloom.operators import cost, profile, sampling


def with_age(tx):
    return tx.withColumn("age", X.age_years(F.col("ts"), F.col("dob")))


def with_distance(tx):
    km = X.haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    return tx.withColumn("distance_km", km)


@query("agg_quality_report", f"""WITH {TX_EVENTS_SQL}
SELECT COUNT(*) AS n_rows, CAST(SUM(label) AS BIGINT) AS n_fraud, ROUND(AVG(label),6) AS fraud_rate, MIN(us) AS first_time, MAX(us) AS last_time,
  COUNT(DISTINCT card) AS n_cards FROM tx""")
def agg_quality_report(spark, sf):
    return rounded(profile.quality_report(tx_events(spark, sf), "label", "us", "card"), fraud_rate=6)


@query("agg_null_profile", """
SELECT 'price_if_final' AS column, CAST(SUM(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM orders
UNION ALL SELECT 'urgent_customer', CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END) AS BIGINT) FROM orders""")
def agg_null_profile(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumns({
        "price_if_final": F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")),
        "urgent_customer": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")),
    })
    return profile.null_profile(orders)


@query("agg_class_balance", f"""WITH {TX_EVENTS_SQL}
SELECT CAST(label AS BIGINT) AS label, COUNT(*) AS n,
  ROUND((SELECT CAST(COUNT(*)-SUM(label) AS DOUBLE)/GREATEST(SUM(label),1) FROM tx),6) AS imbalance_ratio FROM tx GROUP BY label""")
def agg_class_balance(spark, sf):
    return rounded(as_long(profile.class_balance(tx_events(spark, sf), "label"), "label"), imbalance_ratio=6)


RATE_KEYS = {
    "hour": HOUR, "dow": DOW, "category": "category", "state": "state", "merchant": "merchant",
    "age_bucket": cut_sql(AGE, S.AGE_BUCKETS), "pop_bucket": cut_sql("city_pop", S.POPULATION_BUCKETS),
}


def rate_sql(keys) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS key, CAST({e} AS VARCHAR) AS value, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_pos, AVG(label) AS rate"
        f" FROM tx WHERE ({e}) IS NOT NULL GROUP BY 2" for k, e in keys.items()
    )


def rate_columns():
    return {
        "hour": X.hour_of_day(F.col("ts")), "dow": X.day_of_week(F.col("ts")), "category": F.col("category"),
        "state": F.col("state"), "merchant": F.col("merchant"),
        "age_bucket": X.cut_right_closed(X.age_years(F.col("ts"), F.col("dob")), S.AGE_BUCKETS),
        "pop_bucket": X.cut_right_closed(F.col("city_pop"), S.POPULATION_BUCKETS),
    }


@query("agg_rate_by_key", f"WITH {TX_ORDERS_SQL}, r AS ({rate_sql(RATE_KEYS)}) SELECT key, value, n, n_pos, ROUND(rate,6) AS rate FROM r")
def agg_rate_by_key(spark, sf):
    return rounded(profile.rate_by_keys(tx_orders(spark, sf), "label", rate_columns()), rate=6)


@query("agg_having_min_count", f"""WITH {TX_ORDERS_SQL}
SELECT 'state' AS key, state AS value, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_pos, ROUND(AVG(label),6) AS rate FROM tx GROUP BY state HAVING COUNT(*) >= 600""")
def agg_having_min_count(spark, sf):
    return rounded(profile.rate_by_keys(tx_orders(spark, sf), "label", {"state": F.col("state")}, min_rows=600), rate=6)


@query("agg_two_level_card", f"""WITH {TX_EVENTS_SQL}, c AS (SELECT card, COUNT(*) AS tx, MAX(label) AS hit FROM tx GROUP BY card)
SELECT COUNT(*) AS n_cards, CAST(SUM(hit) AS BIGINT) AS n_fraud_cards, ROUND(AVG(hit),6) AS fraud_card_share,
  ROUND(quantile_cont(tx,0.5),4) AS tx_median, ROUND(quantile_cont(tx,0.95),4) AS tx_p95, MAX(tx) AS tx_max FROM c""")
def agg_two_level_card(spark, sf):
    return rounded(profile.card_summary(tx_events(spark, sf), "card", "label"), fraud_card_share=6, tx_median=4, tx_p95=4)


QUANTILE_PROBS = {"median": 0.5, "p95": 0.95}


@query("agg_quantiles_by_class", " UNION ALL ".join(
    f"""(WITH {TX_EVENTS_SQL} SELECT '{name}' AS measure, CAST(label AS BIGINT) AS label, COUNT(*) AS n, ROUND(AVG({e}),4) AS mean, ROUND(MAX({e}),4) AS max,
ROUND(quantile_cont({e},0.5),4) AS median, ROUND(quantile_cont({e},0.95),4) AS p95 FROM tx GROUP BY label)"""
    for name, e in {"amt": "amt", "distance_km": HOLDER_KM, "age": AGE}.items()))
def agg_quantiles_by_class(spark, sf):
    tx = with_distance(with_age(tx_events(spark, sf)))
    out = profile.quantiles_by_class(tx, "label", ["amt", "distance_km", "age"], QUANTILE_PROBS)
    return rounded(as_long(out, "label"), mean=4, max=4, median=4, p95=4)


@query("agg_conditional_quantile", f"""WITH {TX_EVENTS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY us, tx_id) AS rn, COUNT(*) OVER () AS cnt FROM tx)
SELECT ROUND(quantile_cont(amt,0.95),4) AS p95, COUNT(*) AS n FROM r WHERE label=0 AND rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT)""")
def agg_conditional_quantile(spark, sf):
    from riskloom.operators.split import temporal_split
    tx = temporal_split(tx_events(spark, sf), "us", "tx_id")
    where = (F.col("split") == "train") & (F.col("label") == 0)
    p95 = profile.conditional_quantile(tx, "amt", 0.95, where)
    return rounded(tx.filter(where).agg(F.count(F.lit(1)).alias("n")).withColumn("p95", F.lit(p95)), p95=4)


BINS = 59
LOG_LOW, LOG_HIGH = "(SELECT ln(GREATEST(MIN(amt),0.5)) FROM tx)", "(SELECT ln(MAX(amt)) FROM tx)"


def histogram_sql(value: str, low: str, high: str, log: bool) -> str:
    v = f"ln({value})" if log else value
    width = "exp(lo+(bin+1)*(hi-lo)/59)-exp(lo+bin*(hi-lo)/59)" if log else "(hi-lo)/59"
    return f"""v AS (SELECT label, {v} AS v, {low} AS lo, {high} AS hi FROM tx),
b AS (SELECT label, lo, hi, CAST(LEAST(floor((v-lo)/(hi-lo)*CAST(59 AS DOUBLE)),58) AS BIGINT) AS bin FROM v WHERE v >= lo AND v <= hi),
c AS (SELECT label, bin, lo, hi, COUNT(*) AS n FROM b GROUP BY ALL)
SELECT CAST(label AS BIGINT) AS label, bin, n, ROUND(n/(SUM(n) OVER (PARTITION BY label)*({width})),6) AS density FROM c"""


@query("agg_histogram", f"WITH {TX_EVENTS_SQL}, {histogram_sql('amt', LOG_LOW, LOG_HIGH, True)}")
def agg_histogram(spark, sf):
    tx = tx_events(spark, sf)
    span = tx.agg(F.greatest(F.min("amt"), F.lit(0.5)).alias("low"), F.max("amt").alias("high")).first()
    out = profile.histogram(tx, "label", "amt", BINS, span.low, span.high, log=True)
    return rounded(as_long(out, "label", "bin"), density=6)


P99 = f"(SELECT GREATEST(quantile_cont({HOLDER_KM},0.99) FILTER (WHERE label=0), quantile_cont({HOLDER_KM},0.99) FILTER (WHERE label=1)) FROM tx)"


@query("agg_histogram_distance", f"WITH {TX_EVENTS_SQL}, {histogram_sql(HOLDER_KM, 'CAST(0 AS DOUBLE)', P99, False)}")
def agg_histogram_distance(spark, sf):
    from riskloom.operators.selection import exact_quantiles
    tx = with_distance(tx_events(spark, sf))
    p99 = max(q[0] for q in exact_quantiles(tx, "distance_km", [0.99], by=["label"]).values())
    out = profile.histogram(tx, "label", "distance_km", BINS, 0.0, p99)
    return rounded(as_long(out, "label", "bin"), density=6)


@query("agg_describe", f"""WITH {TX_EVENTS_SQL}, c AS (SELECT card, COUNT(*) AS tx, SUM(label) AS fraud_tx, MAX(label) AS any_fraud FROM tx GROUP BY card),
l AS (SELECT 'tx' AS "column", CAST(tx AS BIGINT) AS v FROM c UNION ALL SELECT 'fraud_tx', CAST(fraud_tx AS BIGINT) FROM c UNION ALL SELECT 'any_fraud', CAST(any_fraud AS BIGINT) FROM c)
SELECT "column", COUNT(*) AS count, ROUND(AVG(v),5) AS mean, ROUND(stddev_samp(v),5) AS std, CAST(MIN(v) AS DOUBLE) AS min,
 quantile_cont(v,0.25) AS p25, quantile_cont(v,0.5) AS p50, quantile_cont(v,0.75) AS p75, CAST(MAX(v) AS DOUBLE) AS max FROM l GROUP BY ALL""")
def agg_describe(spark, sf):
    return rounded(profile.card_describe(tx_events(spark, sf), "card", "label"), mean=5, std=5)


@query("agg_age_box", f"""WITH {TX_EVENTS_SQL}
SELECT CAST(label AS BIGINT) AS label, ROUND(quantile_cont({AGE},0.25),5) AS p25, ROUND(quantile_cont({AGE},0.5),5) AS p50, ROUND(quantile_cont({AGE},0.75),5) AS p75 FROM tx GROUP BY label""")
def agg_age_box(spark, sf):
    probabilities = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    out = profile.quantiles_by_class(with_age(tx_events(spark, sf)), "label", ["age"], probabilities)
    return rounded(as_long(out, "label").select("label", *probabilities), p25=5, p50=5, p75=5)


@query("agg_rate_spread", f"""WITH {TX_ORDERS_SQL}, r AS ({rate_sql({k: RATE_KEYS[k] for k in ('merchant', 'pop_bucket', 'state')})})
SELECT key, COUNT(*) AS n_groups, ROUND(MAX(rate),6) AS max_rate, ROUND(MIN(rate),6) AS min_rate,
  ROUND(CASE WHEN MIN(rate) > 0 THEN MAX(rate)/MIN(rate) END,5) AS max_over_min,
  ROUND(MAX(rate)/GREATEST(MIN(CASE WHEN rate > 0 THEN rate END),CAST(1e-9 AS DOUBLE)),5) AS max_over_lowest_nonzero,
  CAST(SUM(CASE WHEN rate = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero_groups FROM r GROUP BY key""")
def agg_rate_spread(spark, sf):
    keys = {k: c for k, c in rate_columns().items() if k in ("merchant", "pop_bucket", "state")}
    out = profile.rate_spread(profile.rate_by_keys(tx_orders(spark, sf), "label", keys))
    return rounded(out, max_rate=6, min_rate=6, max_over_min=5, max_over_lowest_nonzero=5)


@query("topk_groups", f"""WITH {TX_ORDERS_SQL}, r AS ({rate_sql({'merchant': 'merchant'})})
SELECT * FROM (SELECT value, n, ROUND(rate,6) AS rate, 'top' AS side FROM r ORDER BY r.rate DESC, value LIMIT 20)
UNION ALL SELECT * FROM (SELECT value, n, ROUND(rate,6) AS rate, 'bottom' AS side FROM r WHERE r.rate > 0 ORDER BY r.rate, value LIMIT 20)""")
def topk_groups(spark, sf):
    rates = profile.rate_by_keys(tx_orders(spark, sf), "label", {"merchant": F.col("merchant")})
    return rounded(profile.extreme_groups(rates, 20).select("value", "n", "rate", "side"), rate=6)


@query("topk_groups_volume", f"WITH {TX_EVENTS_SQL} SELECT category, COUNT(*) AS n FROM tx GROUP BY category ORDER BY n DESC, category LIMIT 5")
def topk_groups_volume(spark, sf):
    return profile.top_by_volume(tx_events(spark, sf), "category", 5)


HASH_SQL = "((((tx_id % 2147483647)*48271 + 42*7919) % 2147483647)*69621) % 2147483647"


@query("sample_fixed_n", f"WITH {TX_EVENTS_SQL} SELECT tx_id, amt FROM tx ORDER BY {HASH_SQL}, tx_id LIMIT 500")
def sample_fixed_n(spark, sf):
    return sampling.sample_n(tx_events(spark, sf), "tx_id", 500).select("tx_id", "amt")


@query("sample_stratified_n", f"""WITH {TX_EVENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL}, tx_id) AS rn FROM tx)
SELECT tx_id, CAST(label AS BIGINT) AS label FROM r WHERE rn <= CASE label WHEN 1 THEN 50 ELSE 200 END""")
def sample_stratified_n(spark, sf):
    out = sampling.sample_per_class(tx_events(spark, sf), "tx_id", "label", {1: 50, 0: 200})
    return as_long(out.select("tx_id", "label"), "label")


@query("sample_one_of_class", f"""WITH {TX_EVENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL}, tx_id) AS rn FROM tx)
SELECT tx_id, CAST(label AS BIGINT) AS label FROM r WHERE rn = 1""")
def sample_one_of_class(spark, sf):
    tx = tx_events(spark, sf).select("tx_id", "label")
    both = sampling.sample_one(tx, "tx_id", "label", 1).unionByName(sampling.sample_one(tx, "tx_id", "label", 0))
    return as_long(both, "label")


@query("topk_convincing_cases", f"""WITH {TX_EVENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, tx_id) AS rank FROM tx)
SELECT tx_id, CAST(label AS BIGINT) AS label, ROUND(score,6) AS score, rank FROM r WHERE rank <= 3""")
def topk_convincing_cases(spark, sf):
    out = sampling.top_per_group(tx_events(spark, sf), "label", [F.col("score").desc(), F.col("tx_id")], 3)
    return rounded(as_long(out.select("tx_id", "label", "score", "rank"), "label", "rank"), score=6)


@query("agg_value_extrapolation", f"""WITH {TX_EVENTS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY us, tx_id) AS rn, COUNT(*) OVER () AS cnt FROM tx),
s AS (SELECT *, CASE WHEN rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train'
  WHEN rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT)+CAST(floor(cnt*CAST(0.15 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM r),
g AS (SELECT CAST(0.05 AS DOUBLE)+i*(CAST(0.05 AS DOUBLE)+CAST(0.01 AS DOUBLE)-CAST(0.05 AS DOUBLE)) AS thr FROM range(91) t(i) UNION ALL SELECT CAST(0.6642 AS DOUBLE)),
c AS (SELECT thr, SUM(CASE WHEN score >= thr AND label=0 THEN 5 ELSE 0 END)+SUM(CASE WHEN score < thr AND label=1 THEN amt ELSE 0 END) AS cost FROM s, g WHERE split='val' GROUP BY thr),
m AS (SELECT (SELECT cost FROM c WHERE thr=CAST(0.6642 AS DOUBLE)) - (SELECT MIN(cost) FROM c WHERE thr<>CAST(0.6642 AS DOUBLE)) AS saved),
z AS (SELECT COUNT(*) FILTER (WHERE split='val') AS n_val, COUNT(*) FILTER (WHERE split='test') AS n_test,
  (MAX(us) FILTER (WHERE split='test') - MIN(us) FILTER (WHERE split='test'))/(CAST(86400000000 AS DOUBLE)*CAST(365.25 AS DOUBLE)/12) AS test_months FROM s)
SELECT ROUND(saved,3) AS saved_vs_f1, n_val, n_test, ROUND(test_months,6) AS test_months, ROUND(n_test/test_months,3) AS monthly_volume,
  ROUND(saved*(CAST(n_test AS DOUBLE)/n_val)/test_months,3) AS monthly_savings FROM m, z""")
def agg_value_extrapolation(spark, sf):
    from riskloom.operators.split import temporal_split
    tx = temporal_split(tx_events(spark, sf), "us", "tx_id")
    val, test = F.col("split") == "val", F.col("split") == "test"
    month = 86_400_000_000.0 * 365.25 / 12
    sizes = tx.agg(
        F.sum(val.cast("bigint")).alias("n_val"), F.sum(test.cast("bigint")).alias("n_test"),
        ((F.max(F.when(test, F.col("us"))) - F.min(F.when(test, F.col("us")))) / F.lit(month)).alias("test_months"),
    )
    saved = cost.cost_optimum(tx.filter(val), "label", "score", "amt")
    out = cost.value_extrapolation(saved, sizes)
    return rounded(out, saved_vs_f1=3, test_months=6, monthly_volume=3, monthly_savings=3)
