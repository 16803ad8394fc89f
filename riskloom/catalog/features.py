"""Checks of card windows, the time split and target encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.catalog.bindings import DAY_MICROS, EVENT_WINDOWS, ORDER_WINDOWS, TX_EVENTS_SQL, TX_ORDERS_SQL, staged_orders, tx_events, tx_orders
from riskloom.catalog.expressions import AGE, DOW, HOUR, NIGHT, haversine_sql
from riskloom.catalog.registry import as_long, query, rounded
from riskloom.functions import scalar as X
from riskloom.operators import encode, ordered, rolling
from riskloom.operators.split import temporal_split
from riskloom.plans.features import build_features


def card_order():
    return [F.col("us"), F.col("tx_id")]


# Means of whole cents over 8, 16, ... rows sit exactly on a rounding border, where engines
# may go either way; both sides are moved off it by the same small amount.
OFF_BORDER = 0.0000031


def rolling_sql(windows, round_to: int = 4) -> str:
    cols, specs = [], []
    for label, width in windows.items():
        w = f"w_{label}"
        specs.append(f"{w} AS (PARTITION BY card ORDER BY us RANGE BETWEEN {width} PRECEDING AND 1 PRECEDING)")
        cols += [
            f"COUNT(amt) OVER {w} AS rolling_count_{label}",
            f"ROUND(COALESCE(SUM(amt) OVER {w},0),{round_to}) AS rolling_amt_sum_{label}",
            f"ROUND(AVG(amt) OVER {w} + CAST({OFF_BORDER} AS DOUBLE),{round_to}) AS rolling_amt_mean_{label}",
            f"ROUND(STDDEV_SAMP(amt) OVER {w},{round_to}) AS rolling_amt_std_{label}",
        ]
    return f"SELECT tx_id, {', '.join(cols)} FROM tx WINDOW {', '.join(specs)}"


def off_border(df, windows):
    return df.withColumns({f"rolling_amt_mean_{w}": F.col(f"rolling_amt_mean_{w}") + F.lit(OFF_BORDER) for w in windows})


def rolled(df, windows, digits: int = 4, **limit):
    out = off_border(rolling.rolling_past(df, "card", "us", "amt", windows, **limit), windows)
    names = [n for label in windows for n in rolling.statistic_names(label).values()]
    out = out.select("tx_id", *names)
    return rounded(out, **{n: digits for n in names if "_count_" not in n})


SPLIT_SQL = """sp AS (
SELECT *, CASE WHEN rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train'
 WHEN rn <= CAST(floor(cnt*CAST(0.7 AS DOUBLE)) AS BIGINT)+CAST(floor(cnt*CAST(0.15 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY us, tx_id) AS rn, COUNT(*) OVER () AS cnt FROM tx))"""


def encoded_sql(column: str) -> str:
    """Encoding of one column from the split rows ``sp``, per-fold query form."""
    return f"""te_{column} AS (
SELECT sp.tx_id, CASE WHEN n > 0 THEN (pos + 20*gm)/(n + CAST(20 AS DOUBLE)) ELSE gm END AS te
FROM (SELECT a.tx_id, (SELECT AVG(label) FROM sp WHERE split='train') AS gm,
  COALESCE(t.n,0) - CASE WHEN a.split='train' THEN COALESCE(f.n,0) ELSE 0 END AS n,
  COALESCE(t.pos,0) - CASE WHEN a.split='train' THEN COALESCE(f.pos,0) ELSE 0 END AS pos
  FROM sp a
  LEFT JOIN (SELECT {column} AS v, COUNT(*) AS n, SUM(label) AS pos FROM sp WHERE split='train' GROUP BY 1) t ON a.{column}=t.v
  LEFT JOIN (SELECT {column} AS v, fold, COUNT(*) AS n, SUM(label) AS pos FROM sp WHERE split='train' GROUP BY 1,2) f ON a.{column}=f.v AND a.fold=f.fold
) sp)"""


@query("win_rolling_past_24h", f"WITH {TX_EVENTS_SQL} {rolling_sql({'24h': DAY_MICROS})}")
def win_rolling_past_24h(spark, sf):
    return rolled(tx_events(spark, sf), {"24h": DAY_MICROS})


@query("win_rolling_past", f"WITH {TX_EVENTS_SQL} {rolling_sql(EVENT_WINDOWS)}")
def win_rolling_past(spark, sf):
    return rolled(tx_events(spark, sf), EVENT_WINDOWS)


@query("win_rolling_past_dense", f"WITH {TX_EVENTS_SQL} {rolling_sql(EVENT_WINDOWS)}")
def win_rolling_past_dense(spark, sf):
    """The plan for cards with too many rows for one task, forced by a low limit."""
    return rolled(tx_events(spark, sf), EVENT_WINDOWS, limit=50)


@query("win_rolling_past_ties", f"WITH {TX_ORDERS_SQL} {rolling_sql(ORDER_WINDOWS, 3)}")
def win_rolling_past_ties(spark, sf):
    return rolled(tx_orders(spark, sf), ORDER_WINDOWS, 3)


@query("win_prev_row", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, ROUND(lag(merch_lat) OVER w,4) AS prev_lat, ROUND(lag(merch_long) OVER w,4) AS prev_long FROM tx WINDOW w AS (PARTITION BY card ORDER BY us, tx_id)""")
def win_prev_row(spark, sf):
    out = ordered.previous_row(tx_events(spark, sf), ["card"], card_order(), {"merch_lat": "prev_lat", "merch_long": "prev_long"})
    return rounded(out.select("tx_id", "prev_lat", "prev_long"), prev_lat=4, prev_long=4)


@query("win_time_delta", f"""WITH {TX_ORDERS_SQL}
SELECT tx_id, CAST(us - lag(us) OVER (PARTITION BY card ORDER BY us, tx_id) AS BIGINT)//1000000 AS seconds FROM tx""")
def win_time_delta(spark, sf):
    out = ordered.previous_row(tx_orders(spark, sf), ["card"], card_order(), {"us": "prev"})
    return out.select("tx_id", F.floor((F.col("us") - F.col("prev")) / X.MICROS).cast("bigint").alias("seconds"))


GEO_SQL = f"""geo AS (SELECT tx_id, km, s, CASE WHEN s > 0 THEN km/(s/CAST(3600 AS DOUBLE)) END AS kmh FROM (
SELECT tx_id, {haversine_sql('merch_lat', 'merch_long', 'plat', 'plon')} AS km, CAST(us-pus AS DOUBLE)/CAST(1000000 AS DOUBLE) AS s
FROM (SELECT *, lag(merch_lat) OVER w AS plat, lag(merch_long) OVER w AS plon, lag(us) OVER w AS pus FROM tx WINDOW w AS (PARTITION BY card ORDER BY us, tx_id))))"""


GEO_CHECK = f"""WITH {TX_EVENTS_SQL}, {GEO_SQL}
SELECT tx_id, ROUND(km,4) AS dist_consecutive_km, ROUND(s,6) AS time_since_last_tx, ROUND(kmh,3) AS velocity_kmh FROM geo"""


def moved(spark, sf, **limit):
    out = rolling.consecutive_features(tx_events(spark, sf), "card", "us", "tx_id", "merch_lat", "merch_long", X.MICROS, **limit)
    out = out.select("tx_id", "dist_consecutive_km", "time_since_last_tx", "velocity_kmh")
    return rounded(out, dist_consecutive_km=4, time_since_last_tx=6, velocity_kmh=3)


@query("win_consecutive_geo", GEO_CHECK)
def win_consecutive_geo(spark, sf):
    return moved(spark, sf)


@query("win_consecutive_geo_dense", GEO_CHECK)
def win_consecutive_geo_dense(spark, sf):
    """The sliced plan, forced by a low limit."""
    return moved(spark, sf, limit=50)


@query("win_global_split", f"WITH {TX_ORDERS_SQL}, {SPLIT_SQL} SELECT tx_id, split FROM sp")
def win_global_split(spark, sf):
    return temporal_split(staged_orders(spark, sf), "us", "tx_id").select("tx_id", "split")


@query("sort_card_time", f"WITH {TX_ORDERS_SQL} SELECT tx_id, row_number() OVER (PARTITION BY card ORDER BY us, tx_id) AS position FROM tx")
def sort_card_time(spark, sf):
    return ordered.global_rank(tx_orders(spark, sf), ["card"], card_order(), "position").select("tx_id", "position")


@query("sort_time", f"WITH {TX_ORDERS_SQL} SELECT tx_id, row_number() OVER (ORDER BY us, tx_id) AS position FROM tx")
def sort_time(spark, sf):
    return ordered.global_rank(tx_orders(spark, sf), [], card_order(), "position", limit=10_000).select("tx_id", "position")


@query("win_recent_history", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, array_to_string(list(CAST(ROUND(amt*100) AS BIGINT)) OVER (PARTITION BY card ORDER BY us, tx_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS recent_cents FROM tx""")
def win_recent_history(spark, sf):
    cents = tx_events(spark, sf).withColumn("cents", F.round(F.col("amt") * 100).cast("bigint"))
    out = ordered.recent_values(cents, ["card"], card_order(), "cents", 5)
    return out.select("tx_id", F.array_join(F.col("recent").cast("array<string>"), ",").alias("recent_cents"))


@query("win_rate_limit", f"""WITH {TX_EVENTS_SQL}
SELECT tx_id, COUNT(*) OVER w + 1 AS n_in_window, COUNT(*) OVER w + 1 > 2 AS limited FROM tx
WINDOW w AS (PARTITION BY card ORDER BY us RANGE BETWEEN {DAY_MICROS // 4} PRECEDING AND 1 PRECEDING)""")
def win_rate_limit(spark, sf):
    from riskloom.operators.decide import rate_limited
    return rate_limited(tx_events(spark, sf), "card", "us", DAY_MICROS // 4, 2).select("tx_id", "n_in_window", "limited")


@query("win_first_seen", f"""WITH {TX_ORDERS_SQL}
SELECT tx_id, row_number() OVER (PARTITION BY card, category ORDER BY us, tx_id) = 1 AS first_in_category,
  ROUND(amt / AVG(amt) OVER (PARTITION BY merchant ORDER BY us, tx_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),4) AS amt_vs_merchant FROM tx""")
def win_first_seen(spark, sf):
    from riskloom.operators.decide import amount_vs_past_mean, first_seen
    tx = tx_orders(spark, sf)
    flagged = first_seen(tx, ["card", "category"], "us", "tx_id", "first_in_category")
    out = amount_vs_past_mean(flagged, "merchant", "amt", card_order(), "amt_vs_merchant")
    return rounded(out.select("tx_id", "first_in_category", "amt_vs_merchant"), amt_vs_merchant=4)


@query("te_map_full", f"""WITH {TX_ORDERS_SQL}, {SPLIT_SQL}
SELECT category AS value, COUNT(*) AS n, ROUND((SUM(label)+20*(SELECT AVG(label) FROM sp WHERE split='train'))/(COUNT(*)+CAST(20 AS DOUBLE)),6) AS encoded
FROM sp WHERE split='train' GROUP BY category""")
def te_map_full(spark, sf):
    tx = temporal_split(staged_orders(spark, sf), "us", "tx_id")
    stats = encode.encoding_stats(tx, ["category"], "label", "fold", F.col("split") == "train")
    return rounded(encode.encoding_map(stats, "category").select("value", "n", "encoded"), encoded=6)


@query("te_kfold_oof", f"""WITH {TX_ORDERS_SQL}, {SPLIT_SQL}, {encoded_sql('category')}
SELECT tx_id, ROUND(te,6) AS te_category FROM te_category""")
def te_kfold_oof(spark, sf):
    tx = temporal_split(staged_orders(spark, sf), "us", "tx_id")
    out = encode.target_encode(tx, ["category"], "label", "fold", F.col("split") == "train")
    return rounded(out.select("tx_id", "te_category"), te_category=6)


TE_SQL = ", ".join(encoded_sql(c) for c in S.ENCODED_COLUMNS)


@query("te_multi", f"""WITH {TX_ORDERS_SQL}, {SPLIT_SQL}, {TE_SQL}
SELECT tx_id, ROUND(m.te,6) AS te_merchant, ROUND(c.te,6) AS te_category, ROUND(s.te,6) AS te_state, ROUND(j.te,6) AS te_job
FROM te_merchant m JOIN te_category c USING (tx_id) JOIN te_state s USING (tx_id) JOIN te_job j USING (tx_id)""")
def te_multi(spark, sf):
    tx = temporal_split(staged_orders(spark, sf), "us", "tx_id")
    names = [f"te_{c}" for c in S.ENCODED_COLUMNS]
    out = encode.target_encode(tx, S.ENCODED_COLUMNS, "label", "fold", F.col("split") == "train").select("tx_id", *names)
    return rounded(out, **{n: 6 for n in names})


@query("proj_select_features", f"""WITH {TX_ORDERS_SQL}, {SPLIT_SQL}, {TE_SQL}, {GEO_SQL}, roll AS ({rolling_sql(ORDER_WINDOWS, 3)})
SELECT tx.tx_id, ROUND(ln(1+amt),5) AS log1p_amt,
  CAST(CASE WHEN amt > (SELECT quantile_cont(amt,0.95) FROM sp WHERE split='train' AND label=0) THEN 1 ELSE 0 END AS BIGINT) AS amt_gt_p95_legit,
  {HOUR} AS hour, {DOW} AS dow, CAST({NIGHT} AS BIGINT) AS is_night,
  ROUND(sin(2*pi()*{HOUR}/CAST(24 AS DOUBLE)),5)+0 AS hour_sin, ROUND(cos(2*pi()*{HOUR}/CAST(24 AS DOUBLE)),5)+0 AS hour_cos,
  ROUND({AGE},5) AS age, ROUND(s,6) AS time_since_last_tx, ROUND(km,4) AS dist_consecutive_km, ROUND(kmh,3) AS velocity_kmh,
  {', '.join(f'rolling_{x}_{w}' for w in ORDER_WINDOWS for x in ('count', 'amt_sum', 'amt_mean', 'amt_std'))},
  ROUND(tm.te,6) AS te_merchant, ROUND(tc.te,6) AS te_category, ROUND(ts_.te,6) AS te_state, ROUND(tj.te,6) AS te_job,
  CAST(tx.label AS BIGINT) AS is_fraud, sp.split
FROM tx JOIN geo USING (tx_id) JOIN roll USING (tx_id) JOIN (SELECT tx_id, split FROM sp) sp USING (tx_id)
JOIN te_merchant tm USING (tx_id) JOIN te_category tc USING (tx_id) JOIN te_state ts_ USING (tx_id) JOIN te_job tj USING (tx_id)""")
def proj_select_features(spark, sf):
    out = build_features(
        staged_orders(spark, sf).withColumnRenamed("label", "is_fraud"), windows=ORDER_WINDOWS, ticks_per_second=X.MICROS, narrow=False
    )
    longs = ["amt_gt_p95_legit", "hour", "dow", "is_night", "is_fraud"] + [f"rolling_count_{w}" for w in ORDER_WINDOWS]
    digits = {"log1p_amt": 5, "hour_sin": 5, "hour_cos": 5, "age": 5, "time_since_last_tx": 6, "dist_consecutive_km": 4, "velocity_kmh": 3}
    digits |= {f"rolling_amt_{x}_{w}": 3 for x in ("sum", "mean", "std") for w in ORDER_WINDOWS}
    digits |= {f"te_{c}": 6 for c in S.ENCODED_COLUMNS}
    out = rounded(as_long(off_border(out, ORDER_WINDOWS), *longs), **digits)
    return out.withColumns({"hour_sin": F.col("hour_sin") + 0, "hour_cos": F.col("hour_cos") + 0})
