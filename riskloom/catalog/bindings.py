"""Transaction views over the given tables, in Spark and as SQL text for the checks.

The given tables hold no labels, scores or coordinates: those are arithmetic stand-ins on
the row id, so the values carry no meaning and only agreement between engines counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.registry import once
from riskloom.functions import scalar as X
from riskloom.session import materialize

DAY_MICROS = 86_400 * X.MICROS
EVENT_WINDOWS = {"1h": 3_600 * X.MICROS, "24h": DAY_MICROS, "7d": 7 * DAY_MICROS}
ORDER_WINDOWS = {"1h": 30 * DAY_MICROS, "24h": 90 * DAY_MICROS, "7d": 365 * DAY_MICROS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stand_ins(id_column: str, card_column: str) -> dict:
    tx, card = F.col(id_column), F.col(card_column)

    def step(multiplier: int, modulus: int):
        return F.pmod(tx * F.lit(multiplier), F.lit(modulus)).cast("double")

    return {
        "score": step(6047, 1009) / F.lit(1009.0),
        "label_rare": (F.pmod(tx * F.lit(7919), F.lit(173)) == 0).cast("int"),
        "merch_lat": F.lit(30.0) + step(37, 200) / F.lit(10.0),
        "merch_long": F.lit(-120.0) + step(53, 500) / F.lit(10.0),
        "lat": F.lit(30.0) + F.pmod(card * F.lit(17), F.lit(200)).cast("double") / F.lit(10.0),
        "long": F.lit(-120.0) + F.pmod(card * F.lit(29), F.lit(500)).cast("double") / F.lit(10.0),
        "city_pop": (F.pmod(card * F.lit(48271), F.lit(2_000_000)) + 1).cast("int"),
        "dob": F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(card * F.lit(131), F.lit(18000)).cast("int")),
        "fold": X.fold_of(tx),
    }


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-day transactions: one per event, the user as card, the value as amount."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    base = e.select(
        F.col("event_id").alias("tx_id"), F.col("user_id").alias("card"), F.col("ts").cast("timestamp").alias("ts"),
        X.epoch_micros(F.col("ts")).alias("us"), F.col("value").alias("amt"), F.col("event_type").alias("category"),
        k.alias("k"), (k < 10).cast("int").alias("label"),
    )
    return base.withColumns(_stand_ins("tx_id", "card"))


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-granular transactions with ties and all four categoricals.

    The merchant is the order's smallest supplier key; the order lines are reduced to one
    row per order before the join.
    """
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    merchant = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("merchant"))
    base = (
        o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
        .join(merchant, o.o_orderkey == merchant.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("tx_id"), F.col("o_custkey").alias("card"), F.col("o_orderdate").cast("timestamp").alias("ts"),
            X.epoch_micros(F.col("o_orderdate")).alias("us"), F.col("o_totalprice").alias("amt"),
            F.col("o_orderpriority").alias("category"), F.col("c_mktsegment").alias("job"), F.col("n_name").alias("state"),
            F.col("merchant").cast("string").alias("merchant"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        )
    )
    return base.withColumns(_stand_ins("tx_id", "card"))


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order transactions as a staging table in the shared folder.

    Feature plans scan their input several times (split borders, amount ceiling, encodings),
    one or two columns each; over a written table those scans read only these columns.
    """
    return once(spark, sf_dir, "staged_orders", lambda: materialize(tx_orders(spark, sf_dir), "staging"))


def _stand_ins_sql(tx: str, card: str) -> str:
    return f"""
  CAST(({tx}*6047) % 1009 AS DOUBLE)/CAST(1009 AS DOUBLE) AS score,
  CASE WHEN ({tx}*7919) % 173 = 0 THEN 1 ELSE 0 END AS label_rare,
  CAST(30 AS DOUBLE)+CAST(({tx}*37) % 200 AS DOUBLE)/CAST(10 AS DOUBLE) AS merch_lat,
  CAST(-120 AS DOUBLE)+CAST(({tx}*53) % 500 AS DOUBLE)/CAST(10 AS DOUBLE) AS merch_long,
  CAST(30 AS DOUBLE)+CAST(({card}*17) % 200 AS DOUBLE)/CAST(10 AS DOUBLE) AS lat,
  CAST(-120 AS DOUBLE)+CAST(({card}*29) % 500 AS DOUBLE)/CAST(10 AS DOUBLE) AS long,
  CAST(({card}*48271) % 2000000 + 1 AS INT) AS city_pop,
  DATE '1950-01-01' + CAST(({card}*131) % 18000 AS INT) AS dob,
  CAST((({tx}*2654435761) % 4294967296) % 5 AS INT) AS fold"""


TX_EVENTS_SQL = f"""tx AS (
SELECT event_id AS tx_id, user_id AS card, ts, epoch_us(ts) AS us, value AS amt, event_type AS category,
  CAST(regexp_extract(props,'([0-9]+)',1) AS INT) AS k,
  CASE WHEN CAST(regexp_extract(props,'([0-9]+)',1) AS INT) < 10 THEN 1 ELSE 0 END AS label,{_stand_ins_sql('event_id', 'user_id')}
FROM events)"""

TX_ORDERS_SQL = f"""tx AS (
SELECT o_orderkey AS tx_id, o_custkey AS card, o_orderdate AS ts, epoch_us(o_orderdate) AS us, o_totalprice AS amt,
  o_orderpriority AS category, c_mktsegment AS job, n_name AS state, CAST(m.merchant AS VARCHAR) AS merchant,
  CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS label,{_stand_ins_sql('o_orderkey', 'o_custkey')}
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
LEFT JOIN (SELECT l_orderkey, MIN(l_suppkey) AS merchant FROM lineitem GROUP BY l_orderkey) m ON o_orderkey=m.l_orderkey)"""
