"""Windowed stream reports, alarms, retries and late labels.  State is bounded by watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import scalar as X
from riskloom.models.score import Bundle, score_batch


def tumbling_report(stream: DataFrame, clock: str, group: str, label: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Count and positive rate per fixed window and group; partial sums come before the shuffle."""
    return (
        stream.withWatermark(clock, delay).groupBy(F.window(clock, width).alias("w"), F.col(group))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("n_pos"))
        .select(F.col("w.start").alias("window_start"), group, "n", "n_pos", (F.col("n_pos") / F.col("n")).alias("rate"))
    )


def sliding_rate_limit(
    stream: DataFrame, clock: str, card: str, max_rows: int, width: str = "10 minutes", slide: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Windows in which a card has more than ``max_rows`` transactions (card testing)."""
    counted = stream.withWatermark(clock, delay).groupBy(F.window(clock, width, slide).alias("w"), F.col(card)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.filter(F.col("n") > max_rows).select(F.col("w.start").alias("window_start"), card, "n")


def drop_retries(stream: DataFrame, tx_id: str, clock: str, delay: str = "1 hour") -> DataFrame:
    """A request sent again within the delay counts once."""
    return stream.withWatermark(clock, delay).dropDuplicatesWithinWatermark([tx_id])


def late_label_join(tx: DataFrame, labels: DataFrame, clock: str, first_day: int = 30, last_day: int = 60, delay: str = "1 day") -> DataFrame:
    """Outer join of transactions with confirmations that arrive within the delay window.

    ``labels`` has ``label_tx_id, arrived, confirmed``.  A transaction without partner is
    emitted with nulls once its window has passed the watermark.
    """
    left, right = tx.withWatermark(clock, delay), labels.withWatermark("arrived", delay)
    return left.join(
        right,
        F.expr(
            f"tx_id = label_tx_id AND arrived >= {clock} + INTERVAL {first_day} DAYS AND arrived <= {clock} + INTERVAL {last_day} DAYS"
        ),
        "leftOuter",
    )


def closing_rows(tx: DataFrame, labels: DataFrame, clock: str, last_day: int = 60, delay_days: int = 1) -> tuple[DataFrame, DataFrame]:
    """A row for either stream of ``late_label_join``, past the last window by more than both delays.

    A stream that goes on needs none: its later rows move the watermark.  At the end of a finite one
    these rows do, so the transactions still waiting come out unconfirmed.  The transaction has no id; the
    label has one, as the join leaves out labels without before they move the watermark, but arrives too late for any.
    """
    last = tx.agg(F.max(clock).alias("t"), F.min("tx_id").alias("id")).unionByName(
        labels.agg(F.max("arrived").alias("t"), F.min("label_tx_id").alias("id"))
    ).agg(F.max("t").alias("t"), F.min("id").alias("id"))
    end = F.col("t") + F.make_dt_interval(F.lit(last_day + 2 * delay_days + 1))

    def row(like: DataFrame, **values: Column) -> DataFrame:
        return last.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema])

    return row(tx, **{clock: end}), row(labels, arrived=end, label_tx_id=F.col("id"))


def label_versions(joined: DataFrame) -> DataFrame:
    """One row per state that a transaction's label has had, from the rows of ``late_label_join`` alone.

    Version 0 is the state without a confirmation within the delay window; otherwise versions count the
    confirmations in order of arrival, a confirming one first among those of one instant.
    """
    order = Window.partitionBy("tx_id").orderBy("arrived", F.col("confirmed").desc())
    known = joined.filter(F.col("tx_id").isNotNull())
    return known.select(
        "tx_id", "arrived", "confirmed",
        F.when(F.col("arrived").isNull(), 0).otherwise(F.row_number().over(order)).cast("bigint").alias("version"),
        F.when(F.col("arrived").isNull(), "provisional").otherwise("confirmed").alias("status"),
    )


def label_status(joined: DataFrame) -> DataFrame:
    """The earliest confirmation of each transaction of the joined stream; one without is provisional."""
    came = F.when(F.col("arrived").isNotNull(), F.struct("arrived", -F.col("confirmed")))
    earliest = joined.filter(F.col("tx_id").isNotNull()).groupBy("tx_id").agg(
        F.min_by("confirmed", came).alias("confirmed"), F.count("arrived").alias("_n")
    )
    return earliest.select("tx_id", F.when(F.col("_n") > 0, "confirmed").otherwise("provisional").alias("status"), "confirmed")


def score_and_decide(features: DataFrame, bundle: Bundle) -> DataFrame:
    """Score, band and reason for each arriving feature row, ready for the decision log."""
    return score_batch(features, bundle).withColumn("decision", X.decision_band(F.col("score_calibrated"))).withColumn(
        "reason_code", X.reason_code(F.col("decision"))
    ).withColumn("model_version", F.lit(bundle.version))
