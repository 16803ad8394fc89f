"""From scores to decisions: lists, limits, review queue, late labels, explanations in words."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators.ordered import ROWS_PER_KEY, global_rank, null_safe, prior_totals
from riskloom.operators.rolling import rolling_past
from riskloom.session import broadcast_up_to


def rate_limited(df: DataFrame, card: str, epoch: str, width: int, max_rows: int) -> DataFrame:
    """Transactions of the card within ``width`` up to and including this one, and whether too many."""
    counted = rolling_past(df.withColumn("_one", F.lit(1.0)), card, epoch, "_one", {"w": width}, prefix="_rl")
    n = F.col("_rl_count_w") + 1
    return counted.withColumns({"n_in_window": n, "limited": n > max_rows}).drop(
        "_one", "_rl_count_w", "_rl_amt_sum_w", "_rl_amt_mean_w", "_rl_amt_std_w"
    )


def first_seen(df: DataFrame, keys: Sequence[str], epoch: str, tx_id: str, name: str) -> DataFrame:
    """Flag the first row of each key combination.

    The first row is found by a combined minimum and joined back on the unique row id,
    so a combination that owns many rows never meets in one task.
    """
    firsts = df.groupBy(*keys).agg(F.min(F.struct(epoch, tx_id)).alias("_f")).select(F.col(f"_f.{tx_id}").alias("_first"))
    return df.join(firsts, F.col(tx_id) == F.col("_first"), "left").withColumn(name, F.col("_first").isNotNull()).drop("_first")


def amount_vs_past_mean(df: DataFrame, key: str, amount: str, order: Sequence[Column], name: str, limit: int = ROWS_PER_KEY) -> DataFrame:
    """Amount over the mean of the key's earlier amounts; null for its first row."""
    past = prior_totals(df, [key], order, {"_n": F.col(amount).isNotNull().cast("bigint"), "_s": F.col(amount)}, limit=limit)
    mean = F.when(F.col("_n") > 0, F.col("_s") / F.col("_n"))
    return past.withColumn(name, F.when(mean != 0, F.col(amount) / mean)).drop("_n", "_s")


def apply_lists(df: DataFrame, card: str, deny: DataFrame, allow: DataFrame, band: Column) -> DataFrame:
    """Denied cards are blocked, allowed cards approved, all others follow the model band.

    Lists are one column of cards, checked in one pass over the transactions.  The joins
    carry no hints: a list's size is not bounded here, so Spark broadcasts by measured
    size and otherwise splits the rows of a dominant card.
    """

    def flagged(cards: DataFrame, name: str) -> DataFrame:
        return cards.select(F.col(cards.columns[0]).alias(card)).distinct().withColumn(name, F.lit(True))

    marked = df.join(flagged(deny, "_deny"), card, "left").join(flagged(allow, "_allow"), card, "left")
    rule = F.when(F.col("_deny"), "denylist").when(F.col("_allow"), "allowlist").otherwise("model")
    decision = F.when(F.col("_deny"), "block").when(F.col("_allow"), "approve").otherwise(band)
    return marked.withColumns({"decision": decision, "rule": rule}).drop("_deny", "_allow")


def confirmed_labels(
    tx: DataFrame, labels: DataFrame, tx_id: str, clock: str, first_day: int = 30, last_day: int = 60
) -> DataFrame:
    """Attach the earliest confirmation that arrives within the delay window; others stay provisional.

    ``labels`` has the transaction id, ``arrived`` and ``confirmed``.
    """
    reduced = labels.groupBy(F.col(tx_id).alias("_id"), "arrived").agg(F.max("confirmed").alias("confirmed"))
    lower = F.col(clock) + F.make_dt_interval(F.lit(first_day))
    upper = F.col(clock) + F.make_dt_interval(F.lit(last_day))
    # Found once per transaction and clock and joined back, so equal rows all stay.
    asked = tx.select(tx_id, clock).distinct()
    joined = asked.join(reduced, (F.col(tx_id) == F.col("_id")) & F.col("arrived").between(lower, upper))
    earliest = joined.groupBy(tx_id, clock).agg(F.min_by("confirmed", "arrived").alias("confirmed"))
    return null_safe(tx, earliest, [tx_id, clock]).withColumn("status", F.when(F.col("confirmed").isNull(), "provisional").otherwise("confirmed"))


def review_queue(df: DataFrame, analyst: str, order: Sequence[Column], limit: int = ROWS_PER_KEY) -> DataFrame:
    """Position of each case in its analyst's queue."""
    return global_rank(df, [analyst], order, "position", limit)


def reason_sentences(contributions: DataFrame, tx_id: str, templates: DataFrame, top: int = 3) -> DataFrame:
    """Strongest contributions of each row as plain sentences.

    ``contributions``: (tx_id, feature, value, contribution); ``templates``: (feature,
    template with one %s), normally one row per model feature.
    """
    ranked = contributions.join(broadcast_up_to(templates, 10_000), "feature").groupBy(tx_id).agg(
        # A row has at most one entry per feature.
        F.array_sort(F.collect_list(F.struct(-F.abs("contribution"), "feature", "template", "value"))).alias("_r")
    )
    sentence = F.transform(
        F.slice("_r", 1, top), lambda r: F.replace(r["template"], F.lit("%s"), F.format_number(r["value"], 2))
    )
    return ranked.select(tx_id, F.array_join(sentence, "; ").alias("reasons"))


@dataclass(frozen=True)
class Sentence:
    """What some features say together.

    ``text`` gets a lookup from feature name to value column; its result is null where the
    sentence does not apply.
    """

    features: tuple[str, ...]
    text: Callable[[Callable[[str], Column]], Column]


CASE_SENTENCES = (
    Sentence(("log1p_amt", "rolling_amt_mean_24h"), lambda value: X.times_sentence(
        F.expm1(value("log1p_amt")), value("rolling_amt_mean_24h"), 2.0, "amount %s times the 24 h mean of this card")),
    Sentence(("amt_gt_p95_legit",), lambda value: X.flag_sentence(value("amt_gt_p95_legit"), "above the p95 of legitimate transactions")),
    Sentence(("is_night", "hour", "hour_sin", "hour_cos"), lambda value: X.flag_sentence(value("is_night"), "at night, when the base rate of fraud is high")),
)


def case_reasons(features: Sequence[str] = S.FEATURE_COLUMNS, sentences: Sequence[Sentence] = CASE_SENTENCES, top: int = 3) -> Column:
    """Why the model raised the score of an explained row (``contributions`` and ``values`` in feature order), in words.

    A sentence weighs what its features contribute together. Those that raise the score are named,
    the heaviest first and equal ones in the order given; null where none is left. One
    projection: nothing is joined or shuffled.
    """
    place = {name: i for i, name in enumerate(features)}

    def value(name: str) -> Column:
        return F.col("values")[place[name]]

    def entry(position: int, sentence: Sentence) -> Column:
        weights = [F.coalesce(F.nanvl(F.col("contributions")[place[name]], F.lit(0.0)), F.lit(0.0)) for name in sentence.features]
        return F.struct((-sum(weights, F.lit(0.0))).alias("order"), F.lit(position).alias("position"), sentence.text(value).alias("text"))

    entries = F.array(*[entry(i, s) for i, s in enumerate(sentences)])
    said = F.slice(F.array_sort(F.filter(entries, lambda e: (e["order"] < 0) & e["text"].isNotNull())), 1, top)
    return F.when(F.size(said) > 0, F.array_join(F.transform(said, lambda e: e["text"]), "; "))


def canary_metrics(df: DataFrame, card: str, label: str, score: str, threshold: float = S.OPERATING_THRESHOLD, percent: int = 5, worst_drop: float = 0.05) -> DataFrame:
    """Confusion and F1 per model version on its share of cards, with promote or rollback."""
    from riskloom.operators.metrics import confusion_at

    routed = df.withColumn("version", X.canary_bucket(F.col(card), percent))
    metrics = confusion_at(routed, label, score, threshold, by=["version"])
    stable = metrics.agg(F.max(F.when(F.col("version") == "stable", F.col("f1"))).alias("f")).scalar()
    return metrics.withColumn("_stable", stable).withColumn(
        "action", F.when(F.col("version") == "stable", "baseline")
        .when(F.col("f1") >= F.col("_stable") - F.lit(worst_drop), "promote").otherwise("rollback")
    ).drop("_stable")
