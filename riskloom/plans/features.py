"""Staging table to curated feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.functions import scalar as X
from riskloom.operators.encode import target_encode
from riskloom.operators.profile import conditional_quantile
from riskloom.operators.ordered import hot_key_hashes
from riskloom.operators.rolling import ROWS_PER_CARD, consecutive_features, rolling_past
from riskloom.operators.split import temporal_split

_NARROW_TYPES = {"amt_gt_p95_legit": "tinyint", "is_night": "tinyint", "hour": "smallint", "dow": "smallint"}


def staging_to_transactions(raw: DataFrame) -> DataFrame:
    """Raw 24-column staging table to the transaction columns the feature plan reads."""
    return raw.select(
        F.col("trans_num").alias("tx_id"), F.col("cc_num").alias("card"), F.col("unix_time").cast("bigint").alias("us"),
        F.timestamp_seconds("unix_time").alias("ts"), F.col("amt").cast("double").alias("amt"),
        "merchant", "category", "state", "job", "dob", "merch_lat", "merch_long", F.col(S.TARGET).cast("int").alias(S.TARGET),
        # String ids have no arithmetic, so the fold comes from a hash of the id.
        F.pmod(F.xxhash64("trans_num"), F.lit(S.ENCODING_FOLDS)).cast("int").alias("fold"),
    )


def build_features(
    tx: DataFrame,
    windows: Mapping[str, int] = S.ROLLING_WINDOWS_SECONDS,
    ticks_per_second: int = 1,
    narrow: bool = True,
    rows_per_card: int = ROWS_PER_CARD,
) -> DataFrame:
    """Key, the 27 features in fixed order, target and split.

    Input columns: tx_id, card, us (integer clock of ``ticks_per_second``), ts, amt,
    merchant, category, state, job, dob, merch_lat, merch_long, is_fraud, fold.
    Everything that could leak (amount ceiling, encodings) is fitted on train rows only,
    and card windows are strictly past.  Card features share one shuffle and one sort by
    card: the lag order (clock, id) already satisfies the order of the range frames.
    """
    hot = hot_key_hashes(tx, ["card"], rows_per_card)
    tx = tx.withColumns({
        "hour": X.hour_of_day(F.col("ts")), "dow": X.day_of_week(F.col("ts")), "age": X.age_years(F.col("ts"), F.col("dob")),
        "log1p_amt": F.log1p("amt"),
    })
    sin, cos = X.cyclic_hour(F.col("hour"))
    tx = tx.withColumns({"is_night": X.is_night(F.col("hour")), "hour_sin": sin, "hour_cos": cos})
    split = temporal_split(tx, "us", "tx_id")
    is_train = F.col("split") == "train"
    ceiling = conditional_quantile(split, "amt", 0.95, is_train & (F.col(S.TARGET) == 0))
    flagged = split.withColumn("amt_gt_p95_legit", F.coalesce(F.col("amt") > F.lit(ceiling), F.lit(False)).cast("tinyint"))
    moved = consecutive_features(flagged, "card", "us", "tx_id", "merch_lat", "merch_long", ticks_per_second, hot_keys=hot)
    rolled = rolling_past(moved, "card", "us", "amt", windows, hot_keys=hot)
    encoded = target_encode(rolled, S.ENCODED_COLUMNS, S.TARGET, "fold", is_train)
    return select_output(encoded, narrow)


def select_output(df: DataFrame, narrow: bool = True) -> DataFrame:
    """The curated columns in their stable order; a missing one is an error."""
    keep = ["tx_id", *S.FEATURE_COLUMNS, S.TARGET, "split"]
    missing = sorted(set(keep) - set(df.columns))
    if missing:
        raise ValueError(f"missing output columns: {missing}")
    if not narrow:
        return df.select(*keep)
    return df.select(
        "tx_id", *[F.col(c).cast(_NARROW_TYPES.get(c, "float")).alias(c) for c in S.FEATURE_COLUMNS],
        F.col(S.TARGET).cast("tinyint").alias(S.TARGET), "split",
    )
