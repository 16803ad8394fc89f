"""Smoothed target encoding, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.session import materialize


def encoding_stats(df: DataFrame, columns: Sequence[str], label: str, fold: str, is_train: Column) -> DataFrame:
    """Label count and sum per (column, value, fold) of the training rows, for all columns in one scan.

    Combined map-side, so a value that owns a third of the rows costs one record per task.
    Written to the shared folder: one scan serves all encodings, and maps have known sizes.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    stats = (
        df.filter(is_train).select(F.col(label).alias("_y"), F.col(fold).alias("fold"), pairs.alias("_p"))
        .groupBy("_p.column", "_p.value", "fold")
        .agg(F.count("_y").alias("n"), F.sum("_y").alias("pos"))
    )
    return materialize(stats, "encoding")


def smoothed(pos: Column, n: Column, prior: Column, smoothing: float) -> Column:
    return (pos + F.lit(float(smoothing)) * prior) / (n + F.lit(float(smoothing)))


def global_mean(stats: DataFrame) -> float | None:
    """Label mean over all training rows, held-out fold included (every column covers all rows)."""
    row = stats.groupBy("column").agg((F.sum("pos") / F.sum("n")).alias("prior")).first()
    return row.prior if row else None


def encoding_map(stats: DataFrame, column: str, smoothing: float = S.ENCODING_SMOOTHING) -> DataFrame:
    """Encoding per value fitted on all training rows."""
    prior = F.lit(global_mean(stats))
    totals = stats.filter((F.col("column") == column) & F.col("value").isNotNull()).groupBy("value").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos")
    )
    return totals.withColumn("encoded", smoothed(F.col("pos"), F.col("n"), prior, smoothing))


def target_encode(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    fold: str,
    is_train: Column,
    smoothing: float = S.ENCODING_SMOOTHING,
    prefix: str = "te_",
    stats: DataFrame | None = None,
) -> DataFrame:
    """Add one encoded column per categorical.

    Training rows use the other folds only (total minus own fold, not one pass per fold);
    other rows use the full training map; unseen and null values get the global mean.
    Values are joined against the written statistics, so Spark broadcasts a map only
    when its real size allows and otherwise splits skewed values in a sort-merge join.
    """
    if stats is None:
        stats = encoding_stats(df, columns, label, fold, is_train)
    prior = F.lit(global_mean(stats)).cast("double")
    out = df.withColumn("_train", F.coalesce(is_train, F.lit(False)))
    for c in columns:
        per_value = stats.filter((F.col("column") == c) & F.col("value").isNotNull()).groupBy("value").agg(
            F.sum("n").alias("_n"), F.sum("pos").alias("_pos"),
            # One entry per fold.
            F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "pos")))).alias("_own"),
        ).withColumnRenamed("value", "_value")
        joined = out.join(per_value, F.col(c).cast("string") == F.col("_value"), "left")
        own = F.when(F.col("_train"), F.try_element_at("_own", F.col(fold)))
        n = F.coalesce(F.col("_n"), F.lit(0)) - F.coalesce(own.getField("n"), F.lit(0))
        pos = F.coalesce(F.col("_pos"), F.lit(0)) - F.coalesce(own.getField("pos"), F.lit(0))
        encoded = F.when(n > 0, smoothed(pos, n, prior, smoothing)).otherwise(prior)
        out = joined.withColumn(f"{prefix}{c}", encoded).drop("_value", "_n", "_pos", "_own")
    return out.drop("_train")


def map_default(df: DataFrame, column: str, mapping: DataFrame, name: str, default: float | None) -> DataFrame:
    """Look a categorical up in ``mapping(value, encoded)``; unseen values get the default."""
    side = mapping.select(F.col("value").alias("_value"), F.col("encoded").alias("_encoded"))
    joined = df.join(side, F.col(column).cast("string") == F.col("_value"), "left")
    return joined.withColumn(name, F.coalesce("_encoded", F.lit(default))).drop("_value", "_encoded")
