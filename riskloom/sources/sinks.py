"""Writers.  All write in parallel from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, clock: str, tie: str | None = None) -> None:
    """Globally time-ordered ZSTD parquet: range shuffle, then a sort inside each partition.

    The id joins the range key, so a burst of equal times still spreads over partitions,
    and row-group statistics on the clock make later time filters cheap.
    """
    keys = [clock] + ([tie] if tie else [])
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option(
        "compression", "zstd"
    ).parquet(path)


def write_curated(df: DataFrame, path: str) -> None:
    """Curated table, one folder per split so that reading a split prunes the others."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("split").parquet(path)


def write_scored(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report table (segments, importance, top-k): small by construction.

    One file; the exchange keeps what makes the report from running in that one task.
    """
    df.repartition(1).write.mode("overwrite").csv(path, header=True)
