"""Raw CSV files to the time-sorted staging table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.operators.profile import null_profile, quality_report
from riskloom.sources.sinks import write_sorted
from riskloom.sources.tables import UNREADABLE, scan_csv_union, unreadable_counts, validate_schema


@dataclass(frozen=True)
class Ingested:
    path: str
    quality: DataFrame
    nulls: DataFrame
    quarantine: str | None = None


def ingest(spark: SparkSession, paths: Sequence[str], staging: str, max_unreadable: int = 0) -> Ingested:
    """Read, check, write sorted by event time; the reports then scan the compact table, not the CSV.

    Rows with values that cannot be read go, as text, to a quarantine table beside the
    staging table; more such values than ``max_unreadable`` stop the job.
    """
    scanned = scan_csv_union(spark, paths, keep_unreadable=True)
    counts = {r["column"]: r["n"] for r in unreadable_counts(scanned).collect()}  # one row per column
    quarantine = f"{staging.rstrip('/')}_quarantine" if counts else None
    if quarantine:
        scanned.where(F.size(UNREADABLE) > 0).write.mode("overwrite").parquet(quarantine)
    if sum(counts.values()) > max_unreadable:
        raise ValueError(f"unreadable values, kept in {quarantine}: {counts}")
    raw = validate_schema(scanned.drop(UNREADABLE))
    write_sorted(raw, staging, "unix_time", "trans_num")
    table = spark.read.parquet(staging)
    return Ingested(
        staging, quality_report(table, S.TARGET, "trans_date_trans_time", "cc_num"), null_profile(table, S.RAW_COLUMNS),
        quarantine,
    )
