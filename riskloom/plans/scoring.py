"""Curated features to a scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.models.score import gate_and_score, load_bundle, sanity_check
from riskloom.operators.sampling import first_n
from riskloom.sources.sinks import write_scored


def score_table(
    spark: SparkSession, curated: str, bundle: str, out: str, split: str | None = None, limit: int | None = None,
    expected_pr_auc: float | None = None,
) -> DataFrame:
    """Score one split (or all rows) and write them; returns ranking quality over the written rows.

    Rows without a usable value in a required feature are not scored; they go, with the
    reason, to a quarantine table beside the output.
    """
    rows = spark.read.parquet(curated)
    if split:
        rows = rows.filter(F.col("split") == split)
    if limit is not None:
        rows = first_n(rows, [F.col("tx_id")], limit)
    scored, refused = gate_and_score(rows, load_bundle(bundle))
    write_scored(scored, out)
    write_scored(refused, f"{out.rstrip('/')}_quarantine")
    return sanity_check(spark.read.parquet(out), expected=expected_pr_auc)
