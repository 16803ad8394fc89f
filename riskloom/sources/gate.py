"""Strict feature contract: closed column set, nulls and non-finite values only where allowed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S


def gate_columns(df: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS, other: Sequence[str] = ()) -> None:
    """Reject a table with a missing or an unknown field."""
    missing = sorted(set(features) - set(df.columns))
    unknown = sorted(set(df.columns) - set(features) - set(other))
    if missing:
        raise ValueError(f"missing features: {missing}")
    if unknown:
        raise ValueError(f"unknown features: {unknown}")


def _bad(column: str) -> Column:
    as_double = F.col(column).cast("double")
    return F.col(column).isNull() | F.isnan(as_double) | (F.abs(as_double) == F.lit(float("inf")))


def gate_rows(df: DataFrame, required: Sequence[str] = S.REQUIRED_FEATURES, nullable: Sequence[str] = S.NULLABLE_FEATURES) -> DataFrame:
    """Add ``reject_reason`` (null = accepted); non-finite optional features become null."""
    reasons = F.filter(
        F.array(*[F.when(_bad(c), F.lit(f"bad {c}")) for c in required]), lambda r: r.isNotNull()
    )
    cleaned = df.withColumns({c: F.when(~_bad(c), F.col(c)) for c in nullable})
    return cleaned.withColumn("reject_reason", F.when(F.size(reasons) > 0, F.array_join(reasons, "; ")))


def split_gate(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted, quarantined)``."""
    reason = F.col("reject_reason")
    return gated.filter(reason.isNull()).drop("reject_reason"), gated.filter(reason.isNotNull())


def gate_json(df: DataFrame, body: str, required: Sequence[str] = S.REQUIRED_FEATURES, nullable: Sequence[str] = S.NULLABLE_FEATURES) -> DataFrame:
    """The same contract for request bodies: every field named once, no other field.

    Adds the parsed features and ``reject_reason``.
    """
    fields = [*required, *nullable]
    allowed = F.array(*[F.lit(f) for f in fields])
    keys = F.coalesce(F.json_object_keys(F.col(body)), F.array().cast("array<string>"))
    parsed = F.from_json(F.col(body), ", ".join(f"`{f}` double" for f in fields))
    rows = df.withColumns({
        "_missing": F.array_except(allowed, keys), "_unknown": F.array_except(keys, allowed), "_f": parsed,
    })
    flat = gate_rows(rows.select(*df.columns, "_missing", "_unknown", "_f.*"), required, nullable)
    reason = (
        F.when(F.size("_missing") > 0, F.concat(F.lit("missing "), F.array_join(F.sort_array("_missing"), ",")))
        .when(F.size("_unknown") > 0, F.concat(F.lit("unknown "), F.array_join(F.sort_array("_unknown"), ",")))
        .otherwise(F.col("reject_reason"))
    )
    return flat.withColumn("reject_reason", reason).drop("_missing", "_unknown")
