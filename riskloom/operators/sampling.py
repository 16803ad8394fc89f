"""Repeatable sampling and top rows.  Each keeps at most k rows per task before the final merge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions import scalar as X


def _shuffled(df: DataFrame, tx_id: str, seed: int) -> Column:
    if isinstance(df.schema[tx_id].dataType, StringType):
        return F.xxhash64(tx_id, F.lit(seed))
    return X.hash_order(F.col(tx_id), seed)


def sample_n(df: DataFrame, tx_id: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement: the first n in a seeded hash order."""
    return df.orderBy(_shuffled(df, tx_id, seed), tx_id).limit(n)


def sample_per_class(df: DataFrame, tx_id: str, label: str, sizes: Mapping[int, int], seed: int = 42) -> DataFrame:
    """Up to ``sizes[label]`` rows of each class."""
    out = None
    for value, n in sizes.items():
        part = sample_n(df.filter(F.col(label) == value), tx_id, n, seed)
        out = part if out is None else out.unionByName(part)
    return out


def sample_one(df: DataFrame, tx_id: str, label: str, value: int, seed: int = 42) -> DataFrame:
    """One random row of a class."""
    return sample_n(df.filter(F.col(label) == value), tx_id, 1, seed)


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """First k rows per group; Spark limits each task to k rows per group before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
