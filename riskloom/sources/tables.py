"""Reading raw and curated tables, with the schema checks of each stage."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import settings as S

RAW_SCHEMA = T.StructType([
    T.StructField(name, kind) for name, kind in (
        ("Unnamed: 0", T.LongType()), ("trans_date_trans_time", T.TimestampType()), ("cc_num", T.LongType()),
        ("merchant", T.StringType()), ("category", T.StringType()), ("amt", T.DoubleType()),
        ("first", T.StringType()), ("last", T.StringType()), ("gender", T.StringType()),
        ("street", T.StringType()), ("city", T.StringType()), ("state", T.StringType()), ("zip", T.StringType()),
        ("lat", T.DoubleType()), ("long", T.DoubleType()), ("city_pop", T.IntegerType()), ("job", T.StringType()),
        ("dob", T.DateType()), ("trans_num", T.StringType()), ("unix_time", T.LongType()),
        ("merch_lat", T.DoubleType()), ("merch_long", T.DoubleType()), ("is_fraud", T.IntegerType()),
        ("merch_zipcode", T.StringType()),
    )
])


#: Column of the values that a declared type could not read, by column name.
UNREADABLE = "_unreadable"


def scan_csv_union(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = RAW_SCHEMA, keep_unreadable: bool = False
) -> DataFrame:
    """Read CSV files with headers and align their columns by name, absent ones as null.

    With a declared schema the header names the fields and the schema gives the types;
    without one, types are inferred.  Files with equal headers share one scan.  A value
    that its type cannot read becomes null; ``keep_unreadable`` adds the map
    ``_unreadable`` from its column to its text.
    """
    if not paths:
        raise FileNotFoundError("no CSV files given")

    def header(path: str) -> tuple[str, ...]:
        return tuple(spark.read.csv(path, header=True, escape='"').columns)

    with ThreadPoolExecutor(8) as pool:
        headers = dict(zip(paths, pool.map(header, paths)))

    def one(columns: tuple[str, ...]) -> DataFrame:
        own = [p for p in paths if headers[p] == columns]
        if schema is None:
            return spark.read.csv(own, header=True, inferSchema=True, escape='"')
        text = spark.read.csv(own, header=True, enforceSchema=False, escape='"')
        known = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields if f.name in columns}
        out = text.select([known[c].alias(c) if c in known else F.col(f"`{c}`") for c in columns] + (
            [_unreadable(known).alias(UNREADABLE)] if keep_unreadable else []
        ))
        return out

    scans = [one(columns) for columns in dict.fromkeys(headers.values())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _unreadable(known: dict[str, Column]) -> Column:
    lost = F.array(*[
        F.when(cast.isNull() & F.col(f"`{c}`").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("text")))
        for c, cast in known.items()
    ])
    return F.map_from_entries(F.filter(lost, lambda v: v.isNotNull()))


def unreadable_counts(df: DataFrame) -> DataFrame:
    """``column, n`` of the values that could not be read."""
    return df.select(F.explode(UNREADABLE).alias("column", "text")).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class SchemaDifference:
    missing: tuple[str, ...]
    extra: tuple[str, ...]


def schema_difference(df: DataFrame, expected: Sequence[str] = S.RAW_COLUMNS) -> SchemaDifference:
    have, want = set(df.columns), set(expected)
    return SchemaDifference(tuple(sorted(want - have)), tuple(sorted(have - want)))


def validate_schema(df: DataFrame, expected: Sequence[str] = S.RAW_COLUMNS) -> DataFrame:
    """Fail on missing columns; keep extra ones with a warning.  Runs no job."""
    diff = schema_difference(df, expected)
    if diff.missing:
        raise ValueError(f"missing columns: {list(diff.missing)}")
    if diff.extra:
        warnings.warn(f"extra columns kept: {list(diff.extra)}", stacklevel=2)
    return df


@dataclass(frozen=True)
class Splits:
    """Lazy views of one table; the feature columns exclude the target, the split and the row id."""

    train: DataFrame
    val: DataFrame
    test: DataFrame
    features: tuple[str, ...]


def load_splits(table: DataFrame | str, spark: SparkSession | None = None, target: str = S.TARGET, key: str | None = "tx_id") -> Splits:
    """Three filtered views; fails when a needed column is missing or a split is empty."""
    df = spark.read.parquet(table) if isinstance(table, str) else table
    missing = sorted({target, "split"} - set(df.columns))
    if missing:
        raise ValueError(f"missing columns in curated table: {missing}")
    present = {r["split"] for r in df.groupBy("split").count().filter(F.col("split").isin(*S.SPLITS)).collect()}
    for name in S.SPLITS:
        if name not in present:
            raise ValueError(f"split {name!r} is empty")
    views = {name: df.filter(F.col("split") == name).drop("split") for name in S.SPLITS}
    features = tuple(c for c in df.columns if c not in {target, "split", key})
    return Splits(views["train"], views["val"], views["test"], features)
