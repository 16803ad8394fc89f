"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that one step of a task handles at a time.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strings(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, a missing one as the empty text."""
    return [s or "" for s in column.to_pylist()]


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches that hold about ``chars`` characters each, with their texts."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start = size = 0
        for row in range(batch.num_rows):
            size += _length(column, row)
            if size >= chars or row + 1 == batch.num_rows:
                part = batch.slice(start, row + 1 - start)
                yield part, strings(column.slice(start, row + 1 - start))
                start, size = row + 1, 0


def _length(column: pa.Array, row: int) -> int:
    scalar = column[row]
    return scalar.as_buffer().size if scalar.is_valid else 0


def salted(df: DataFrame, groups: int, *columns: str, name: str = "salt") -> DataFrame:
    """Deal rows evenly over ``groups`` numbers by a hash of the given columns."""
    return df.withColumn(name, F.pmod(F.xxhash64(*columns), F.lit(groups)).cast("int"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit words, so that low and high bits are equally good."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
