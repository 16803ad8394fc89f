"""Chronological train/val/test assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import settings as S
from riskloom.operators.selection import cut_points


def temporal_split(
    df: DataFrame,
    epoch: str,
    tie: str,
    train: float = S.TRAIN_FRACTION,
    val: float = S.VAL_FRACTION,
    **tuning: int,
) -> DataFrame:
    """First ``int(n * train)`` rows by time are train, the next ``int(n * val)`` val, the rest test.

    Only the two border rows are searched for; assignment is then a comparison per row,
    so the data itself is neither sorted nor shuffled.
    """
    sizes: list[int] = []

    def borders(n: int) -> list[int]:
        sizes[:] = [int(n * train), int(n * train) + int(n * val)]
        return sorted({k for k in sizes if k > 0})

    cuts = {c.rank: c for c in cut_points(df, epoch, tie, borders, **tuning)}

    def first(k: int) -> Column:
        return cuts[k].includes(F.col(epoch), F.col(tie)) if k in cuts else F.lit(False)

    if not sizes:
        return df.withColumn("split", F.lit("test"))
    return df.withColumn("split", F.when(first(sizes[0]), "train").when(first(sizes[1]), "val").otherwise("test"))
