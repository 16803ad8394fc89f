"""Small document tables for the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[str | None], lang: str | None = "en", first: int = 0) -> DataFrame:
    return spark.createDataFrame([(first + i, t, lang, "src0", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))
