"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import jaccard, langid, packing, quality, secrets
from riskloom.llm.frequent import Filter
from riskloom.session import materialize, prepare

#: Cosine below which a text of so many characters is in none of the learned languages; a
#: shorter one has too few n-grams to tell.
LEAST_COSINE, TELLING = 0.1, 200
#: Words of a shingle and percent of shingles in common, from which two texts are near duplicates.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def prepared(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage under the session's settings, also where it runs by itself."""

    @wraps(stage)
    def run_prepared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(prepare(spark), docs, sf_dir)

    return run_prepared


def bundled(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one, so that no operator meets their names."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(None).cast("int").alias("none"), *others).alias("others"))


def unbundled(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns again, in their order."""
    return rows.select(*(F.col(c) if c in ("doc_id", "text") else F.col(f"others.c{i}").alias(c) for i, c in enumerate(columns)))


@prepared
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the model is learned from ``labels``."""
    ratio = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # Only the weights are written; texts are weighed again, alike, rather than kept.
    weights = materialize(quality.weigh(docs.select("doc_id", "text"), ratio).drop("text"), "weights")
    return unbundled(quality.resample(quality.weigh(bundled(docs), ratio), weights=weights), docs.columns)


@prepared
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter, or long and far from all prototypes, go."""
    predicted = langid.predict(bundled(docs), langid.learn(docs), keep=True)
    known = (F.col("lang_pred") != langid.UNKNOWN) & ((F.col("score") >= LEAST_COSINE) | (F.length("text") < TELLING))
    return unbundled(predicted.where(known), docs.columns)


@prepared
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the least doc_id.

    Similar means that ``NEAR_PERCENT`` of 100 shingles of ``NEAR_WORDS`` words are in common: a
    copy with a passage added or cut is one up to a quarter more shingles.

    Rows that repeat a doc_id are one document, of which one row stays. Rows without doc_id stay.
    """
    found = jaccard.link_components(docs.select("doc_id", "text"), NEAR_WORDS, NEAR_PERCENT)
    # Most ids come once and stay. Only rows that a filter of all other ids lets through are brought to their ids.
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("leads"), F.count(F.lit(1)).alias("n"))
    others = materialize(ids.where("NOT leads OR n > 1").select("doc_id"), "others")
    may = Filter.of(others.select(F.xxhash64("doc_id").alias("h"))).held_by(spark)(F.xxhash64(F.col("doc_id").cast("long")))
    plain = docs.where("doc_id IS NOT NULL").where(~may)
    # The ids that stay grow with the documents: one plan at every size, without a broadcast.
    leading = found.where("doc_id = component_id").select("doc_id").distinct().hint("merge")
    named = docs.where("doc_id IS NOT NULL").where(may).join(leading, "doc_id", "left_semi")
    # Only ids that occur again need their rows brought together.
    again = materialize(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    once, repeated = named.join(again, "doc_id", "left_anti"), named.join(again, "doc_id", "left_semi")
    least = repeated.groupBy("doc_id").agg(F.min(F.struct(*(c for c in docs.columns if c != "doc_id"))).alias("row")).select("doc_id", "row.*")
    return plain.union(once.select(docs.columns)).union(least.select(docs.columns)).union(docs.where("doc_id IS NULL"))


@prepared
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text."""
    return unbundled(secrets.redact(bundled(docs)), docs.columns)


@prepared
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's rows are written and read again by the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
