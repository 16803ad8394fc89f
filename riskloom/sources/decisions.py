"""Append-only decision log: a batch counts as a whole or not at all, corrections never change an entry."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What an entry must say: who decided what, on which inputs, by which model and rules.
REQUIRED = {
    "entry_id": "string", "tx_id": "bigint", "recorded_at": "timestamp", "decision": "string", "model_version": "string",
    "score_raw": "double", "score_calibrated": "double", "inputs": "string", "top_features": "string", "rules": "array<string>",
}
#: The analyst's part, and the entry that a correction corrects.
OPTIONAL = {"analyst": "string", "reason": "string", "corrects": "string"}
NOT_NULL = ("entry_id", "tx_id", "recorded_at", "decision", "model_version")
COLUMNS = {**REQUIRED, **OPTIONAL}


class DecisionLog:
    """Entries by date under ``<path>/entries``, batches that count under ``<path>/manifest``.

    ``append`` writes the entries as an attempt of their own and then one manifest row that names it, so
    a batch that failed half-way is never read and one that is sent again changes nothing.
    ``entry_id`` is the caller's and unique.  A correction is an entry that names, in ``corrects``, the first
    entry of what it corrects, never another correction.
    """

    MANIFEST = "batch_id string, attempt string, n_entries bigint, first_at timestamp, last_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, df: DataFrame, batch_id: str | int) -> bool:
        """Log the entries; False when the batch is already in the log."""
        if self.holds(batch_id):
            return False
        missing = sorted(set(REQUIRED) - set(df.columns))
        if missing:
            raise ValueError(f"decision entries lack {missing}")
        found = [c for c in COLUMNS if c in df.columns]
        typed = df.select(*[F.col(c).cast(COLUMNS[c]) for c in found], *[F.lit(None).cast(t).alias(c) for c, t in OPTIONAL.items() if c not in found])
        attempt = uuid.uuid4().hex
        folder = f"{self.path}/entries/attempt={attempt}"
        dated = typed.select(*COLUMNS, F.to_date("recorded_at").alias("dt"))
        dated.hint("rebalance", "dt").write.option("compression", "zstd").partitionBy("dt").parquet(folder)
        # Checks and counts read what was written, so the entries are computed once.
        written = self.spark.read.schema(self._schema()).parquet(folder)
        empty = F.greatest(*[F.col(c).isNull().cast("int") for c in NOT_NULL])
        seen = written.agg(
            F.count(F.lit(1)).alias("n"), F.sum(empty).alias("empty"), F.count("corrects").alias("corrections"),
            F.min("recorded_at").alias("first_at"), F.max("recorded_at").alias("last_at"),
        ).first()
        if seen.empty:
            raise ValueError(f"{seen.empty} decision entries lack one of {NOT_NULL}")
        if seen.corrections:
            self._check_corrections(written)
        row = [(str(batch_id), attempt, seen.n, seen.first_at, seen.last_at)]
        self.spark.createDataFrame(row, self.MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return True

    def _check_corrections(self, written: DataFrame) -> None:
        firsts = written.unionByName(self.entries().select(*written.columns)).filter(F.col("corrects").isNull())
        named = written.filter(F.col("corrects").isNotNull()).select(F.col("corrects").alias("entry_id"))
        lost = named.join(firsts.select("entry_id"), "entry_id", "left_anti").count()
        if lost:
            raise ValueError(f"{lost} corrections name no first entry of the log")

    def manifest(self) -> DataFrame:
        """One row per batch that counts."""
        try:
            found = self.spark.read.schema(self.MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], self.MANIFEST)
        # Two writers of one batch may both finish; the same one of them counts for every reader.
        return found.groupBy("batch_id").agg(F.min_by(F.struct("attempt", "n_entries", "first_at", "last_at"), "attempt").alias("_m")).select(
            "batch_id", "_m.*"
        )

    def holds(self, batch_id: str | int) -> bool:
        return not self.manifest().filter(F.col("batch_id") == str(batch_id)).isEmpty()

    def entries(self) -> DataFrame:
        """All entries of the batches that count, with ``dt`` and ``batch_id``."""
        batches = self.manifest().select("batch_id", "attempt")
        if batches.isEmpty():
            return self.spark.createDataFrame([], self._schema()).withColumns(
                {"dt": F.to_date("recorded_at"), "batch_id": F.lit(None).cast("string")}
            )
        keys = [T.StructField("attempt", T.StringType()), T.StructField("dt", T.DateType())]
        schema = T.StructType([*self._schema().fields, *keys])
        written = self.spark.read.schema(schema).option("basePath", f"{self.path}/entries").parquet(f"{self.path}/entries")
        return written.join(batches, "attempt").drop("attempt")

    def as_of(self, instant: str) -> DataFrame:
        """The state of each transaction as the log knew it at ``instant``, a timestamp.

        A correction stands where the entry stood that it corrects, the last one recorded
        counting; then the last entry of a transaction is its state.  ``n_entries`` counts
        all that had been recorded.
        """
        content = [c for c in COLUMNS if c != "tx_id"]
        known = self.entries().filter(F.col("recorded_at") <= F.lit(instant).cast("timestamp"))
        placed = known.withColumn("_first", F.coalesce("corrects", "entry_id")).groupBy("tx_id", "_first").agg(
            F.max_by(F.struct(*content), F.struct("recorded_at", "entry_id")).alias("_v"),
            F.min("recorded_at").alias("_placed"), F.count(F.lit(1)).alias("_n"),
        )
        return placed.groupBy("tx_id").agg(
            F.max_by("_v", F.struct("_placed", "_first")).alias("_v"), F.sum("_n").alias("n_entries")
        ).select("tx_id", "_v.*", "n_entries")

    def _schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in COLUMNS.items()))
