"""Raw transactions in, decision log out: features, scores and entries of a micro-batch count together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import scalar as X
from riskloom.models.score import Bundle, score_explained
from riskloom.operators.rolling import ROWS_PER_CARD
from riskloom.sources.decisions import DecisionLog
from riskloom.streaming.rolling import RollingStream
from riskloom.streaming.runs import BatchTable, run_batches


class DecisionStream:
    """Keeps ``<path>/rolling``, ``<path>/scores`` and ``<path>/log``; the log's manifest is written last.

    Rows need ``tx_id, card, us, amt``, the clock and the bundle's other features.  Each table holds a batch
    in a folder of its own that a restart overwrites, and readers take only batches of the manifest, so a
    run killed between any two writes shows nothing of the batch until it was done again.  A transaction whose features
    cannot be made (no usable clock) has null scores and goes to review; without a time it is logged at the epoch.
    """

    def __init__(
        self, spark: SparkSession, path: str, bundle: Bundle, windows: Mapping[str, int], ticks_per_day: int = 86_400,
        clock: str = "ts", limit: int = ROWS_PER_CARD, **rolling: int,
    ):
        self.bundle, self.clock, self.path = bundle, clock, path
        self.rolling = RollingStream(spark, f"{path}/rolling", windows, ticks_per_day, limit, **rolling)
        self.scores = BatchTable(spark, f"{path}/scores")
        self.log = DecisionLog(spark, f"{path}/log")

    def step(self, batch: DataFrame, batch_id: int) -> None:
        if self.log.holds(batch_id):
            return
        came = batch.persist()
        try:
            self.rolling.step(came, batch_id)
            self.scores.write(self._score(came, batch_id), batch_id)
            self.log.append(self._entries(self.scores.read_batch(batch_id), batch_id), batch_id)
        finally:
            came.unpersist()

    def _score(self, came: DataFrame, batch_id: int) -> DataFrame:
        names = list(self.bundle.features)
        made = self.rolling.features.read_batch(batch_id)
        if made is None:  # no row of the batch has a usable clock
            rows = came.withColumns({n: F.lit(None).cast("double") for n in names if n not in came.columns}).withColumn("_made", F.lit(False))
        else:
            rows = came.join(made.drop("card", "us").withColumn("_made", F.lit(True)), "tx_id", "left")
        explained = score_explained(rows.filter("_made"), self.bundle).select(
            "tx_id", "score_raw", "score_calibrated", F.to_json("top").alias("top_features")
        )
        return rows.select("tx_id", F.col(self.clock).alias("recorded_at"), F.to_json(F.struct(*names)).alias("inputs")).join(explained, "tx_id", "left")

    def _entries(self, scored: DataFrame, batch_id: int) -> DataFrame:
        band = X.decision_band(F.col("score_calibrated"))
        return scored.withColumns({
            "entry_id": F.concat_ws("-", F.lit("auto"), F.lit(batch_id), "tx_id"), "decision": band, "model_version": F.lit(self.bundle.version),
            "rules": F.array(F.when(F.col("score_calibrated").isNull(), "degraded").otherwise("model")), "reason": X.reason_code(band),
            "recorded_at": F.coalesce("recorded_at", F.timestamp_seconds(F.lit(0))),
        })

    def features(self) -> DataFrame:
        """The newest features of every transaction, of batches that count."""
        return self.rolling.features.latest("tx_id", batches=self._batches())

    def scored(self) -> DataFrame:
        return self.scores.read().join(self._batches(), "batch", "left_semi")

    def _batches(self) -> DataFrame:
        return self.log.manifest().select(F.col("batch_id").cast("bigint").alias("batch"))

    def run(self, stream: DataFrame) -> None:
        run_batches(stream, f"{self.path}/checkpoint", self.step)
