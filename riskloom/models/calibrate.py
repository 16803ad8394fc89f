"""Score calibration: Platt scaling and isotonic regression, chosen on validation rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import scalar as X
from riskloom.operators.metrics import brier
from riskloom.session import materialize

KINDS = ("raw", "platt", "isotonic")
_INVERSE_PENALTY = 1e6


@dataclass(frozen=True)
class Calibrator:
    kind: str
    model: object | None = None

    def apply(self, df: DataFrame, score: str, name: str) -> DataFrame:
        if self.kind == "raw":
            return df.withColumn(name, F.col(score))
        if self.kind == "platt":
            ready = VectorAssembler(inputCols=["_z"], outputCol="_zv").transform(df.withColumn("_z", X.clip_logit(F.col(score))))
            out = self.model.transform(ready).withColumn(name, vector_to_array("_p_prob")[1])
            return out.drop("_z", "_zv", "_p_raw", "_p_prob", "_p_pred")
        if self.kind == "isotonic":
            out = self.model.transform(df.withColumn("_iso_in", F.col(score)))
            return out.withColumnRenamed("_iso_out", name).drop("_iso_in")
        raise ValueError(f"unknown calibrator {self.kind!r}")


def _points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One weighted record per distinct score: the fits depend on nothing else."""
    return df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("_s")).agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.sum(label).cast("double").alias("_pos")
    )


def fit_platt(val: DataFrame, label: str, score: str) -> Calibrator:
    """Logistic regression of the label on the score's logit, almost unpenalised."""
    points = _points(val, label, score)
    both = points.select(
        X.clip_logit(F.col("_s")).alias("_z"),
        F.inline(F.array(
            F.struct(F.lit(1.0).alias("_y"), F.col("_pos").alias("_w")),
            F.struct(F.lit(0.0).alias("_y"), (F.col("_n") - F.col("_pos")).alias("_w")),
        )),
    ).filter(F.col("_w") > 0)
    rows = val.count()
    ready = VectorAssembler(inputCols=["_z"], outputCol="_zv").transform(both)
    model = LogisticRegression(
        featuresCol="_zv", labelCol="_y", weightCol="_w", regParam=1.0 / (_INVERSE_PENALTY * max(rows, 1)),
        standardization=False, tol=1e-9, rawPredictionCol="_p_raw", probabilityCol="_p_prob", predictionCol="_p_pred",
    ).fit(ready)
    return Calibrator("platt", model)


def fit_isotonic(val: DataFrame, label: str, score: str) -> Calibrator:
    """Monotone fit; predictions are clipped to the end values outside the fitted range."""
    points = _points(val, label, score).select(F.col("_s").alias("_iso_in"), (F.col("_pos") / F.col("_n")).alias("_y"), F.col("_n").alias("_w"))
    model = IsotonicRegression(featuresCol="_iso_in", labelCol="_y", weightCol="_w", predictionCol="_iso_out").fit(points)
    return Calibrator("isotonic", model)


def compare_calibrators(val: DataFrame, test: DataFrame, label: str, score: str) -> tuple[Calibrator, DataFrame]:
    """The calibrator with the smallest Brier score on val, and ``kind, split, brier, chosen``.

    Labels and scores are written once: fits and comparisons read them many times, and the model need not score again.
    """
    val, test = (materialize(rows.select(label, score), "calibration") for rows in (val, test))
    fitted = [Calibrator("raw"), fit_platt(val, label, score), fit_isotonic(val, label, score)]
    table = None
    for calibrator in fitted:
        for name, rows in (("val", val), ("test", test)):
            part = brier(calibrator.apply(rows.select(label, score), score, "_c"), label, "_c").select(
                F.lit(calibrator.kind).alias("kind"), F.lit(name).alias("split"), "brier"
            )
            table = part if table is None else table.unionByName(part)
    found = {(r.kind, r.split): r.brier for r in table.collect()}
    chosen = min(fitted, key=lambda c: found[(c.kind, "val")])
    rows = [(k, s, b, k == chosen.kind) for (k, s), b in found.items()]
    out = val.sparkSession.createDataFrame(rows, "kind string, split string, brier double, chosen boolean")
    return chosen, out


def save_calibrator(calibrator: Calibrator, path: str) -> None:
    spark = SparkSession.active()
    if calibrator.model is not None:
        calibrator.model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(calibrator.kind,)], "kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/kind")


def load_calibrator(path: str) -> Calibrator:
    kind = SparkSession.active().read.parquet(f"{path}/kind").first().kind
    loaders = {"platt": LogisticRegressionModel, "isotonic": IsotonicRegressionModel}
    if kind == "raw":
        return Calibrator(kind)
    if kind not in loaders:
        raise ValueError(f"unknown calibrator {kind!r}")
    return Calibrator(kind, loaders[kind].load(f"{path}/model"))
