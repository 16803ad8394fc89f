"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows go to Python in batches of so many bytes: 10,000 long texts at once take 35 MB, and more while they are copied.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def build_session(app: str = "riskloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC time and adaptive execution; extra settings use ``a__b`` for ``a.b``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on to a session made elsewhere."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the cluster's shared checkpoint folder.

    A local session without that setting uses the warehouse folder; on a cluster the
    setting must be there, as a machine-local path would not be visible to other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def broadcast_up_to(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint behind a row check; a larger table stays an ordinary join side."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives executor loss, and gives the planner true
    file sizes, so a join against the result is broadcast only when it really is small.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Working tables that go when the block ends; what is still to be read is written elsewhere by then."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, work_dir(spark, "scratch")
        self.count = 0

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written and read back, as by ``materialize``."""
        self.count += 1
        path = f"{self.root}/{self.count}-{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
