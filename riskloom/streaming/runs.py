"""Running a stream over what has arrived, and tables written once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tx_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Transaction files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


_STARTING = Lock()


@contextmanager
def started_with(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The session with ``settings`` while a stream starts; the stream keeps them, the session gets its own back."""
    with _STARTING:
        before = {name: spark.conf.get(name, None) for name in settings}
        for name, value in settings.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Rows of a micro-batch that one state task takes.
ROWS_PER_STATE_TASK = 500_000


def state_settings(spark: SparkSession, rows: int) -> dict[str, str]:
    """For a stateful stream of about ``rows`` rows a micro-batch: state tasks by rows and cores, and one version of the state in memory.

    A state task opens and writes its files in every micro-batch, with rows or without; the number of shuffle partitions,
    meant for the largest exchange of a session, gives far too many of them.
    """
    cores = spark.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-rows // (ROWS_PER_STATE_TASK * cores)))
    return {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.streaming.maxBatchesToRetainInMemory": "1"}


def run_batches(
    stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], mode: str = "append", settings: Mapping[str, str] | None = None
) -> None:
    """Process everything available, one micro-batch at a time, then stop; ``settings`` hold for this stream alone."""
    with started_with(stream.sparkSession, settings or {}):
        query = (
            stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(step).trigger(availableNow=True).start()
        )
    query.awaitTermination()


def run_to_table(stream: DataFrame, path: str, checkpoint: str, partition: str | None = None) -> None:
    """Append a stateless or append-mode stream to a parquet table, each row exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition:
        writer = writer.partitionBy(partition)
    writer.trigger(availableNow=True).start(path).awaitTermination()


class BatchTable:
    """A parquet table with one folder per micro-batch.

    A retried batch overwrites its own folder, so a restart neither loses nor repeats rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(self.path)

    def read_batch(self, batch_id: int) -> DataFrame | None:
        """The rows of one batch; None when it wrote nothing."""
        try:
            return self.spark.read.parquet(f"{self.path}/batch={batch_id}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def latest(self, *keys: str, batches: DataFrame | None = None) -> DataFrame:
        """The newest version of each key, of the given ``batches`` (a column ``batch``) or of all."""
        df = self.read() if batches is None else self.read().join(batches, "batch", "left_semi")
        values = [c for c in df.columns if c not in keys and c != "batch"]
        return df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v")).select(*keys, "_v.*")


#: Parts of a day above which they are merged into one.
MAX_PARTS = 12


class DayHistory:
    """Rows by ``day`` and micro-batch, each day in few files sorted by ``order``.

    A batch adds one part ``batch=<id>`` to every day it touches.  A day of more than ``max_parts``
    parts is rewritten as one part ``upto=<id>`` that holds all rows before that batch, so reading a
    day costs the same after ten batches and after a million.  A merge counts once its mark
    is written; until then, and after a failure, the parts it was made of are read.
    """

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str], max_parts: int = MAX_PARTS):
        self.spark, self.path, self.order, self.max_parts = spark, path, list(order), max_parts

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Add the batch, with a column ``day``; a retried batch replaces just its own parts."""
        self._store(df.withColumn("batch", F.lit(batch_id)), "batch")

    def days(self) -> list[int]:
        return [int(name.removeprefix("day=")) for name in self._names(self.path) if name.startswith("day=")]

    def newest(self, before: int) -> int | None:
        """The newest day with rows of a batch earlier than ``before``."""
        return next((day for day in sorted(self.days(), reverse=True) if self._parts(day, before)), None)

    def read(self, schema: T.StructType, days: Collection[int], before: int) -> DataFrame | None:
        """Rows of the given days from batches earlier than ``before``; None when there are none."""
        folders = [part for day in sorted(set(days) & set(self.days())) for part in self._parts(day, before)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else None

    def compact(self, schema: T.StructType, days: Collection[int], before: int) -> None:
        """Merge the parts of those of the given days that have too many of them."""
        parts = {day: self._parts(day, before) for day in sorted(set(days) & set(self.days()))}
        due = {day: found for day, found in parts.items() if len(found) > self.max_parts}
        if not due:
            return
        rows = self.spark.read.schema(schema).parquet(*[part for found in due.values() for part in found])
        by_day = F.regexp_extract("_metadata.file_path", "/day=(-?[0-9]+)/", 1).cast("bigint")
        self._store(rows.withColumns({"day": by_day, "upto": F.lit(before)}), "upto")
        self._file_system().create(self._path(f"{self.path}/_merged/{before}"), True).close()
        for part in [part for found in due.values() for part in found]:
            self._file_system().delete(self._path(part), True)

    def drop_before(self, day: int) -> None:
        """Days that no event to come can reach."""
        for old in (d for d in self.days() if d < day):
            self._file_system().delete(self._path(f"{self.path}/day={old}"), True)

    def _store(self, df: DataFrame, part: str) -> None:
        # Rebalancing puts a small day into one file and cuts a large one into several.
        df.hint("rebalance", "day").sortWithinPartitions("day", *self.order).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("day", part).parquet(self.path)

    def _parts(self, day: int, before: int) -> list[str]:
        """Folders that together hold the rows of a day from earlier batches, each row once."""
        names = [name.split("=") for name in self._names(f"{self.path}/day={day}")]
        merged = [int(n) for kind, n in names if kind == "upto" and int(n) <= before]
        upto = max((n for n in merged if self._file_system().exists(self._path(f"{self.path}/_merged/{n}"))), default=None)
        single = [int(n) for kind, n in names if kind == "batch" and int(n) < before and (upto is None or int(n) >= upto)]
        found = [f"upto={upto}"] if upto is not None else []
        return [f"{self.path}/day={day}/{name}" for name in found + [f"batch={n}" for n in sorted(single)]]

    def _names(self, path: str) -> list[str]:
        """Names of the partition folders in a folder; none when it does not exist."""
        folder, system = self._path(path), self._file_system()
        found = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
        return [name for name in found if "=" in name]

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self):
        return self._path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
