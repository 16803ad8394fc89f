"""Named checks: a Spark job over the given tables and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import prepare

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        @wraps(job)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return job(prepare(spark), sf_dir)

        if name in JOBS:
            raise ValueError(f"{name} registered twice")
        JOBS[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return job

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns for comparison between engines."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})


def as_long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


_MADE: dict[tuple, object] = {}
_LOCK = RLock()


def once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], object]) -> object:
    """Make a table or model once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    with _LOCK:
        if key not in _MADE:
            _MADE[key] = make()
        return _MADE[key]
