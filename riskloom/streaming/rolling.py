"""Card rolling features on a stream, by the batch rules.

Each micro-batch joins the recent history of its own cards and runs the same operator as
the batch plan, so training and serving cannot differ, and a card that dominates the
stream is split like any hot key instead of growing one state entry in one task.  History
is a table by day, sorted by card: a batch reads only the days its windows reach, and few cards
are looked up in the row groups that hold them.  Days with many parts are merged, so the cost of a batch
does not grow with the batches before it.  Late events also re-emit the transactions whose
windows they fall in, as new revisions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.ordered import null_safe
from riskloom.operators.rolling import ROWS_PER_CARD, rolling_past, statistic_names
from riskloom.streaming.runs import MAX_PARTS, BatchTable, DayHistory, run_batches


#: Cards of a batch up to which they go into the scan of the history as a filter.
FEW_CARDS = 1_000


class RollingStream:
    """Keeps ``<path>/history`` and ``<path>/features``; rows need ``tx_id, card, us, amt``.

    By default every event gets its features, however late, and the result is that of the
    batch job.  ``max_days_late`` bounds the history instead: events more than so many days behind the newest
    one of earlier batches go to ``<path>/quarantine`` and days that no other event
    can reach are dropped.  ``last_day`` (days since 1970) is the last day a clock may show;
    later events go to the quarantine too and so move no line.  Events without a clock always do.
    """

    def __init__(
        self, spark: SparkSession, path: str, windows: Mapping[str, int], ticks_per_day: int = 86_400, limit: int = ROWS_PER_CARD,
        max_days_late: int | None = None, last_day: int | None = None, max_parts: int = MAX_PARTS,
    ):
        self.max_days_late, self.last_day = max_days_late, last_day
        self.windows, self.ticks_per_day, self.limit, self.path = dict(windows), ticks_per_day, limit, path
        self.reach = -(-max(self.windows.values()) // ticks_per_day)
        self.history = DayHistory(spark, f"{path}/history", ["card", "us"], max_parts)
        self.features = BatchTable(spark, f"{path}/features")
        self.quarantine = BatchTable(spark, f"{path}/quarantine")

    def step(self, batch: DataFrame, batch_id: int) -> None:
        day = F.floor(F.col("us") / F.lit(self.ticks_per_day))
        came = batch.select("tx_id", "card", "us", "amt", day.alias("day")).persist()
        try:
            usable = F.col("day").isNotNull()
            if self.last_day is not None:
                usable = usable & (F.col("day") <= self.last_day)
            # Earlier batches only, so a retry draws the same line.
            newest = self.history.newest(batch_id) if self.max_days_late is not None else None
            if newest is not None:
                usable = usable & (F.col("day") >= newest - self.max_days_late)
            usable = F.coalesce(usable, F.lit(False))
            # One row per day of the batch.
            counts = came.groupBy("day", usable.alias("usable")).agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first")).collect()
            if any(not r.usable for r in counts):
                self.quarantine.write(came.filter(~usable).drop("day"), batch_id)
            inside = [r for r in counts if r.usable]
            if not inside:
                return
            new = came.filter(usable)
            if newest is not None:
                self.history.drop_before(newest - self.max_days_late - self.reach)
            near = {r.day + d for r in inside for d in range(-self.reach, self.reach + 1)}
            self.history.compact(new.drop("day").schema, near, batch_id)
            self.features.write(self._emit(new.drop("day"), near, min(r.first for r in inside), batch_id), batch_id)
            # Written last: a batch that fails half-way is not its own history when retried.
            self.history.write(new, batch_id)
        finally:
            came.unpersist()

    def _emit(self, new: DataFrame, days: set[int], first: int, batch_id: int) -> DataFrame:
        rows = new.withColumn("_new", F.lit(1.0))
        known = self.history.read(new.schema, days, batch_id)
        late = False
        if known is not None:
            own = self._of_cards(known, new)
            rows = rows.unionByName(own.withColumn("_new", F.lit(None).cast("double")))
            late = not own.filter(F.col("us") > first).isEmpty()
        names = [n for w in self.windows for n in statistic_names(w).values()]
        rolled = rolling_past(rows, "card", "us", "amt", self.windows, limit=self.limit)
        changed = F.col("_new").isNotNull()
        if late:
            longest = max(self.windows.values())
            rolled = rolling_past(rolled, "card", "us", "_new", {"w": longest}, prefix="_late", limit=self.limit)
            changed = changed | (F.col("_late_count_w") > 0)
        return rolled.filter(changed).select("tx_id", "card", "us", *names)

    def _of_cards(self, known: DataFrame, new: DataFrame) -> DataFrame:
        cards = new.select("card").distinct()
        few = [r.card for r in cards.limit(FEW_CARDS + 1).collect()]
        if len(few) > FEW_CARDS:
            return null_safe(known, cards, ["card"], "left_semi")
        wanted = F.col("card").isin([c for c in few if c is not None])
        return known.filter(wanted | F.col("card").isNull() if None in few else wanted)

    def run(self, stream: DataFrame) -> None:
        run_batches(stream, f"{self.path}/checkpoint", self.step)

    def current(self) -> DataFrame:
        """The newest features of every transaction."""
        return self.features.latest("tx_id")
