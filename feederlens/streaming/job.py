"""The load-rate stream: every micro-batch of raw lines goes through the same steps as a table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from feederlens.operators.dimension import attach_dimension, clean_dimension
from feederlens.operators.episodes import (
    episodes, final_rows, late_copies, late_rows, marks, online_rows,
)
from feederlens.operators.latest import split_late
from feederlens.operators.parsing import dedup_readings, parse_lines, recent
from feederlens.operators.power import primary_readings, stored_readings
from feederlens.operators.runs import track
from feederlens.settings import Limits
from feederlens.sources.daytables import DayTables
from feederlens.sources.storage import delete, exists, read_text, write_text
from feederlens.streaming.dimension import DimensionVersions
from feederlens.streaming.interval import trigger_interval
from feederlens.streaming.state import StateStore

#: Batches of which ``LoadJob.counts`` knows the readings; commits keep the numbers of all others.
KEPT_COUNTS = 1000


@dataclass
class LoadJob:
    """Handles micro-batches of lines; everything it keeps is below ``root``.

    A batch writes its tables and its state and then commits them all at once: readers see either the
    whole batch or nothing of it, and a batch that is committed is not handled again. What decides on the
    result of a batch, its clock time and the version of the dimension, is kept at its first attempt, so
    an attempt after a failure gives the same rows.

    ``dimension`` is called in every batch, so a changed transformer table counts at once; with
    ``refresh_weekday`` (0 is Sunday) it is kept and only called anew once on each such day.
    ``as_of`` replaces the clock for the 24-hour filter.
    """

    root: str
    dimension: Callable[[SparkSession], DataFrame]
    limits: Limits = field(default_factory=Limits)
    as_of: str | None = None
    state_base_every: int = 50
    refresh_weekday: int | None = None
    counts: dict[int, int] = field(default_factory=dict)
    state_buckets: int = 64
    _kept: tuple[date, str] | None = field(default=None, repr=False)

    @property
    def tables(self) -> DayTables:
        return DayTables(f"{self.root}/tables", self.limits)

    @property
    def state(self) -> StateStore:
        return StateStore(f"{self.root}/state", self.state_base_every, self.state_buckets, self.tables.ledger)

    @property
    def dimensions(self) -> DimensionVersions:
        return DimensionVersions(f"{self.root}/dimension")

    def _plan_path(self, batch: int) -> str:
        return f"{self.root}/plans/batch-{batch}"

    def _plan(self, spark: SparkSession, batch: int) -> dict[str, str]:
        """Clock time and dimension version of a batch, as its first attempt found them."""
        path = self._plan_path(batch)
        if not exists(spark, path):
            now = self.as_of or str(spark.range(1).select(F.localtimestamp()).first()[0])
            write_text(spark, path, json.dumps({"now": now, "dimension": self._version(spark, now)}))
        return json.loads(read_text(spark, path))

    def _version(self, spark: SparkSession, now: str) -> str:
        today = date.fromisoformat(now[:10])
        due = self.refresh_weekday is None or self._kept is None or (
            today.isoweekday() % 7 == self.refresh_weekday and self._kept[0] != today
        )
        if due:
            cleaned = clean_dimension(self.dimension(spark))
            self._kept = (today, self.dimensions.put(spark, cleaned))
        return self._kept[1]

    def _dimension(self, spark: SparkSession, now: str) -> DataFrame:
        return self.dimensions.get(spark, self._version(spark, now))

    def _count(self, batch: int, readings: int) -> None:
        self.counts[batch] = readings
        while len(self.counts) > KEPT_COUNTS:
            del self.counts[next(iter(self.counts))]

    def process(self, lines: DataFrame, batch: int) -> None:
        """One micro-batch: readings, primary values, status rows, episodes, marks, state."""
        spark = lines.sparkSession
        if lines.isEmpty() or self.tables.is_committed(spark, batch):
            return
        seen = Observation(f"batch-{batch}")
        plan = self._plan(spark, batch)
        readings = dedup_readings(recent(parse_lines(lines), plan["now"])).persist()
        kept = [readings]
        try:
            counted = readings.observe(seen, F.count(F.lit(1)).alias("readings"))
            self.tables.write("secondary", counted, batch)
            self._count(batch, seen.get["readings"])
            dimension = self.dimensions.get(spark, plan["dimension"])
            primary = primary_readings(attach_dimension(readings, dimension)).persist()
            kept.append(primary)
            self.tables.write("primary", stored_readings(primary), batch)

            fresh, late = primary.select("mp_id", "time", "loadrate"), None
            state = self.state.before(spark, batch, touched=primary)
            if state is not None:
                state = state.persist()
                kept.append(state)
                fresh, late = split_late(fresh, state)
            tracked = track(fresh, self.limits, state).persist()
            kept.append(tracked)
            status = final_rows(tracked, self.limits).unionByName(late_rows(late_copies(fresh)))
            if late is not None:
                status = status.unionByName(late_rows(late))
            _together(
                spark,
                lambda: self.tables.write("status", status, batch),
                lambda: self.tables.write("episodes", episodes(tracked, self.limits), batch),
                lambda: self.tables.write("marks", marks(tracked), batch),
                lambda: self.state.save(spark, batch, online_rows(tracked)),
            )
        finally:
            for df in kept:
                df.unpersist()
        self.tables.commit(spark, batch, {**plan, "readings": self.counts[batch]})
        delete(spark, self._plan_path(batch))

    def _claim(self, spark: SparkSession, folder: str) -> None:
        """Root and checkpoint belong together: batch numbers of another checkpoint would be taken for
        batches that are committed here."""
        ours, theirs = f"{self.root}/checkpoint-id", f"{folder}/root-id"
        known, there = (read_text(spark, p) if exists(spark, p) else None for p in (ours, theirs))
        fresh = not self.tables.ledger.exists(spark)
        if there is None and fresh:
            mark = known or uuid.uuid4().hex  # known: the first start ended between the two
            if known is None:
                write_text(spark, ours, mark)
            write_text(spark, theirs, mark)
        elif known is None or known != there:
            raise ValueError(
                f"{self.root} already has batches of another checkpoint than {folder}; "
                "go on with that checkpoint or take a new root"
            )

    def start(
        self, lines: DataFrame, interval: str | None = "5 second", checkpoint: str | None = None,
        name: str = "load_rates",
    ) -> StreamingQuery:
        """Starts the stream. Without an interval it handles what is there and ends.

        The checkpoint belongs to the root: jobs with other roots have their own, and a used root is refused
        with another checkpoint. The source position is committed after ``process`` returns, that is, after
        all outputs.
        """
        folder = checkpoint or f"{self.root}/checkpoints/{name}"
        self._claim(lines.sparkSession, folder)
        writer = (
            lines.writeStream.queryName(name)
            .option("checkpointLocation", folder)
            .foreachBatch(self.process)
        )
        if interval is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=trigger_interval(interval)).start()


def _together(spark: SparkSession, *outputs: Callable[[], None]) -> None:
    """Runs independent outputs of one cached frame as concurrent Spark jobs; they are small, and one
    after the other they would leave most cores idle. The first error is raised after all ended."""
    with ThreadPoolExecutor(len(outputs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(o)) for o in outputs]
    for future in running:
        future.result()


def batch_durations(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch, milliseconds) of the recent batches of a query."""
    return [(p.batchId, p.batchDuration) for p in query.recentProgress]
