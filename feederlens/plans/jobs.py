"""Batch jobs: the whole analysis over files, and the small jobs around it."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from feederlens.operators.dimension import attach_dimension, clean_dimension, typed_dimension
from feederlens.operators.episodes import (
    episodes, final_rows, late_copies, late_rows, marks, online_rows,
)
from feederlens.operators.latest import split_late
from feederlens.operators.parsing import dedup_readings, parse_lines
from feederlens.operators.power import primary_readings, stored_readings
from feederlens.operators.runs import track
from feederlens.operators.textlines import compact_lines
from feederlens.settings import Limits
from feederlens.sources import files, jdbc, kafka
from feederlens.sources.daytables import DayTables
from feederlens.sources.storage import staged
from feederlens.streaming.state import StateStore


def load_rates(lines: DataFrame, dimension: DataFrame) -> DataFrame:
    """Raw lines and the raw dimension to primary readings."""
    readings = dedup_readings(parse_lines(lines))
    return primary_readings(attach_dimension(readings, clean_dimension(dimension)))


def status_rows(readings: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All status rows of readings (mp_id, time, loadrate): final, added and late ones."""
    return final_rows(track(readings, limits), limits).unionByName(
        late_rows(late_copies(readings))
    )


def analyse(
    lines: DataFrame, dimension: DataFrame, root: str, limits: Limits = Limits(),
    batch: int | None = None, work_folder: str | None = None,
) -> DataFrame:
    """Writes the day tables for a body of lines as one batch and returns the latest status per point.

    Without a number the batch is the one after the last committed one. It goes on from the state that
    the batches before left, so lines handed over in any number of batches, in the order of their
    times, give the same tables as in one; a committed batch is not written again. Every expensive step is
    computed once: the secondary and primary rows of the batch are read back for the steps that
    follow, and the tracked readings are staged for their outputs, in the folder that the
    session names for checkpoints or else in the given one or below ``root``.
    """
    spark = lines.sparkSession
    tables = DayTables(root, limits)
    store = StateStore(f"{root}/state", ledger=tables.ledger)
    view = tables.ledger.view(spark)
    if batch is None:
        batch = 0 if view.last is None else view.last + 1
    if view.committed(batch):
        return store.before(spark, batch + 1)
    tables.write("secondary", dedup_readings(parse_lines(lines)), batch)
    attached = attach_dimension(tables.read(spark, "secondary", batch=batch), clean_dimension(dimension))
    tables.write("primary", stored_readings(primary_readings(attached)), batch)
    rates = tables.read(spark, "primary", batch=batch).select("mp_id", "time", "loadrate")
    state, late = store.before(spark, batch, touched=rates), None
    with ExitStack() as stack:
        folder = work_folder or f"{root}/work"
        if state is not None:
            state = stack.enter_context(staged(state, folder))
            rates, late = split_late(rates, state)
        tracked = stack.enter_context(staged(track(rates, limits, state), folder))
        status = final_rows(tracked, limits).unionByName(late_rows(late_copies(rates)))
        tables.write("status", status if late is None else status.unionByName(late_rows(late)), batch)
        tables.write("episodes", episodes(tracked, limits), batch)
        tables.write("marks", marks(tracked), batch)
        store.save(spark, batch, online_rows(tracked))
    tables.commit(spark, batch)
    return store.before(spark, batch + 1)


def export_by_bounds(
    spark: SparkSession, db: jdbc.Database, table: str, column: str, lower: int, upper: int,
    output: str, partitions: int = 5,
) -> None:
    """Database table to CSV, read in equal parts of a numeric column."""
    files.write_csv(
        jdbc.read_by_bounds(spark, db, table, column, lower, upper, partitions), output
    )


def export_by_ranges(
    spark: SparkSession, db: jdbc.Database, columns: Sequence[str], table: str, key: str,
    bounds: Sequence[str], output: str,
) -> None:
    """Some columns of a database table to CSV, read in ranges of a text key."""
    wanted = jdbc.subquery(f"select {','.join(columns)} from {table}")
    files.write_csv(
        jdbc.read_by_predicates(spark, db, wanted, jdbc.range_predicates(key, bounds)), output
    )


def load_dimension(spark: SparkSession, path: str, db: jdbc.Database, table: str) -> None:
    """Transformer dimension from CSV into a database table."""
    jdbc.write_table(files.read_dimension_csv(spark, path), db, table)


def dimension_from_database(spark: SparkSession, db: jdbc.Database, table: str) -> DataFrame:
    wanted = jdbc.subquery(f"select mp_id, bl, capacity from {table}")
    return typed_dimension(jdbc.read_table(spark, db, wanted, fetch_size=700_000))


def compact_text(
    spark: SparkSession, path: str, wanted: str, output: str, parts: int | None = None
) -> None:
    """Lines with a given text from many small files to few sorted ones."""
    files.write_lines(compact_lines(files.read_lines(spark, path), wanted), output, parts)


def feed(spark: SparkSession, folder: str, brokers: str, topic: str) -> None:
    """Lines of all files of a folder to a topic, those of each file in their order."""
    kafka.feed_topic(files.numbered_lines(spark, folder), brokers, topic)
