"""Latest status per measuring point and lookups in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from feederlens.operators.dimension import salted_lookup
from feederlens.schema import DURATIONS, STARTS, STATUS_COLUMNS
from feederlens.settings import LATE, NO_OVERLOAD, NORMAL, UNUSABLE


def latest(rows: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Newest status row of each point over earlier and new rows; late rows never count.

    The first row of a window in falling order of time is also taken before the exchange, so a point with
    very many rows costs one row per task. No struct of all columns is aggregated, which Spark could only do
    by sorting too, and row by row.
    """
    if previous is not None:
        rows = rows.unionByName(previous)
    newest = F.row_number().over(Window.partitionBy("mp_id").orderBy(F.desc("time")))
    return (
        rows.where(F.col("status") != LATE)
        .select(*STATUS_COLUMNS, newest.alias("_place"))
        .where("_place = 1")
        .select(*STATUS_COLUMNS)
    )


def in_range(state: DataFrame, lowest: int, highest: int) -> DataFrame:
    return state.where(F.col("mp_id").between(lowest, highest))


def lookup(keys: DataFrame, state: DataFrame) -> DataFrame:
    """State of each distinct key, the starting state for keys not seen before."""
    known = keys.select("mp_id").distinct().join(state, "mp_id", "left")
    start = {
        **{c: F.lit(0).cast("bigint") for c in DURATIONS},
        "status": F.lit(NORMAL),
        "overloadstatus": F.lit(NO_OVERLOAD),
        "loadrate": F.lit(UNUSABLE),
    }
    return known.withColumns({c: F.coalesce(F.col(c), v) for c, v in start.items()}).select(
        *STATUS_COLUMNS
    )


def new_keys(keys: DataFrame, state: DataFrame) -> DataFrame:
    return keys.select("mp_id").distinct().join(state.select("mp_id"), "mp_id", "left_anti")


def with_sentinel_times(rows: DataFrame) -> DataFrame:
    """Missing start times as one second after the epoch, for stores that cannot hold NULL or 0."""
    none = F.lit("1970-01-01 00:00:01").cast("timestamp_ntz")
    return rows.withColumns({c: F.coalesce(F.col(c), none) for c in STARTS})


def split_late(readings: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings after the stored time of their point, and those at or before it."""
    seen = state.select("mp_id", F.col("time").alias("seen_until"))
    joined = salted_lookup(readings, seen, "left").select(*readings.columns, "seen_until")
    late = F.coalesce(F.col("time") <= F.col("seen_until"), F.lit(False))
    return joined.where(~late).drop("seen_until"), joined.where(late).drop("seen_until")
