"""The registered queries: one per operator of the library, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import (
    AS_OF, CUT, EARLY, anomalies, lines, raw_dimension, series, table,
)
from feederlens.functions.numbers import format_double
from feederlens.functions.times import cut_to_ms, from_ms, refresh_due
from feederlens.operators import episodes as E
from feederlens.operators import latest as L
from feederlens.operators.dimension import attach_dimension, clean_dimension, typed_dimension
from feederlens.operators.parsing import batch_days, dedup_readings, parse_lines, recent
from feederlens.operators.power import primary_readings, stored_readings
from feederlens.operators.runs import LEVELS, track
from feederlens.operators.textlines import compact_lines, peek
from feederlens.plans import jobs
from feederlens.sources.jdbc import range_predicates
from feederlens.schema import DURATIONS, POWERS

Query = Callable[[SparkSession, str], DataFrame]
NAME_BOUNDS = ["Customer#000000040", "Customer#000000090", "Customer#000000130"]


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The last row of a key is the one with the highest line number."""
    return clean_dimension(typed_dimension(raw_dimension(spark, sf)), order=F.col("line"))


def _attached(spark: SparkSession, sf: str) -> DataFrame:
    readings = dedup_readings(parse_lines(lines(spark, sf)))
    return attach_dimension(readings, _dimension(spark, sf))


def _primary(spark: SparkSession, sf: str) -> DataFrame:
    return primary_readings(_attached(spark, sf))


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.date_format("time", "yyyyMMdd"))


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = series(spark, sf)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return rows.where(F.col("time") < cut), rows.where(F.col("time") >= cut)


def _state(readings: DataFrame) -> DataFrame:
    return L.latest(E.online_rows(track(readings)))


def _user_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = series(spark, sf, key="user_id")
    return _state(rows.where(F.col("time") < F.lit(EARLY).cast("timestamp_ntz")))


def predicate_counts(customers: DataFrame) -> DataFrame:
    """Rows that each predicate of a partitioned read finds, all in one scan; parts without rows are left out."""
    parts = range_predicates("c_name", NAME_BOUNDS)
    counts = customers.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(parts)])
    listed = ", ".join(f"{i}, p{i}" for i in range(len(parts)))
    return counts.selectExpr(f"stack({len(parts)}, {listed}) AS (part, customers)").where("customers > 0")


def lag_readings(spark: SparkSession, sf: str) -> DataFrame:
    return track(series(spark, sf)).select(
        "mp_id", from_ms(F.col("ms")).alias("time"), F.col("lr").alias("loadrate"),
        from_ms(F.col("pt")).alias("previous_time"), F.col("plr").alias("previous_loadrate"),
    )


def run_starts(spark: SparkSession, sf: str) -> DataFrame:
    levels = ", ".join(f"{i}, s{i}" for i in LEVELS)
    return (
        track(series(spark, sf))
        .selectExpr("mp_id", f"stack({len(LEVELS)}, {levels}) AS (level, start_ms)")
        .where("start_ms IS NOT NULL")
        .select("mp_id", "level", from_ms(F.col("start_ms")).alias("start"))
        .distinct()
    )


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Errors from before the cut come again with the second batch: they are late."""
    first, _ = _parts(spark, sf)
    batch = (
        table(spark, sf, "events")
        .where((F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")) | (F.col("event_type") == "error"))
        .select(F.expr("user_id div 50").alias("mp_id"), cut_to_ms(F.col("ts")).alias("time"))
    )
    seen = first.groupBy("mp_id").agg(F.max("time").alias("time"))
    return E.late_rows(L.split_late(batch, seen)[1])


def status_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """The second half of the series, from the state that the first half left."""
    first, second = _parts(spark, sf)
    return E.online_rows(track(second, state=_state(first)))


def status_repaired(spark: SparkSession, sf: str) -> DataFrame:
    """Rows stored by two batches, with the confirmations of the second applied to the first."""
    first, second = _parts(spark, sf)
    one, two = track(first), track(second, state=_state(first))
    stored = E.final_rows(one).unionByName(E.final_rows(two))
    return E.apply_marks(stored, E.marks(one).unionByName(E.marks(two)))


def queries() -> dict[str, Query]:
    return {
        "parse_lines": lambda s, d: parse_lines(lines(s, d)),
        "recent_24h": lambda s, d: recent(series(s, d), AS_OF),
        "dedup_readings": lambda s, d: dedup_readings(parse_lines(lines(s, d, copies=True))),
        "dim_load": lambda s, d: typed_dimension(raw_dimension(s, d).select("c0", "c1", "c2")),
        "dim_clean": _dimension,
        "join_dim": lambda s, d: _attached(s, d).select(
            "mp_id", "time", "zyggl", "zwggl", "ratio", "capacity"
        ),
        "format_double": lambda s, d: table(s, d, "lineitem").select(
            "l_orderkey", "l_linenumber",
            format_double(F.col("l_extendedprice") / 7 - 5000).alias("formatted"),
        ),
        "primary_values": lambda s, d: _primary(s, d).select("mp_id", "time", *POWERS),
        "max_power": lambda s, d: _primary(s, d).select("mp_id", "time", "maxpower"),
        "load_rate": lambda s, d: _primary(s, d).select("mp_id", "time", "loadrate"),
        "primary_day": lambda s, d: _with_day(stored_readings(_primary(s, d))),
        "secondary_day": lambda s, d: _with_day(
            stored_readings(dedup_readings(parse_lines(lines(s, d))))
        ),
        "batch_days": lambda s, d: batch_days(series(s, d)),
        "lag_readings": lag_readings,
        "level_runs": lambda s, d: E.online_rows(track(series(s, d))).select(
            "mp_id", "time", "loadrate", *DURATIONS
        ),
        "run_starts": run_starts,
        "status_online": lambda s, d: E.online_rows(track(series(s, d))),
        "episodes": lambda s, d: E.episodes(track(series(s, d))),
        "status_marks": lambda s, d: E.marks(track(series(s, d))),
        "status_backfilled": lambda s, d: E.final_rows(track(series(s, d))),
        "status_rows": lambda s, d: jobs.status_rows(anomalies(s, d)),
        "status_from_state": status_from_state,
        "status_repaired": status_repaired,
        "late_rows": late_rows,
        "latest_status": lambda s, d: _state(series(s, d)),
        "latest_status_range": lambda s, d: L.in_range(
            _state(series(s, d, key="user_id")), 10, 99
        ),
        "state_lookup": lambda s, d: L.lookup(
            series(s, d, key="user_id"), _user_state(s, d)
        ),
        "new_keys": lambda s, d: L.new_keys(series(s, d, key="user_id"), _user_state(s, d)),
        "refresh_due": lambda s, d: table(s, d, "orders").select(
            "o_orderkey", refresh_due(F.col("o_orderdate")).alias("due")
        ),
        "text_compact": lambda s, d: compact_lines(lines(s, d), "77"),
        "peek_limit": lambda s, d: peek(
            table(s, d, "events").select("event_id", "event_type", "value"), "event_id", 100
        ),
        "predicate_partition_scan": lambda s, d: predicate_counts(table(s, d, "customer")),
    }
