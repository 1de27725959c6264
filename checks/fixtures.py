"""Readings, lines and a dimension derived from the driver's tables, always from all of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feederlens.functions.times import cut_to_ms
from feederlens.settings import UNUSABLE

AS_OF = "2024-01-15 12:00:00"
CUT = "2024-01-15 00:00:00"
EARLY = "2024-01-01 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def series(spark: SparkSession, sf_dir: str, key: str = "user_id div 50") -> DataFrame:
    """Load-rate readings; a measuring point stands for fifty users, so their number grows with the
    data while the time between readings stays."""
    return table(spark, sf_dir, "events").select(
        F.expr(key).alias("mp_id"), cut_to_ms(F.col("ts")).alias("time"),
        F.round(F.col("value") / 20, 4).alias("loadrate"),
    )


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``series``, but with unusable rates, and with times cut to minutes, so that different
    readings share a time."""
    minute = F.date_trunc("MINUTE", F.col("ts")).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        F.expr("user_id div 50").alias("mp_id"), minute.alias("time"),
        F.when(F.col("event_id") % 29 == 0, F.lit(UNUSABLE))
        .otherwise(F.round(F.col("value") / 20, 4)).alias("loadrate"),
    )


def lines(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """Raw lines with all sorts of defects; with ``copies`` all clicks come twice."""
    events = table(spark, sf_dir, "events")
    made = events.selectExpr(
        "event_id", "event_type", "CAST(user_id AS STRING) AS id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') AS stamp",
        "CAST(value AS STRING) AS v", "regexp_extract(props, '([0-9]+)', 1) AS k",
    ).selectExpr(
        "event_type",
        """concat(
            CASE WHEN event_id % 23 = 0 THEN '﻿ID ' ELSE '' END, id, '||',
            CASE WHEN event_id % 31 = 0 THEN 'not a time' ELSE stamp END, '||',
            CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE v END, '||',
            k, '||', k, '.5||  ', k, ' ||',
            k, '||-', k, '.75||+', k, '.25||',
            CASE WHEN event_id % 37 = 0 THEN 'a|b' ELSE k END, '||',
            v, '||', v, '00||12', k, '345||', k, '.123456||',
            '0.', k, '||.5||1e3||',
            CASE WHEN event_id % 19 = 0 THEN '||' ELSE '' END
        ) AS value""",
    )
    if copies:
        made = made.unionByName(made.where("event_type = 'click'"))
    return made.select("value")


def raw_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns as in a CSV file, some of which cannot be cast; two rows per key."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "CASE WHEN s_nationkey = 3 THEN s_name ELSE CAST(s_suppkey div 2 AS STRING) END AS c0",
        "CASE WHEN s_nationkey = 5 THEN '1.5' WHEN s_nationkey = 7 THEN ' 10 ' "
        "WHEN s_nationkey = 9 THEN NULL ELSE CAST(s_nationkey % 4 AS STRING) END AS c1",
        "CASE WHEN s_nationkey = 11 THEN 'none' "
        "WHEN s_acctbal < 0 THEN '0' ELSE CAST(s_acctbal AS STRING) END AS c2",
        "s_suppkey AS line",
    )


# The same derivations for the comparison engine.

SERIES = """SELECT user_id // 50 AS mp_id, epoch_us(ts) // 1000 AS ms, round(value / 20, 4) AS lr
FROM events"""

USER_SERIES = SERIES.replace("user_id // 50", "user_id")

ANOMALIES = """SELECT user_id // 50 AS mp_id, (epoch_us(ts) // 60000000) * 60000 AS ms,
  CASE WHEN event_id % 29 = 0 THEN CAST(9999.99 AS DOUBLE) ELSE round(value / 20, 4) END AS lr
FROM events"""

LINES = """SELECT event_type, concat(
  CASE WHEN event_id % 23 = 0 THEN '﻿ID ' ELSE '' END, CAST(user_id AS VARCHAR), '||',
  CASE WHEN event_id % 31 = 0 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END, '||',
  CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END, '||',
  k, '||', k, '.5||  ', k, ' ||', k, '||-', k, '.75||+', k, '.25||',
  CASE WHEN event_id % 37 = 0 THEN 'a|b' ELSE k END, '||',
  CAST(value AS VARCHAR), '||', CAST(value AS VARCHAR), '00||12', k, '345||', k, '.123456||',
  '0.', k, '||.5||1e3||',
  CASE WHEN event_id % 19 = 0 THEN '||' ELSE '' END) AS value
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events)"""

LINE_COPIES = f"SELECT value FROM ({LINES}) UNION ALL SELECT value FROM ({LINES}) WHERE event_type = 'click'"

RAW_DIMENSION = """SELECT
  CASE WHEN s_nationkey = 3 THEN s_name ELSE CAST(s_suppkey // 2 AS VARCHAR) END AS c0,
  CASE WHEN s_nationkey = 5 THEN '1.5' WHEN s_nationkey = 7 THEN ' 10 '
       WHEN s_nationkey = 9 THEN NULL ELSE CAST(s_nationkey % 4 AS VARCHAR) END AS c1,
  CASE WHEN s_nationkey = 11 THEN 'none'
       WHEN s_acctbal < 0 THEN '0' ELSE CAST(s_acctbal AS VARCHAR) END AS c2,
  s_suppkey AS line
FROM supplier"""
