"""The transformer dimension: ratio and capacity per measuring point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feederlens.functions.numbers import ratio

#: Readings of one point meet a keyed table in so many tasks, should the join be shuffled.
SALTS = 8


def typed_dimension(raw: DataFrame) -> DataFrame:
    """The first three, untyped columns (key, ratio text, capacity) named and cast; bad values become
    NULL. Further columns, such as a line number, are kept as they are."""
    key, text, capacity, *others = raw.columns
    return raw.select(
        F.col(key).try_cast("bigint").alias("mp_id"),
        F.col(text).cast("string").alias("bl"),
        F.col(capacity).try_cast("double").alias("capacity"),
        *others,
    )


def clean_dimension(dimension: DataFrame, order: Column | None = None) -> DataFrame:
    """One row per point with a numeric ratio; a missing capacity counts as 0.

    Of several rows of a point the one that is last by ``order`` counts; by default that is the one
    with the highest ratio, then the highest capacity, as a table has no scan order.
    """
    rows = dimension.where(F.col("mp_id").isNotNull()).select(
        "mp_id",
        ratio(F.col("bl")).alias("ratio"),
        F.coalesce(F.col("capacity"), F.lit(0.0)).alias("capacity"),
        (order if order is not None else F.lit(0)).alias("position"),
    )
    last = F.max(F.struct("position", "ratio", "capacity")).alias("last")
    return rows.groupBy("mp_id").agg(last).select("mp_id", "last.ratio", "last.capacity")


def salted_lookup(readings: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Joins readings to a table with one row per ``mp_id``; its rows are repeated for all salts.

    Spark chooses the form of the join by its own sizes. If it shuffles, the readings of a point
    with very many of them are spread by their times and first values, and what follows has to exchange
    them anew. Two columns are enough for that; a hash of all of them would cost more than the join.
    """
    salt = F.pmod(F.hash(*[c for c in readings.columns if c != "mp_id"][:2]), F.lit(SALTS))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return readings.withColumn("_salt", salt).join(copies, ["mp_id", "_salt"], how).drop("_salt")


def attach_dimension(readings: DataFrame, dimension: DataFrame) -> DataFrame:
    """Readings of points with a ratio, with ``ratio`` and ``capacity``."""
    usable = dimension.where(F.col("ratio") != 0)
    return salted_lookup(readings, usable).select(*readings.columns, "ratio", "capacity")
