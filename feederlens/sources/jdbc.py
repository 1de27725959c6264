"""Partitioned JDBC reads and table writes. Connection data always comes from the caller."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)  # driver, user, password


def subquery(select: str, alias: str = "t") -> str:
    """A SELECT in place of a table name, so that its projection runs in the database."""
    return f"({select}) {alias}"


def read_table(spark: SparkSession, db: Database, table: str, fetch_size: int = 10_000) -> DataFrame:
    return spark.read.option("fetchsize", fetch_size).jdbc(db.url, table, properties=db.properties)


def read_by_bounds(
    spark: SparkSession, db: Database, table: str, column: str, lower: int, upper: int,
    partitions: int = 5, fetch_size: int = 5_000,
) -> DataFrame:
    """One query per equal part of a numeric range. The bounds only shape the parts: rows outside
    them are read by the first and last one."""
    return spark.read.option("fetchsize", fetch_size).jdbc(
        db.url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=db.properties,
    )


def read_by_predicates(
    spark: SparkSession, db: Database, table: str, predicates: Sequence[str],
    fetch_size: int = 10_000,
) -> DataFrame:
    """One query per predicate; they must not overlap (see ``range_predicates``)."""
    return spark.read.option("fetchsize", fetch_size).jdbc(
        db.url, table, predicates=list(predicates), properties=db.properties
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """Predicates that read every row exactly once: ranges between increasing text bounds, what lies
    below and above them, and NULL keys."""
    if not bounds or list(bounds) != sorted(set(bounds)):
        raise ValueError("bounds must be increasing and distinct")
    inner = [
        f"{column} >= {_quoted(a)} AND {column} < {_quoted(b)}" for a, b in zip(bounds, bounds[1:])
    ]
    return [
        f"{column} < {_quoted(bounds[0])}", *inner, f"{column} >= {_quoted(bounds[-1])}",
        f"{column} IS NULL",
    ]


def range_faults(ranges: Sequence[tuple[str, str | None]]) -> list[str]:
    """What is wrong with a list of [low, high) ranges: overlaps, which read rows twice, and holes,
    which lose rows. An open end is None."""
    faults = []
    ordered = sorted(ranges, key=lambda r: (r[0], r[1] is None, r[1] or ""))
    reach, last = None, None
    for low, high in ordered:
        if last is not None:
            if reach is None or low < reach:
                faults.append(f"overlap: {last} and {(low, high)}")
            elif low > reach:
                faults.append(f"hole: {reach} to {low}")
        if last is None or (reach is not None and (high is None or high > reach)):
            reach, last = high, (low, high)
    return faults


def write_table(
    df: DataFrame, db: Database, table: str, keep_definition: bool = True, batch_size: int = 40_000
) -> None:
    """Replaces the rows of a table; its definition is kept unless told otherwise."""
    (
        df.write.mode("overwrite")
        .option("truncate", str(keep_definition).lower())
        .option("batchsize", batch_size)
        .jdbc(db.url, table, properties=db.properties)
    )
