"""Jobs on raw text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.operators.parsing import DELIMITER, without_prefix


def compact_lines(lines: DataFrame, wanted: str, column: str = "value") -> DataFrame:
    """Lines that contain a text after their junk prefix, globally sorted by their second field.

    The line itself is the second sort key: that fixes the order of ties and lets the range
    partitioner split a time that very many lines share.
    """
    line = F.col(column)
    return (
        lines.where(F.contains(without_prefix(line), F.lit(wanted)))
        .select(F.get(F.split(line, DELIMITER, -1), F.lit(1)).alias("at"), line.alias("line"))
        .sort("at", "line")
        .select("line")
    )


def peek(records: DataFrame, position: str, start: int, count: int = 20) -> DataFrame:
    """The first records from a position on."""
    return records.where(F.col(position) >= start).orderBy(position).limit(count)
