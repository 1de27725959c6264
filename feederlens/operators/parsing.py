"""Raw lines to readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from feederlens.functions.numbers import measure, plain_number, strip
from feederlens.functions.times import TIME_FORM, day_text, parse_time
from feederlens.schema import MEASURES, SECONDARY_COLUMNS
from feederlens.settings import FIELD_COUNT

DELIMITER = r"\|\|"
_BLANK = r"[\x00-\x20]*"
# A good line has exactly so many fields and no single delimiter sign inside one. Its first field
# is a whole number after any junk without digits, such as a byte order mark; its second is a full
# time. One pattern for all of it means that a bad line is dropped before it is split.
LINE_PATTERN = (
    rf"\A[^0-9|]*+[0-9]++{_BLANK}\|\|{_BLANK}{TIME_FORM}{_BLANK}"
    rf"(?:\|\|[^|]*+){{{FIELD_COUNT - 2}}}\z"
)


def without_prefix(line: Column) -> Column:
    """The line from its first digit on: drops a byte order mark and other junk."""
    return F.regexp_replace(line, "^[^0-9]*", "")


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Readings of the well-formed lines; measures that are no numbers become unusable.

    Lines without a whole-number key or a full time are dropped.
    """
    line = F.col(column)
    # The generator keeps Catalyst from copying the split into the filters and columns that use it.
    fields = lines.where(line.rlike(LINE_PATTERN)).select(
        F.explode(F.array(F.split(line, DELIMITER, -1))).alias("f")
    )
    texts = fields.select(
        F.regexp_extract(F.col("f")[0], "[0-9]+", 0).try_cast("bigint").alias("mp_id"),
        parse_time(strip(F.col("f")[1])).alias("time"),
        *[F.col("f")[i + 2].alias(f"t{i}") for i in range(len(MEASURES))],
    ).where(F.col("mp_id").isNotNull() & F.col("time").isNotNull())
    numbers = texts.select(
        "mp_id", "time",
        *[F.col(f"t{i}") for i in range(len(MEASURES))],
        *[plain_number(F.col(f"t{i}")).alias(f"n{i}") for i in range(len(MEASURES))],
    )
    return numbers.select(
        "mp_id", "time",
        *[measure(F.col(f"n{i}"), F.col(f"t{i}")).alias(c) for i, c in enumerate(MEASURES)],
    )


def recent(readings: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Readings of the 24 hours up to ``as_of`` (now when not given), both ends included."""
    if as_of is None:
        now = F.localtimestamp()
    else:
        now = F.lit(str(as_of)).cast("timestamp_ntz")
    day = F.expr("INTERVAL 1 DAY")
    return readings.where(F.col("time").between(now - day, now))


def dedup_readings(readings: DataFrame) -> DataFrame:
    """Exact copies removed. They are combined on the map side, before the shuffle."""
    return readings.select(*SECONDARY_COLUMNS).distinct()


def batch_days(readings: DataFrame) -> DataFrame:
    return readings.select(day_text(F.col("time")).alias("day")).distinct()
