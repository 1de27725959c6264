"""Time rules. Event times are zone-less timestamps; arithmetic runs on epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Fixed value: year-month-day and a time of day with optional fraction; a bare date is no time.
TIME_FORM = (
    r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(?:\.[0-9]{1,9})?"
)
TIME_PATTERN = rf"\A{TIME_FORM}\z"


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _session_in_utc() -> bool:
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else ""
    return zone in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def to_ms(time: Column) -> Column:
    """Milliseconds since 1970 as the clock of the readings counts them, in any session zone.

    Going through an instant is the cheapest way, but only in UTC is it the same: elsewhere clock
    times that daylight saving skips would move.
    """
    if _session_in_utc():
        return F.unix_millis(time.cast("timestamp"))
    return F.timestamp_diff("MILLISECOND", epoch(), time)


def from_ms(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, epoch())


def cut_to_ms(time: Column) -> Column:
    return from_ms(to_ms(time))


def parse_time(text: Column) -> Column:
    return cut_to_ms(F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz")))


def day_text(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd")


def refresh_due(day: Column, weekday: int = 2) -> Column:
    """Whether a day is the one for reloading the dimension; 0 is Sunday, the default Tuesday."""
    return F.dayofweek(day) - 1 == weekday
