"""Meter-side readings to grid-side values with apparent power and load rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.functions.numbers import format_double, load_rate, max_power, scaled
from feederlens.schema import ACTIVE, MEASURES, POWERS, PRIMARY_COLUMNS, REACTIVE


def primary_readings(attached: DataFrame) -> DataFrame:
    """Readings with ``ratio`` and ``capacity`` to primary readings. Power factors are kept."""
    values = attached.withColumns({c: scaled(F.col(c), F.col("ratio")) for c in POWERS})
    power = max_power([F.col(c) for c in ACTIVE], [F.col(c) for c in REACTIVE])
    return (
        values.withColumn("maxpower", power)
        .withColumn("loadrate", load_rate(F.col("maxpower"), F.col("capacity")))
        .select(*PRIMARY_COLUMNS)
    )


def stored_readings(readings: DataFrame) -> DataFrame:
    """Readings as they are stored: every number limited and rounded to four decimals.

    ``loadrate`` and the measures of parsed lines are already in that form, so storing them again
    changes nothing.
    """
    numbers = [c for c in ["loadrate", "maxpower", *MEASURES] if c in readings.columns]
    return readings.withColumns({c: format_double(F.col(c)) for c in numbers})
