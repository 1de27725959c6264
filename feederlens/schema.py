"""Column names and types of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The 16 measures of a reading, in the order of the raw line.
ACTIVE = ["zyggl", "azxyg", "bzxyg", "czxyg"]  # total, then phases A, B, C
REACTIVE = ["zwggl", "azxwg", "bzxwg", "czxwg"]
APPARENT = ["szgl", "aszgl", "bszgl", "cszgl"]
POWER_FACTOR = ["zglys", "aglys", "bglys", "cglys"]
POWERS = ACTIVE + REACTIVE + APPARENT
MEASURES = POWERS + POWER_FACTOR

# Start and duration columns of a status row, one pair per load level.
STARTS = ["ths", "tos", "tos1", "tos2", "tos3", "tos4", "tos5"]
DURATIONS = ["thd", "tod", "tod1", "tod2", "tod3", "tod4", "tod5"]

SECONDARY_COLUMNS = ["mp_id", "time", *MEASURES]
PRIMARY_COLUMNS = ["mp_id", "time", "loadrate", "maxpower", *MEASURES]
STATUS_COLUMNS = ["mp_id", "time", *STARTS, *DURATIONS, "status", "overloadstatus", "loadrate"]
EPISODE_COLUMNS = ["mp_id", "status", "overloadstatus", "ts", "te", "td"]
MARK_COLUMNS = ["mp_id", "status", "overloadstatus", "start", "confirmed"]

_KINDS = {
    "mp_id": T.LongType(),
    "status": T.IntegerType(),
    "overloadstatus": T.IntegerType(),
    "td": T.LongType(),
    "capacity": T.DoubleType(),
    "bl": T.StringType(),
    **{c: T.TimestampNTZType() for c in ["time", "ts", "te", "start", "confirmed", *STARTS]},
    **{c: T.LongType() for c in DURATIONS},
    **{c: T.DoubleType() for c in ["loadrate", "maxpower", *MEASURES]},
}


def table_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _KINDS[c]) for c in columns])


DIMENSION_SCHEMA = table_schema(["mp_id", "bl", "capacity"])
STATUS_SCHEMA = table_schema(STATUS_COLUMNS)
