"""Tables derived from tracked readings: status rows, episodes, marks and the state to carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feederlens.functions.times import from_ms, to_ms
from feederlens.operators.runs import LEVELS, crossing, points
from feederlens.schema import EPISODE_COLUMNS, MARK_COLUMNS, STATUS_COLUMNS
from feederlens.settings import HEAVY, LATE, MINUTE, NO_OVERLOAD, OVERLOAD, UNUSABLE, Limits

_COPIES_PER_TASK = 100_000  # how many late copies one row is unfolded into at a time
_NONE = "CAST(NULL AS BIGINT)"
_ZERO = "0L"


def _time(ms: str) -> str:
    return f"timestampadd(MILLISECOND, {ms}, TIMESTAMP_NTZ '1970-01-01 00:00:00')"


def _status_columns(
    ms: str, starts: list[str], minutes: list[str], status: str, klass: str, rate: str
) -> list[str]:
    values = [
        "mp_id", _time(ms), *[_time(s) for s in starts], *minutes,
        f"CAST({status} AS INT)", f"CAST({klass} AS INT)", rate,
    ]
    return [f"{v} AS {name}" for v, name in zip(values, STATUS_COLUMNS)]


def _duration(start: str, end: str = "ms") -> str:
    return f"coalesce(({end} - {start}) DIV {MINUTE}, {_ZERO})"


def online_rows(tracked: DataFrame) -> DataFrame:
    """Status of each reading as known at its own time."""
    starts = [f"s{i}" for i in LEVELS]
    return tracked.selectExpr(
        *_status_columns("ms", starts, [_duration(s) for s in starts], "status", "klass", "lr")
    )


_HEAVY_ENDS = f"(pstatus = {HEAVY} AND status NOT IN ({HEAVY}, {OVERLOAD}))"


def _with_heavy_end(tracked: DataFrame, limits: Limits) -> DataFrame:
    """Adds where a heavy run that ends at this reading met its level.

    A reading that is still above the level has no crossing behind it; then, as after a gap or
    without a usable load rate, the run ends with the previous reading.
    """
    met = crossing(limits.levels[0])
    return tracked.withColumn(
        "heavy_end", F.expr(f"CASE WHEN {met} BETWEEN pt AND ms THEN {met} ELSE pt END")
    )


def episodes(tracked: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Closed heavy-load and overload episodes; a reading closes at most one."""
    over = limits.levels[1]
    fell = f"near AND plr > {over}D AND lr <= {over}D"
    closed = _with_heavy_end(
        tracked.where(f"pstatus IN ({HEAVY}, {OVERLOAD}) AND status <> pstatus"), limits
    ).selectExpr(
        "mp_id", "pstatus", "pklass",
        f"CASE WHEN pstatus = {OVERLOAD} THEN ps1 ELSE ps0 END AS ts_ms",
        f"CASE WHEN pstatus = {OVERLOAD} THEN "
        f"CASE WHEN {fell} THEN {crossing(over)} ELSE pt END "
        f"WHEN status = {OVERLOAD} THEN s1 ELSE heavy_end END AS te_ms",
    )
    return closed.where("ts_ms IS NOT NULL").selectExpr(
        "mp_id", "CAST(pstatus AS INT) AS status", "CAST(pklass AS INT) AS overloadstatus",
        f"{_time('ts_ms')} AS ts", f"{_time('te_ms')} AS te",
        f"(te_ms - ts_ms) DIV {MINUTE} AS td",
    ).select(*EPISODE_COLUMNS)


def final_rows(tracked: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Status rows with everything known in hindsight.

    Readings of a run that was confirmed later get the status of the confirmation, overload before
    heavy load. Where a confirmed run began, or a heavy one ended, between two readings, a row is
    added at that instant. A reading brings at most one such row.
    """
    heavy, over = limits.levels[0], limits.levels[1]
    starts = [f"s{i}" for i in LEVELS]
    reading = _status_columns(
        "ms", starts, [_duration(s) for s in starts],
        f"CASE WHEN to_over THEN {OVERLOAD} WHEN to_heavy THEN {HEAVY} ELSE status END",
        "CASE WHEN to_over THEN over_class ELSE klass END", "lr",
    )
    # The added row has at most one start: that of the confirmed run.
    added = _status_columns(
        "extra_ms",
        [f"CASE WHEN extra = 'heavy' THEN extra_ms ELSE {_NONE} END",
         f"CASE WHEN extra = 'over' THEN extra_ms ELSE {_NONE} END", *[_NONE] * 5],
        [f"CASE WHEN extra = 'over' AND pstatus = {HEAVY} THEN {_duration('ps0', 's1')} "
         f"ELSE {_ZERO} END", *[_ZERO] * 6],
        f"CASE WHEN extra = 'over' THEN {OVERLOAD} ELSE {HEAVY} END",
        f"CASE WHEN extra = 'over' THEN klass ELSE {NO_OVERLOAD} END",
        f"CASE WHEN extra = 'over' THEN {over}D ELSE {heavy}D END",
    )
    grid = limits.grid_minutes * MINUTE
    marked = _with_heavy_end(tracked, limits).selectExpr(
        "*",
        f"status <> {OVERLOAD} AND coalesce(s1 = over_start, false) AS to_over",
        f"status NOT IN ({HEAVY}, {OVERLOAD}) AND coalesce(s0 = heavy_start, false) AS to_heavy",
        f"CASE WHEN over_found AND (ms - s1) % {grid} <> 0 THEN 'over' "
        f"WHEN heavy_found AND (ms - s0) % {grid} <> 0 THEN 'heavy' "
        f"WHEN {_HEAVY_ENDS} AND heavy_end NOT IN (ms, pt) THEN 'end' END AS extra",
    ).selectExpr(
        "*", "CASE extra WHEN 'over' THEN s1 WHEN 'heavy' THEN s0 WHEN 'end' THEN heavy_end END "
        "AS extra_ms",
    )
    both = (
        f"inline(CASE WHEN extra IS NULL THEN array(struct({', '.join(reading)})) "
        f"ELSE array(struct({', '.join(reading)}), struct({', '.join(added)})) END)"
    )
    return marked.selectExpr(both).select(*STATUS_COLUMNS)


def marks(tracked: DataFrame) -> DataFrame:
    """One row per confirmed run: what status earlier rows of the same run have to get."""
    return tracked.where("over_found OR heavy_found").selectExpr(
        "mp_id", "CAST(status AS INT) AS status", "CAST(klass AS INT) AS overloadstatus",
        f"{_time('CASE WHEN over_found THEN s1 ELSE s0 END')} AS start",
        f"{_time('ms')} AS confirmed",
    ).select(*MARK_COLUMNS)


def apply_marks(rows: DataFrame, marked: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Stored status rows with later confirmations applied; overload wins over heavy load.

    Only rows that were still pending can match; a run has at most one confirmation time's worth of them.
    The others take part in the joins under a key of their own time, which no confirmation has, so the rows
    are read once, and a point with very many of them is spread should Spark shuffle them.
    """
    c = F.col
    pending_over = c("tos").isNotNull() & (c("status") != OVERLOAD) & (
        c("tod") < limits.confirm_minutes
    )
    pending_heavy = c("ths").isNotNull() & ~c("status").isin(HEAVY, OVERLOAD) & (
        c("thd") < limits.confirm_minutes
    )

    def joined(left: DataFrame, status: int, start: str, pending: Column, p: str) -> DataFrame:
        right = (
            marked.where(c("status") == status)
            .groupBy(c("mp_id").alias(f"{p}_mp"), c("start").alias(f"{p}_start"))
            .agg(
                F.max("confirmed").alias(f"{p}_confirmed"),
                F.max_by("overloadstatus", "confirmed").alias(f"{p}_class"),
            )
        ).withColumn(f"{p}_due", F.lit(True))
        open_ = F.coalesce(pending, F.lit(False))
        left = left.withColumn(f"{p}_open", open_).withColumn(f"{p}_key", F.when(open_, c(start)).otherwise(c("time")))
        match = (
            (left["mp_id"] == right[f"{p}_mp"]) & (left[f"{p}_key"] == right[f"{p}_start"])
            & (left[f"{p}_open"] == right[f"{p}_due"]) & (left["time"] < right[f"{p}_confirmed"])
        )
        return left.join(right, match, "left")

    found = joined(joined(rows, OVERLOAD, "tos", pending_over, "o"), HEAVY, "ths", pending_heavy, "h")
    over = c("o_confirmed").isNotNull()
    heavy = c("h_confirmed").isNotNull()
    return found.withColumns(
        {
            "status": F.when(over, F.lit(OVERLOAD)).when(heavy, F.lit(HEAVY)).otherwise(c("status")),
            "overloadstatus": F.when(over, c("o_class")).otherwise(c("overloadstatus")),
        }
    ).select(*rows.columns)


def late_rows(late: DataFrame) -> DataFrame:
    """Status rows of late readings: nothing but the key, the time and the late status."""
    return late.withColumn("ms", to_ms(F.col("time"))).selectExpr(
        *_status_columns(
            "ms", [_NONE] * 7, [_ZERO] * 7, str(LATE), str(NO_OVERLOAD), f"{UNUSABLE}D"
        )
    )


def late_copies(readings: DataFrame) -> DataFrame:
    """(mp_id, time) of all but one of the readings that share point and time.

    Late rows hold no measures, so counting is enough, and it is done with the merge of copies that the
    detection begins with. The counts are unfolded in two steps with an exchange between them: one huge group
    is spread over many tasks. (Dealing by the load rate too keeps it in the merge, as the detection has it:
    only then Spark sees that both read the same exchange.)
    """
    c = F.col
    blocks = points(readings).where(c("copies") > 0).select(
        "mp_id", "ms", "lr", "copies",
        F.explode(F.sequence(F.lit(0).cast("bigint"), c("copies") - 1, F.lit(_COPIES_PER_TASK)))
        .alias("block"),
    ).repartition("mp_id", "ms", "lr", "block")
    size = F.least(c("copies") - c("block"), F.lit(_COPIES_PER_TASK)).cast("int")
    return blocks.select(
        "mp_id", from_ms(c("ms")).alias("time"),
        F.explode(F.array_repeat(F.lit(True), size)).alias("copy"),
    ).drop("copy")
