"""Load-level runs of every measuring point, in an order-dependent but skew-proof form.

A *run* at a level is a chain of readings above it with no gap longer than the limit. What has to be
known at a reading is when the run at each level began. Such a start always lies between a reading
and the one before it, so starts never decrease along a series: "the current start" is a running
maximum over "a run begins here" events. Running maxima can be cut anywhere and joined again,
which gives the plan its shape:

1. Readings are split by measuring point *and* time slice. Times are unique per point and in
   milliseconds, so a slice has a hard size limit however large one point is.
2. Each slice is summarised on its own (first and last reading, latest run starts).
3. The summaries of a point, one row per slice, are combined in time order. This gives a *seed* per
   slice: the last reading before it, with all its run starts. A stored state of an earlier
   batch takes part here as one more summary.
4. Seed and readings of a slice are processed together by ordinary windows.

Steps 2 and 4 read the same exchange. Slices also get a copy of the first minutes of the next slice:
a pending run is always confirmed within that span, so looking ahead needs no other exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.functions.times import to_ms
from feederlens.settings import (
    HEAVY, LONG, MINUTE, NO_OVERLOAD, NORMAL, NOT_COMPUTABLE, OVERLOAD, SHORT, SHORT_AFTER_LONG,
    UNUSABLE, Limits,
)

OPEN_END = (1 << 63) - 1  # "the following reading is not known yet"
LEVELS = range(7)

# The rules below are SQL text rather than nested Column calls: there are several hundred of them
# per plan and each Column call is a round trip to the JVM.

_SLICE = "PARTITION BY mp_id, slice ORDER BY ms"
_SO_FAR = f"{_SLICE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
# Descending, because a frame that reaches to the partition's end is quadratic in Spark.
_BACKWARDS = (
    "PARTITION BY mp_id, slice ORDER BY ms DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
)
# Summaries of a point in time order; a stored state has no slice and comes first.
_POINT = "PARTITION BY mp_id ORDER BY slice NULLS FIRST"
_UP_TO_SLICE = f"{_POINT} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE_SLICE = f"{_POINT} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


# --- rules for one reading (ms, lr) and the one before it (pt, plr) -------------------------------
#
# ``pair_columns`` adds what they share: lv/plv are the load rates with -Infinity for unusable
# ones, so that "above a level" is one comparison; ``near`` says there is no gap between the two;
# ``hop`` is milliseconds per unit of load rate on the straight line between them.


def pair_columns(limits: Limits) -> list[str]:
    def level_value(rate: str) -> str:
        return f"CASE WHEN {rate} = {UNUSABLE}D THEN DOUBLE('-Infinity') ELSE {rate} END"

    # A heavy run may end over a gap that is less than a second too long, hence the wider limit.
    return [
        f"{level_value('lr')} AS lv",
        f"{level_value('plr')} AS plv",
        f"coalesce(ms - pt <= {limits.gap_ms}, false) AS near",
        f"CASE WHEN ms - pt < {limits.gap_ms + 1000} AND lr <> {UNUSABLE}D AND plr <> {UNUSABLE}D "
        "AND lr <> plr THEN 1.0D * (ms - pt) / (lr - plr) END AS hop",
    ]


def crossing(level: float) -> str:
    """Instant at which the line between the readings meets a level, cut to milliseconds. The
    operand order is part of the contract: another one can move a result by a millisecond."""
    return f"TRY_CAST(hop * ({level}D - plr) AS BIGINT) + pt"


def _run_start(level: float) -> str:
    """Start of the run that begins at this reading; NULL when none begins."""
    start = f"CASE WHEN near THEN coalesce({crossing(level)}, ms) ELSE ms END"
    return f"CASE WHEN lv > {level}D AND NOT (near AND plv > {level}D) THEN {start} END"


def _leaves_overload(limits: Limits) -> str:
    """Whether the load rate fell from overload to heavy load between the two readings."""
    heavy, over = limits.levels[0], limits.levels[1]
    return f"(near AND plv > {over}D AND lv > {heavy}D AND lv <= {over}D)"


def _was_confirmed(start: str, limits: Limits) -> str:
    return f"coalesce(pt - {start} >= {limits.confirm_ms}, false)"


def _long_at(value: str, ms: str, starts: dict[int, str], limits: Limits) -> str:
    terms = [
        f"({value} > {limits.levels[i]}D AND {ms} - {starts[i]} >= {limits.long_minutes[i - 2] * MINUTE})"
        for i in LEVELS[2:]
    ]
    return "coalesce(" + " OR ".join(terms) + ", false)"


def _overload_class(starts: dict[int, str], last_long: str, limits: Limits) -> str:
    """Class of an overload reading: long, short, or short right after long.

    Between two near readings no start above a level changes unless the run at it began anew, so
    the class of the previous reading follows from the starts known here.
    """
    if limits.sticky_long:
        was_long = f"{last_long} >= {starts[1]}"
    else:
        was_long = (
            f"near AND plv > {limits.levels[1]}D AND {_was_confirmed(starts[1], limits)} "
            f"AND {_long_at('plv', 'pt', starts, limits)}"
        )
    return (
        f"CASE WHEN {_long_at('lv', 'ms', starts, limits)} THEN {LONG} "
        f"WHEN {was_long} THEN {SHORT_AFTER_LONG} ELSE {SHORT} END"
    )


def _neighbours() -> list[str]:
    return [
        f"lag(ms) OVER ({_SLICE}) AS pt",
        f"lag(lr) OVER ({_SLICE}) AS plr",
        f"coalesce(lead(ms) OVER ({_SLICE}), {OPEN_END}) AS nt",
    ]


# --- step 1: readings in slices -------------------------------------------------------------------


def points(readings: DataFrame) -> DataFrame:
    """One row per measuring point and millisecond: (mp_id, ms, lr, copies).

    Of several readings with the same time the one with the lowest load rate counts; the others, so many
    as ``copies``, are late by definition (``late_copies``). Aggregating first also means that no number
    of copies can fill one slice.
    """
    return (
        readings.select(
            "mp_id", to_ms(F.col("time")).alias("ms"),
            F.coalesce(F.col("loadrate"), F.lit(UNUSABLE)).alias("lr"),
        )
        .where("mp_id IS NOT NULL AND ms IS NOT NULL")
        .groupBy("mp_id", "ms")
        .agg(F.min("lr").alias("lr"), (F.count(F.lit(1)) - 1).alias("copies"))
    )


def _in_slices(series: DataFrame, limits: Limits) -> DataFrame:
    width = limits.slice_ms
    start = f"ms - pmod(ms, {width})"
    return series.selectExpr(
        "mp_id",
        f"explode(CASE WHEN pmod(ms, {width}) < {limits.lookahead_ms} "
        f"THEN array({start}, {start} - {width}) ELSE array({start}) END) AS slice",
        "ms", "lr",
    ).repartition("mp_id", "slice")


def _own(limits: Limits) -> str:
    return f"ms < slice + {limits.slice_ms}"


# --- steps 2 and 3: summaries and seeds -----------------------------------------------------------


def _summaries(sliced: DataFrame, limits: Limits) -> DataFrame:
    tracked = LEVELS[1:] if limits.sticky_long else LEVELS[1:2]
    # The first reading of a slice has its predecessor elsewhere; step 3 deals with it.
    rows = (
        sliced.selectExpr("*", *_neighbours())
        .selectExpr("*", *pair_columns(limits))
        .selectExpr(
            "*",
            *[f"CASE WHEN pt IS NOT NULL THEN {_run_start(limits.levels[i])} END AS f{i}"
              for i in LEVELS],
        )
        .selectExpr("*", *[f"max(f{i}) OVER ({_SO_FAR}) AS g{i}" for i in tracked])
    )
    leaves = _leaves_overload(limits)
    # A run that came in from the previous slice has no start here: whether it counted as overload
    # when it ended is open. There is at most one such end per slice.
    rows = rows.selectExpr(
        "*",
        f"{leaves} AND {_was_confirmed('g1', limits)} AS leaves",
        f"{leaves} AND g1 IS NULL AS may_leave",
        f"{crossing(limits.levels[1])} AS x",
    )
    sticky = []
    if limits.sticky_long:
        starts = {i: f"g{i}" for i in LEVELS[1:]}
        sticky = [f"max(CASE WHEN {_long_at('lv', 'ms', starts, limits)} THEN ms END) AS known_long"]
        sticky += [
            f"max(CASE WHEN lv > {limits.levels[i]}D AND g{i} IS NULL THEN ms END) AS u{i}"
            for i in LEVELS[2:]
        ]
    columns = [
        "min(ms) AS first_ms", "min_by(lr, ms) AS first_lr", "min_by(nt, ms) AS first_nt",
        "max(ms) AS last_ms", "max_by(lr, ms) AS last_lr",
        "max_by(pt, ms) AS last_pt", "max_by(plr, ms) AS last_plr",
        *[f"max(f{i}) AS f{i}" for i in LEVELS],
        "max(CASE WHEN leaves THEN x END) AS exit_ms",
        "max(CASE WHEN leaves THEN nt END) AS exit_nt",
        "max(CASE WHEN may_leave THEN x END) AS open_exit_ms",
        "max(CASE WHEN may_leave THEN pt END) AS open_exit_pt",
        "max(CASE WHEN may_leave THEN nt END) AS open_exit_nt",
        *sticky,
    ]
    return rows.where(_own(limits)).groupBy("mp_id", "slice").agg(*[F.expr(e) for e in columns])


_STATE_STARTS = ["ths", "tos", "tos1", "tos2", "tos3", "tos4", "tos5"]


def _state_summaries(state: DataFrame, limits: Limits) -> DataFrame:
    """Stored states in the form of a summary that comes before every slice."""
    times = state.select(
        "mp_id", "loadrate", "status", "overloadstatus", to_ms(F.col("time")).alias("ms"),
        *[to_ms(F.col(c)).alias(f"f{i}") for i, c in enumerate(_STATE_STARTS)],
    )
    sticky = []
    if limits.sticky_long:
        sticky = [
            f"CASE WHEN overloadstatus IN ({LONG}, {SHORT_AFTER_LONG}) THEN ms END AS known_long"
        ]
    return times.selectExpr(
        "mp_id", "CAST(NULL AS BIGINT) AS slice", "ms AS last_ms", "loadrate AS last_lr",
        *[f"f{i}" for i in LEVELS],
        f"CASE WHEN status = {HEAVY} THEN f0 END AS exit_ms",
        f"CASE WHEN status = {HEAVY} THEN {OPEN_END} END AS exit_nt",
        "overloadstatus AS given_class",
        *sticky,
    )


def _seeds(summaries: DataFrame, limits: Limits) -> DataFrame:
    """Last reading before each slice with its run starts, addressed to that slice."""
    # The first reading of each slice, now with the last one of the slice before.
    step = (
        summaries.selectExpr(
            "*",
            "first_ms AS ms", "first_lr AS lr",
            f"lag(last_ms) OVER ({_POINT}) AS pt",
            f"lag(last_lr) OVER ({_POINT}) AS plr",
            f"lead(slice) OVER ({_POINT}) AS next_slice",
            f"lead(first_ms) OVER ({_POINT}) AS next_ms",
        )
        .selectExpr("*", *pair_columns(limits))
        .selectExpr("*", *[f"{_run_start(limits.levels[i])} AS b{i}" for i in LEVELS])
        .selectExpr(
            "*",
            *[f"max(greatest(f{i}, b{i})) OVER ({_BEFORE_SLICE}) AS m{i}" for i in LEVELS[1:]],
        )
        .selectExpr(
            "*",
            f"{_leaves_overload(limits)} AND {_was_confirmed('m1', limits)} AS leaves_first",
            f"coalesce(open_exit_pt - greatest(m1, b1) >= {limits.confirm_ms}, false) AS leaves_open",
        )
    )
    long_ms = "CAST(NULL AS BIGINT)"
    if limits.sticky_long:
        later = [
            f"CASE WHEN u{i} - greatest(m{i}, b{i}) >= {limits.long_minutes[i - 2] * MINUTE} THEN u{i} END"
            for i in LEVELS[2:]
        ]
        long_ms = f"greatest(known_long, {', '.join(later)})"
    step = step.selectExpr(
        "*",
        "coalesce(exit_ms, CASE WHEN leaves_open THEN open_exit_ms END, "
        f"CASE WHEN leaves_first THEN {crossing(limits.levels[1])} END) AS x",
        "coalesce(exit_nt, CASE WHEN leaves_open THEN open_exit_nt END, "
        "CASE WHEN leaves_first THEN first_nt END) AS xn",
        f"{long_ms} AS l",
    )
    # Now the last reading of each slice; its predecessor is in the same slice or the one before.
    step = (
        step.selectExpr(
            "mp_id", "next_slice AS slice", "last_ms AS ms", "last_lr AS lr", "given_class",
            "coalesce(last_pt, pt) AS pt", "coalesce(last_plr, plr) AS plr",
            f"max(greatest(f0, b0, x)) OVER ({_UP_TO_SLICE}) AS e0",
            *[f"greatest(m{i}, f{i}, b{i}) AS e{i}" for i in LEVELS[1:]],
            f"max(x) OVER ({_UP_TO_SLICE}) AS ex",
            f"max(CASE WHEN xn = {OPEN_END} THEN coalesce(next_ms, xn) ELSE xn END) "
            f"OVER ({_UP_TO_SLICE}) AS en",
            f"max(l) OVER ({_UP_TO_SLICE}) AS el",
        )
        .where("slice IS NOT NULL")
        .selectExpr("*", *pair_columns(limits))
    )
    starts = {i: f"e{i}" for i in LEVELS}
    return step.selectExpr(
        "mp_id", "slice", "ms", "lr", *starts.values(), "ex", "en", "el",
        f"coalesce(given_class, CASE WHEN lv > {limits.levels[1]}D AND ms - e1 >= {limits.confirm_ms} "
        f"THEN {_overload_class(starts, 'el', limits)} ELSE {NO_OVERLOAD} END) AS eclass",
    )


# --- step 4: all readings with their runs and status ----------------------------------------------


def track(
    readings: DataFrame, limits: Limits = Limits(), state: DataFrame | None = None
) -> DataFrame:
    """Readings (mp_id, time, loadrate) with run starts and status, one row per reading time.

    ``state`` is the latest status row of measuring points from earlier batches; the readings must
    then all be later than the state of their point. Times are epoch milliseconds in the result:
    ``ms``/``lr`` of the reading, ``pt``/``plr`` of the one before it, ``s0``-``s6`` run starts,
    ``status``/``klass``, the same with a ``p`` prefix for the reading before, ``over_found`` /
    ``heavy_found`` for readings that confirm a run, and ``over_*`` / ``heavy_start`` of the next
    such reading for back-filling.
    """
    heavy, over = limits.levels[0], limits.levels[1]
    # The condition always holds. It asks for the number of copies, so that what is exchanged here is what
    # ``late_copies`` reads, and Spark takes one exchange for both.
    sliced = _in_slices(points(readings).where("copies >= 0"), limits)
    summaries = _summaries(sliced, limits).withColumn("given_class", F.lit(None).cast("int"))
    if state is not None:
        summaries = summaries.unionByName(
            _state_summaries(state, limits), allowMissingColumns=True
        )
    seeds = _seeds(summaries, limits).repartition("mp_id", "slice")
    rows = sliced.withColumn("seed", F.lit(False)).unionByName(
        seeds.withColumn("seed", F.lit(True)), allowMissingColumns=True
    )
    starts = {i: f"g{i}" for i in LEVELS}
    rows = (
        rows.selectExpr("*", *_neighbours())
        .selectExpr("*", *pair_columns(limits))
        .selectExpr(
            "*",
            *[f"CASE WHEN seed THEN e{i} ELSE {_run_start(limits.levels[i])} END AS f{i}"
              for i in LEVELS],
        )
        .selectExpr("*", *[f"max(f{i}) OVER ({_SO_FAR}) AS g{i}" for i in LEVELS[1:]])
        .selectExpr(
            "*",
            f"coalesce(lv > {over}D AND ms - g1 >= {limits.confirm_ms}, false) AS over",
            f"{_leaves_overload(limits)} AND {_was_confirmed('g1', limits)} AS leaves",
            f"{_long_at('lv', 'ms', starts, limits)} AS long_now",
        )
        .selectExpr(
            "*",
            f"CASE WHEN seed THEN ex WHEN leaves THEN {crossing(over)} END AS x",
            "CASE WHEN seed THEN en WHEN leaves THEN nt END AS xn",
            "CASE WHEN seed THEN el WHEN long_now THEN ms END AS l",
        )
        .selectExpr(
            "*",
            f"max(greatest(f0, x)) OVER ({_SO_FAR}) AS g0",
            f"max(x) OVER ({_SO_FAR}) AS gx",
            f"max(xn) OVER ({_SO_FAR}) AS gxn",
            f"max(l) OVER ({_SO_FAR}) AS last_long",
        )
        .selectExpr(
            "*",
            f"CASE WHEN lv > {heavy}D AND NOT over THEN g0 END AS s0",
            *[f"CASE WHEN lv > {limits.levels[i]}D THEN g{i} END AS s{i}" for i in LEVELS[1:]],
        )
    )
    # A heavy run left behind by an overload is heavy at its first reading, and stays so if it has
    # lasted for the hold time at its second one; any other run needs the confirmation time.
    is_heavy = (
        f"s0 IS NOT NULL AND (ms - s0 >= {limits.confirm_ms} "
        f"OR (gx = s0 AND (gxn > ms OR gxn - s0 >= {limits.hold_ms})))"
    )
    rows = (
        rows.selectExpr(
            "mp_id", "slice", "seed", "ms", "lr", "pt", "plr", "near", "hop",
            *[f"s{i}" for i in LEVELS],
            f"CASE WHEN over THEN {OVERLOAD} WHEN {is_heavy} THEN {HEAVY} "
            f"WHEN lr = {UNUSABLE}D THEN {NOT_COMPUTABLE} ELSE {NORMAL} END AS status",
            "CASE WHEN seed THEN eclass "
            f"WHEN over THEN {_overload_class(starts, 'last_long', limits)} "
            f"ELSE {NO_OVERLOAD} END AS klass",
        )
        .selectExpr(
            "*",
            f"coalesce(lag(status) OVER ({_SLICE}), {NORMAL}) AS pstatus",
            f"lag(klass) OVER ({_SLICE}) AS pklass",
            f"lag(s0) OVER ({_SLICE}) AS ps0",
            f"lag(s1) OVER ({_SLICE}) AS ps1",
        )
        .selectExpr(
            "*",
            f"NOT seed AND status = {OVERLOAD} AND pstatus <> {OVERLOAD} AS over_found",
            f"NOT seed AND status = {HEAVY} AND pstatus NOT IN ({HEAVY}, {OVERLOAD}) AS heavy_found",
        )
    )

    def next_found(flag: str, value: str) -> str:
        return f"last(CASE WHEN {flag} THEN {value} END, true) OVER ({_BACKWARDS})"

    return (
        rows.selectExpr(
            "*",
            f"{next_found('over_found', 's1')} AS over_start",
            f"{next_found('over_found', 'klass')} AS over_class",
            f"{next_found('heavy_found', 's0')} AS heavy_start",
        )
        .where(f"NOT seed AND {_own(limits)}")
        .drop("slice", "seed")
    )
