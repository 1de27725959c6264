"""The registered queries as SQL for the comparison engine.

The detection is stated in another way than in the library: whole measuring points instead of time
slices, and numbered islands instead of running maxima.
"""

from __future__ import annotations

from checks.fixtures import (
    ANOMALIES, AS_OF, CUT, EARLY, LINE_COPIES, LINES, RAW_DIMENSION, SERIES, USER_SERIES,
)
from feederlens.schema import (
    DURATIONS, MEASURES, POWER_FACTOR, POWERS, PRIMARY_COLUMNS, STARTS,
)

BAD = "CAST(9999.99 AS DOUBLE)"
LEVELS = [0.8, 1.0, 1.2, 1.3, 1.5, 1.6, 1.8]
LONG = {2: 480, 3: 240, 4: 120, 5: 60, 6: 30}


def at(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


def cut_ms(text: str) -> str:
    return f"epoch_ms(TIMESTAMP '{text}')"


def clamp(value: str) -> str:
    return f"(CASE WHEN abs({value}) > 9999.99 THEN {BAD} ELSE round({value}, 4) END)"


# --- parsing and power ----------------------------------------------------------------------------


def parsed(lines: str) -> str:
    number = "regexp_full_match(t[{i}], '[+-]?[0-9]+([.][0-9]+)?')"
    value = "TRY_CAST(ltrim(t[{i}], '+') AS DOUBLE)"
    measures = ", ".join(
        f"CASE WHEN {number.format(i=i)} THEN {clamp(value.format(i=i))} ELSE {BAD} END AS {name}"
        for i, name in enumerate(MEASURES, start=3)
    )
    return f"""SELECT CAST(t[1] AS BIGINT) AS mp_id, CAST(t[2] AS TIMESTAMP) AS time, {measures}
FROM (SELECT list_transform(f, lambda x: trim(x)) AS t
      FROM (SELECT string_split(regexp_replace(value, '^[^0-9]*', ''), '||') AS f
            FROM ({lines})
            WHERE regexp_full_match(value, '([^|]*[|][|]){{17}}[^|]*')
              AND regexp_matches(value, '[0-9]'))
      WHERE len(f) = 18)
WHERE regexp_full_match(t[1], '[0-9]+') AND TRY_CAST(t[2] AS TIMESTAMP) IS NOT NULL"""


DIMENSION = f"""SELECT mp_id, ratio, capacity FROM (
  SELECT CAST(c0 AS BIGINT) AS mp_id,
    CASE WHEN regexp_full_match(trim(c1), '[0-9]+') THEN CAST(trim(c1) AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS ratio,
    coalesce(TRY_CAST(c2 AS DOUBLE), CAST(0 AS DOUBLE)) AS capacity,
    row_number() OVER (PARTITION BY c0 ORDER BY line DESC) AS back
  FROM ({RAW_DIMENSION}) WHERE TRY_CAST(c0 AS BIGINT) IS NOT NULL)
WHERE back = 1"""

ATTACHED = f"""SELECT r.*, ratio, capacity
FROM (SELECT DISTINCT * FROM ({parsed(LINES)})) r JOIN ({DIMENSION}) d USING (mp_id)
WHERE ratio <> 0"""


def _scaled(c: str) -> str:
    return (
        f"CASE WHEN {c} = 9999.99 OR {c} * ratio >= 9999.99 THEN {BAD} ELSE {c} * ratio END AS {c}"
    )


VALUES = f"""SELECT mp_id, time, {', '.join(_scaled(c) for c in POWERS)},
  {', '.join(POWER_FACTOR)}, capacity FROM ({ATTACHED})"""

POWER = f"""SELECT *, coalesce(greatest(
    CASE WHEN zyggl + zwggl < 9999.99 THEN sqrt(zyggl * zyggl + zwggl * zwggl) END,
    CASE WHEN azxyg + bzxyg + czxyg + azxwg + bzxwg + czxwg < 9999.99 THEN
      sqrt((azxyg + bzxyg + czxyg) * (azxyg + bzxyg + czxyg)
         + (azxwg + bzxwg + czxwg) * (azxwg + bzxwg + czxwg)) END), {BAD}) AS maxpower
FROM ({VALUES})"""

PRIMARY = f"""SELECT *, CASE WHEN capacity = 0 OR maxpower = 9999.99 THEN {BAD}
  ELSE {clamp('maxpower / capacity')} END AS loadrate FROM ({POWER})"""


# --- detection ------------------------------------------------------------------------------------


def _meets(level: float) -> str:
    # The engine evaluates all branches of a CASE, hence the guards.
    return (
        "TRY_CAST(trunc(CAST(ms - pt AS DOUBLE) / nullif(lr - plr, 0) "
        f"* (CAST({level} AS DOUBLE) - plr)) AS BIGINT) + pt"
    )


def detection(series: str) -> str:
    """Common table expressions up to ``seen``: one row per reading with everything about it."""
    up = {i: f"(lr > {v} AND lr <> 9999.99)" for i, v in enumerate(LEVELS)}
    was_up = {i: f"(plr > {v} AND plr <> 9999.99)" for i, v in enumerate(LEVELS)}
    flags = ", ".join(
        f"CASE WHEN {up[i]} AND NOT (near AND {was_up[i]}) THEN 1 ELSE 0 END AS n{i}, {up[i]} AS up{i}, "
        f"CASE WHEN near AND plr <= {v} THEN {_meets(v)} ELSE ms END AS st{i}"
        for i, v in list(enumerate(LEVELS))[1:]
    )
    numbers = ", ".join(
        f"sum(n{i}) OVER (PARTITION BY mp_id ORDER BY ms) AS isle{i}" for i in range(1, 7)
    )
    starts = ", ".join(
        f"CASE WHEN up{i} THEN first_value(st{i}) OVER (PARTITION BY mp_id, isle{i}, up{i} ORDER BY ms) "
        f"END AS s{i}"
        for i in range(1, 7)
    )
    is_long = " OR ".join(
        f"coalesce((ms - s{i}) // 60000 >= {m}, false)" for i, m in LONG.items()
    )
    return f"""WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY mp_id, ms ORDER BY lr) AS place FROM ({series})),
pairs AS (
  SELECT mp_id, ms, lr, lag(ms) OVER w AS pt, lag(lr) OVER w AS plr,
    coalesce(ms - lag(ms) OVER w <= 1200000, false) AS near
  FROM ranked WHERE place = 1 WINDOW w AS (PARTITION BY mp_id ORDER BY ms)),
flagged AS (SELECT *, {flags} FROM pairs),
numbered AS (SELECT *, {numbers} FROM flagged),
started AS (SELECT *, {starts} FROM numbered),
overs AS (
  SELECT *, coalesce((ms - s1) // 60000 >= 30, false) AS ov, ({is_long}) AS lng FROM started),
before AS (
  SELECT *, coalesce(lag(ov) OVER w, false) AS pov, coalesce(lag(lng) OVER w, false) AS plng
  FROM overs WINDOW w AS (PARTITION BY mp_id ORDER BY ms)),
low AS (
  SELECT *, (lr > 0.8 AND lr <> 9999.99 AND NOT ov) AS in0,
    (near AND pov AND lr > 0.8 AND lr <= 1.0) AS handed FROM before),
low_numbered AS (
  SELECT *, sum(CASE WHEN in0 AND NOT coalesce(near AND was_in, false) THEN 1 ELSE 0 END)
    OVER (PARTITION BY mp_id ORDER BY ms) AS isle0
  FROM (SELECT *, lag(in0) OVER (PARTITION BY mp_id ORDER BY ms) AS was_in FROM low)),
low_started AS (
  SELECT *, CASE WHEN in0 THEN first_value(
      CASE WHEN handed THEN {_meets(1.0)}
           WHEN near AND plr <= 0.8 THEN {_meets(0.8)} ELSE ms END)
      OVER (PARTITION BY mp_id, isle0, in0 ORDER BY ms) END AS s0,
    first_value(handed) OVER (PARTITION BY mp_id, isle0, in0 ORDER BY ms) AS from_over,
    row_number() OVER (PARTITION BY mp_id, isle0, in0 ORDER BY ms) AS nth
  FROM low_numbered),
held AS (
  SELECT *, max(CASE WHEN nth = 2 THEN (ms - s0) // 60000 END)
    OVER (PARTITION BY mp_id, isle0, in0) AS second FROM low_started),
judged AS (
  SELECT *, CASE WHEN ov THEN 2
      WHEN in0 AND ((ms - s0) // 60000 >= 30
        OR (from_over AND (nth = 1 OR second >= 15))) THEN 1
      WHEN lr = 9999.99 THEN 3 ELSE 0 END AS status,
    CASE WHEN NOT ov THEN 0 WHEN lng THEN 2 WHEN pov AND plng THEN 3 ELSE 1 END AS klass
  FROM held),
seen AS (
  SELECT *, coalesce(lag(status) OVER w, 0) AS pstatus, lag(klass) OVER w AS pklass,
    lag(s0) OVER w AS ps0, lag(s1) OVER w AS ps1
  FROM judged WINDOW w AS (PARTITION BY mp_id ORDER BY ms))"""


_START_COLUMNS = ", ".join(f"{at(f's{i}')} AS {name}" for i, name in enumerate(STARTS))
_DURATION_COLUMNS = ", ".join(
    f"coalesce((ms - s{i}) // 60000, 0) AS {name}" for i, name in enumerate(DURATIONS)
)

ONLINE = f"""SELECT mp_id, {at('ms')} AS time, {_START_COLUMNS}, {_DURATION_COLUMNS},
  CAST(status AS INTEGER) AS status, CAST(klass AS INTEGER) AS overloadstatus, lr AS loadrate
FROM seen"""

_HEAVY_END = """CASE WHEN (ms - pt) // 1000 <= 1200 AND lr <> 9999.99 AND lr <> plr
    AND {met} >= pt AND {met} <= ms THEN {met} ELSE pt END""".format(met=f"({_meets(0.8)})")

EPISODES = f"""SELECT mp_id, CAST(pstatus AS INTEGER) AS status,
  CAST(pklass AS INTEGER) AS overloadstatus, {at('b')} AS ts, {at('e')} AS te,
  (e - b) // 60000 AS td
FROM (
  SELECT mp_id, pstatus, pklass, ps0 AS b, s1 AS e FROM seen WHERE status = 2 AND pstatus = 1
  UNION ALL
  SELECT mp_id, pstatus, pklass, ps1,
    CASE WHEN near AND plr > 1.0 AND lr <= 1.0 THEN {_meets(1.0)} ELSE pt END
  FROM seen WHERE pstatus = 2 AND status <> 2
  UNION ALL
  SELECT mp_id, pstatus, pklass, ps0, {_HEAVY_END}
  FROM seen WHERE pstatus = 1 AND status IN (0, 3))"""

_NO_STARTS = {name: "CAST(NULL AS TIMESTAMP)" for name in STARTS}
_NO_DURATIONS = {name: "CAST(0 AS BIGINT)" for name in DURATIONS}


def _row(time: str, status: str, klass: str, rate: str, **known: str) -> str:
    cells = {**_NO_STARTS, **_NO_DURATIONS, **known}
    middle = ", ".join(f"{v} AS {k}" for k, v in cells.items())
    return (
        f"SELECT mp_id, {time} AS time, {middle}, CAST({status} AS INTEGER) AS status, "
        f"CAST({klass} AS INTEGER) AS overloadstatus, CAST({rate} AS DOUBLE) AS loadrate"
    )


FINAL = f"""SELECT seen.mp_id, {at('seen.ms')} AS time, {_START_COLUMNS.replace('(s', '(seen.s')},
  {_DURATION_COLUMNS.replace('(ms - s', '(seen.ms - seen.s')},
  CAST(CASE WHEN o.ms > seen.ms THEN 2 WHEN seen.status <> 2 AND h.ms > seen.ms THEN 1
    ELSE seen.status END AS INTEGER) AS status,
  CAST(CASE WHEN o.ms > seen.ms THEN o.klass ELSE seen.klass END AS INTEGER) AS overloadstatus,
  seen.lr AS loadrate
FROM seen
LEFT JOIN (SELECT mp_id, s1, ms, klass FROM seen WHERE status = 2 AND pstatus <> 2) o
  ON o.mp_id = seen.mp_id AND o.s1 = seen.s1
LEFT JOIN (SELECT mp_id, s0, ms FROM seen WHERE status = 1 AND pstatus NOT IN (1, 2)) h
  ON h.mp_id = seen.mp_id AND h.s0 = seen.s0
UNION ALL
{_row(at('s1'), '2', 'klass', '1.0', tos=at('s1'),
      thd='CASE WHEN pstatus = 1 THEN (s1 - ps0) // 60000 ELSE 0 END')}
FROM seen WHERE status = 2 AND pstatus <> 2 AND (ms - s1) % 900000 <> 0
UNION ALL
{_row(at('s0'), '1', '0', '0.8', ths=at('s0'))}
FROM seen WHERE status = 1 AND pstatus NOT IN (1, 2) AND (ms - s0) % 900000 <> 0
UNION ALL
{_row(at('e'), '1', '0', '0.8')}
FROM (SELECT *, {_HEAVY_END} AS e FROM seen WHERE pstatus = 1 AND status IN (0, 3))
WHERE e NOT IN (ms, pt)"""

LATE_COPIES = f"""{_row(at('ms'), '4', '0', '9999.99')} FROM ranked WHERE place > 1"""

MARKS = f"""SELECT mp_id, CAST(status AS INTEGER) AS status, CAST(klass AS INTEGER) AS overloadstatus,
  {at('CASE WHEN status = 2 THEN s1 ELSE s0 END')} AS start, {at('ms')} AS confirmed
FROM seen WHERE (status = 2 AND pstatus <> 2) OR (status = 1 AND pstatus NOT IN (1, 2))"""


def newest(rows: str) -> str:
    return f"""SELECT * EXCLUDE (back) FROM (
  SELECT *, row_number() OVER (PARTITION BY mp_id ORDER BY time DESC) AS back FROM ({rows}))
WHERE back = 1"""


def user_state() -> str:
    return f"""{detection(f"SELECT * FROM ({USER_SERIES}) WHERE ms < {cut_ms(EARLY)}")}
{newest(ONLINE)}"""


def sql() -> dict[str, str]:
    whole = detection(SERIES)
    stamped = "strftime(time, '%Y%m%d') AS dt"
    stored = ", ".join(
        f"{clamp(c)} AS {c}" for c in ["loadrate", "maxpower", *MEASURES]
    )
    unseen = "SELECT DISTINCT user_id AS mp_id FROM events"
    defaults = {**{c: f"{c}" for c in STARTS}, **{c: f"coalesce({c}, 0)" for c in DURATIONS}}
    looked_up = ", ".join(f"{v} AS {c}" for c, v in defaults.items())
    return {
        "parse_lines": parsed(LINES),
        "recent_24h": f"""SELECT mp_id, {at('ms')} AS time, lr AS loadrate FROM ({SERIES})
WHERE ms BETWEEN {cut_ms(AS_OF)} - 86400000 AND {cut_ms(AS_OF)}""",
        "dedup_readings": f"SELECT DISTINCT * FROM ({parsed(LINE_COPIES)})",
        "dim_load": f"""SELECT TRY_CAST(c0 AS BIGINT) AS mp_id, c1 AS bl,
  TRY_CAST(c2 AS DOUBLE) AS capacity FROM ({RAW_DIMENSION})""",
        "dim_clean": DIMENSION,
        "join_dim": f"SELECT mp_id, time, zyggl, zwggl, ratio, capacity FROM ({ATTACHED})",
        "format_double": f"""SELECT l_orderkey, l_linenumber,
  {clamp('(l_extendedprice / 7 - 5000)')} AS formatted FROM lineitem""",
        "primary_values": f"SELECT mp_id, time, {', '.join(POWERS)} FROM ({VALUES})",
        "max_power": f"SELECT mp_id, time, maxpower FROM ({POWER})",
        "load_rate": f"SELECT mp_id, time, loadrate FROM ({PRIMARY})",
        "primary_day": f"""SELECT mp_id, time, {stored}, {stamped}
FROM (SELECT {', '.join(PRIMARY_COLUMNS)} FROM ({PRIMARY}))""",
        "secondary_day": f"""SELECT *, {stamped}
FROM (SELECT DISTINCT * FROM ({parsed(LINES)}))""",
        "batch_days": f"SELECT DISTINCT strftime({at('ms')}, '%Y%m%d') AS day FROM ({SERIES})",
        "lag_readings": f"""{whole} SELECT mp_id, {at('ms')} AS time, lr AS loadrate,
  {at('pt')} AS previous_time, plr AS previous_loadrate FROM seen""",
        "level_runs": f"""{whole} SELECT mp_id, {at('ms')} AS time, lr AS loadrate,
  {_DURATION_COLUMNS} FROM seen""",
        "run_starts": whole + " " + " UNION ".join(
            f"SELECT mp_id, {i} AS level, {at(f's{i}')} AS start FROM seen WHERE s{i} IS NOT NULL"
            for i in range(7)
        ),
        "status_online": f"{whole} {ONLINE}",
        "episodes": f"{whole} {EPISODES}",
        "status_marks": f"{whole} {MARKS}",
        "status_backfilled": f"{whole} {FINAL}",
        "status_rows": f"{detection(ANOMALIES)} {FINAL} UNION ALL {LATE_COPIES}",
        "status_from_state": f"{whole} SELECT * FROM ({ONLINE}) WHERE time >= TIMESTAMP '{CUT}'",
        "status_repaired": f"{whole} {FINAL}",
        "late_rows": f"""WITH base AS ({SERIES}), seen_until AS (
  SELECT mp_id, max(ms) AS until FROM base WHERE ms < {cut_ms(CUT)} GROUP BY mp_id)
{_row(at('ms'), '4', '0', '9999.99')}
FROM (SELECT user_id // 50 AS mp_id, epoch_us(ts) // 1000 AS ms FROM events
      WHERE epoch_us(ts) // 1000 >= {cut_ms(CUT)} OR event_type = 'error') JOIN seen_until USING (mp_id)
WHERE ms <= until""",
        "latest_status": f"{whole} {newest(ONLINE)}",
        "latest_status_range": f"""{detection(USER_SERIES)}
SELECT * FROM ({newest(ONLINE)}) WHERE mp_id BETWEEN 10 AND 99""",
        "state_lookup": f"""SELECT mp_id, time, {looked_up}, coalesce(status, 0) AS status,
  coalesce(overloadstatus, 0) AS overloadstatus, coalesce(loadrate, {BAD}) AS loadrate
FROM ({unseen}) LEFT JOIN ({user_state()}) USING (mp_id)""",
        "new_keys": f"""SELECT mp_id FROM ({unseen})
WHERE mp_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '{EARLY}')""",
        "refresh_due": """SELECT o_orderkey, dayofweek(o_orderdate) = 2 AS due FROM orders""",
        "text_compact": f"""SELECT value AS line FROM ({LINES})
WHERE contains(regexp_replace(value, '^[^0-9]*', ''), '77')""",
        "peek_limit": """SELECT event_id, event_type, value FROM events WHERE event_id >= 100
ORDER BY event_id LIMIT 20""",
        "predicate_partition_scan": """SELECT CASE WHEN c_name IS NULL THEN 4
    WHEN c_name < 'Customer#000000040' THEN 0 WHEN c_name < 'Customer#000000090' THEN 1
    WHEN c_name < 'Customer#000000130' THEN 2 ELSE 3 END AS part, count(*) AS customers
FROM customer GROUP BY 1""",
    }
