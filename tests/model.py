"""Reading-by-reading model of the episode detection, to compare the set-based plan with.

Times are milliseconds. A point remembers its last reading as a plain dict; ``step`` handles one
reading and says what it caused.
"""

from __future__ import annotations

from feederlens import Limits

BAD = 9999.99
MIN = 60_000


def minutes(a, b):
    return (b - a) // MIN


def meet(p, t, lr, level):
    span = t - p["t"]
    return int(1.0 * span / (lr - p["lr"]) * (level - p["lr"])) + p["t"]


def klass_of(durations, before, limits):
    if any(d >= m for d, m in zip(durations[2:], limits.long_minutes)):
        return 2
    return 3 if before in ((2, 3) if limits.sticky_long else (2,)) else 1


def step(p, t, lr, limits):
    """(row, added rows, episode or None, mark or None) for a reading after state ``p``."""
    levels, gap = limits.levels, limits.gap_ms
    near = p is not None and t - p["t"] <= gap
    before = p or {"t": None, "lr": BAD, "s": [None] * 7, "status": 0, "klass": 0}
    starts = []
    for i, level in enumerate(levels):
        if lr == BAD or lr <= level:
            starts.append(None)
        elif near and before["s"][i] is not None:
            starts.append(before["s"][i])
        elif near and before["lr"] <= level:
            starts.append(meet(before, t, lr, level))
        else:
            starts.append(t)
    dur = [0 if s is None else minutes(s, t) for s in starts]
    row = {"t": t, "lr": lr, "s": starts, "d": dur, "status": 0, "klass": 0}
    added, episode, mark = [], None, None

    def extra(at, level, rate, status, klass, heavy_minutes=0):
        s = [at if i == level else None for i in range(7)]
        added.append({"t": at, "lr": rate, "s": s, "d": [heavy_minutes] + [0] * 6,
                      "status": status, "klass": klass})

    was = before["status"]
    if dur[1] >= limits.confirm_minutes:
        row["status"], row["klass"] = 2, klass_of(dur, before["klass"], limits)
        if was != 2:
            heavy_minutes = 0
            if was == 1:
                heavy_minutes = minutes(before["s"][0], starts[1])
                episode = (1, before["klass"], before["s"][0], starts[1], heavy_minutes)
            if (t - starts[1]) % (limits.grid_minutes * MIN):
                extra(starts[1], 1, levels[1], 2, row["klass"], heavy_minutes)
            mark = (2, row["klass"], starts[1])
        starts[0], dur[0] = None, 0
    elif was == 2:
        end = before["t"]
        if near and before["lr"] > levels[1] >= lr:
            end = meet(before, t, lr, levels[1])
            if starts[0] is not None:
                starts[0], dur[0], row["status"] = end, minutes(end, t), 1
        elif lr == BAD:
            row["status"] = 3
        if row["status"] == 0 and lr == BAD:
            row["status"] = 3
        episode = (2, before["klass"], before["s"][1], end, minutes(before["s"][1], end))
    elif dur[0] >= limits.confirm_minutes or (was == 1 and dur[0] >= limits.hold_minutes):
        row["status"] = 1
        if was != 1:
            if (t - starts[0]) % (limits.grid_minutes * MIN):
                extra(starts[0], 0, levels[0], 1, 0)
            mark = (1, 0, starts[0])
    else:
        row["status"] = 3 if lr == BAD else 0
        if was == 1:
            end = before["t"]
            if (t - before["t"]) // 1000 <= gap // 1000 and lr != BAD and lr != before["lr"]:
                found = meet(before, t, lr, levels[0])
                if before["t"] <= found <= t:
                    end = found
            if end not in (t, before["t"]):
                extra(end, None, levels[0], 1, 0)
            episode = (1, before["klass"], before["s"][0], end, minutes(before["s"][0], end))
    return row, added, episode, mark


def run(series, limits=Limits(), state=None):
    """All tables of one point: online rows, final rows, episodes, marks and the last state.

    ``series`` is a list of (t, lr); later copies of a time, and times up to the state, are late.
    """
    p, online, final, found, marks = state, [], [], [], []
    for t, lr in sorted(series):
        if p is not None and t <= p["t"]:
            late = {"t": t, "lr": BAD, "s": [None] * 7, "d": [0] * 7, "status": 4, "klass": 0}
            final.append(late)
            continue
        row, added, episode, mark = step(p, t, lr, limits)
        online.append({**row, "s": list(row["s"]), "d": list(row["d"])})
        if mark:
            status, klass, start = mark
            for r in final:
                if r["s"][status - 1] == start and r["status"] != 4:
                    r["status"] = status
                    if status == 2:
                        r["klass"] = klass
            marks.append((*mark, t))
        final.extend(added)
        final.append({**row, "s": list(row["s"]), "d": list(row["d"])})
        if episode:
            found.append(episode)
        p = row
    return {"online": online, "final": final, "episodes": found, "marks": marks, "state": p}
