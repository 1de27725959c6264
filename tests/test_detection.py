"""The set-based detection against hand-traced scenarios and the reading-by-reading model."""

import random
from functools import reduce

import pytest

from feederlens import Limits
from feederlens.operators import episodes as E
from feederlens.operators.runs import track
from helpers import (
    at, frame, model_episodes, model_marks, model_rows, state_frame, table, to_dt,
)
from model import BAD, run


def scenario(*pairs):
    return [(at(clock), lr) for clock, lr in pairs]


QUARTERS = ["00:00", "00:15", "00:30", "00:45", "01:00", "01:15", "01:30", "01:45", "02:00",
            "02:15", "02:30"]
S1 = scenario(*zip(QUARTERS, [0.7, 0.9, 0.9, 0.9, 0.7]))
S2 = scenario(*zip(QUARTERS, [0.7, 1.2, 1.2, 1.2, 0.7]))
S3 = scenario(*zip(QUARTERS, [0.7, 0.9, 0.9, 0.9, 1.1, 1.1, 1.1, 1.1, 0.9, 0.9, 0.7]))
S4 = scenario(("00:00", 0.9), ("00:15", 0.9), ("00:30", 0.9), ("01:00", 0.9))
S5 = scenario(*zip(QUARTERS, [0.9, 0.9, 0.9, BAD, 0.9]))
S6 = scenario(*zip(QUARTERS, [1.9, 1.9, 1.9, 1.1, 1.1, 0.7]))
ALL = {1: S1, 2: S2, 3: S3, 4: S4, 5: S5, 6: S6}

# The hand-traced results.
EPISODES = {
    1: [(1, 0, "00:07:30.000", "00:52:29.999", 44)],
    2: [(2, 1, "00:09:00.000", "00:50:59.999", 41)],
    3: [(1, 0, "00:07:30.000", "00:52:29.999", 44), (2, 1, "00:52:29.999", "01:52:30.000", 60),
        (1, 0, "01:52:30.000", "02:22:29.999", 29)],
    4: [(1, 0, "00:00", "00:30", 30)],
    5: [(1, 0, "00:00", "00:30", 30)],
    6: [(2, 1, "00:00", "01:03:45.000", 63)],
}
STATUS = {
    1: [("00:00", 0, 0), ("00:07:30.000", 1, 0), ("00:15", 1, 0), ("00:30", 1, 0),
        ("00:45", 1, 0), ("00:52:29.999", 1, 0), ("01:00", 0, 0)],
    2: [("00:00", 0, 0), ("00:09:00", 2, 1), ("00:15", 2, 1), ("00:30", 2, 1), ("00:45", 2, 1),
        ("01:00", 0, 0)],
    3: [("00:00", 0, 0), ("00:07:30", 1, 0), ("00:15", 1, 0), ("00:30", 1, 0), ("00:45", 1, 0),
        ("00:52:29.999", 2, 1), ("01:00", 2, 1), ("01:15", 2, 1), ("01:30", 2, 1),
        ("01:45", 2, 1), ("02:00", 1, 0), ("02:15", 1, 0), ("02:22:29.999", 1, 0),
        ("02:30", 0, 0)],
    4: [("00:00", 1, 0), ("00:15", 1, 0), ("00:30", 1, 0), ("01:00", 0, 0)],
    5: [("00:00", 1, 0), ("00:15", 1, 0), ("00:30", 1, 0), ("00:45", 3, 0), ("01:00", 0, 0)],
    6: [("00:00", 2, 2), ("00:15", 2, 2), ("00:30", 2, 2), ("00:45", 2, 3), ("01:00", 2, 1),
        ("01:15", 0, 0)],
}


def check(spark, by_key, limits=Limits(), states=None):
    results = {k: run(s, limits, (states or {}).get(k)) for k, s in by_key.items()}
    state = state_frame(spark, states) if states else None
    tracked = track(frame(spark, by_key), limits, state).persist()
    try:
        assert table(E.online_rows(tracked)) == model_rows(results, "online")
        assert table(E.final_rows(tracked, limits)) == model_rows(results, "final")
        assert table(E.episodes(tracked, limits)) == model_episodes(results)
        assert table(E.marks(tracked)) == model_marks(results)
    finally:
        tracked.unpersist()
    return results


def test_hand_traced_scenarios(spark):
    results = check(spark, ALL)
    for k in ALL:
        got = [(s, c, to_dt(a), to_dt(b), d) for s, c, a, b, d in results[k]["episodes"]]
        assert got == [(s, c, to_dt(at(a)), to_dt(at(b)), d) for s, c, a, b, d in EPISODES[k]]
        rows = sorted((r["t"], r["status"], r["klass"]) for r in results[k]["final"])
        assert rows == [(at(t), s, c) for t, s, c in STATUS[k]]


def test_sticky_long_class(spark):
    results = check(spark, ALL, Limits(sticky_long=True))
    assert [r["klass"] for r in results[6]["final"]] == [2, 2, 2, 3, 3, 0]
    assert results[6]["episodes"][0][1] == 3


def series(rng, n, cadence):
    """A random walk that crosses all levels, with gaps, bad values and odd cadences."""
    t, lr, out = at("00:00") + rng.randrange(10**7), 1.0, []
    for _ in range(n):
        t += {
            "grid": lambda: 900_000 * rng.choice([1, 1, 1, 1, 2]),
            "odd": lambda: rng.choice([rng.randrange(1, 1_500_000), 1_200_000, 1_200_001, 1_200_999]),
            "dense": lambda: rng.randrange(1, 400_000),
        }[cadence]()
        lr = min(2.2, max(0.5, lr + rng.gauss(0, 0.15)))
        value = rng.choice([0.8, 1.0, 1.2, 1.8]) if rng.random() < 0.08 else round(lr, 4)
        out.append((t, BAD if rng.random() < 0.02 else value))
    return out


def many(seed, keys=40, n=120):
    rng = random.Random(seed)
    return {k: series(rng, n, ("grid", "odd", "dense")[k % 3]) for k in range(keys)}


@pytest.mark.parametrize("seed,slice_hours,sticky", [
    (1, 1, False), (2, 1, True), (3, 6, False), (4, 2, True), (5, 1000, False),
])
def test_random_series_in_slices(spark, seed, slice_hours, sticky):
    check(spark, many(seed), Limits(slice_hours=slice_hours, sticky_long=sticky))


@pytest.mark.parametrize("seed,sticky", [(11, False), (12, True), (13, False)])
def test_random_series_continue_from_state(spark, seed, sticky):
    limits = Limits(slice_hours=1, sticky_long=sticky)
    rng = random.Random(seed)
    by_key = many(seed)
    cuts = {k: rng.randrange(0, len(s)) for k, s in by_key.items()}
    states = {k: run(s[: cuts[k]], limits)["state"] for k, s in by_key.items()}
    check(spark, {k: s[cuts[k]:] for k, s in by_key.items()}, limits, states)


def test_scenarios_split_after_every_row(spark):
    """Batch = stream: the second part continues from the state of the first."""
    cuts = {100 * k + cut: (s, cut) for k, s in ALL.items() for cut in range(1, len(s))}
    states = {k: run(s[:cut])["state"] for k, (s, cut) in cuts.items()}
    check(spark, {k: s[cut:] for k, (s, cut) in cuts.items()}, states=states)


def test_other_limits(spark):
    limits = Limits(
        levels=(0.6, 0.9, 1.0, 1.1, 1.2, 1.4, 1.7), gap_minutes=16, confirm_minutes=40,
        hold_minutes=10, long_minutes=(200, 150, 100, 60, 45), grid_minutes=10, slice_hours=1,
    )
    check(spark, many(21), limits)


def test_late_copies_are_counted_per_time(spark):
    by_key = {1: [(at("00:00"), 0.5), (at("00:00"), 0.9), (at("00:00"), 0.7), (at("00:15"), 0.6)],
              2: [(at("00:00"), 0.5)]}
    readings = frame(spark, by_key)
    late = E.late_rows(E.late_copies(readings))
    results = {k: run(s) for k, s in by_key.items()}
    got = table(E.final_rows(track(readings)).unionByName(late))
    assert got == model_rows(results, "final")
    assert sum(1 for r in got if r[16] == 4) == 2


def test_marks_repair_stored_rows(spark):
    """Rows stored by an earlier batch end up as if all had come in one batch."""
    limits = Limits(slice_hours=1)
    by_key = many(31)
    cut = 60
    parts = [{k: s[:cut] for k, s in by_key.items()}, {k: s[cut:] for k, s in by_key.items()}]
    states = {k: run(s, limits)["state"] for k, s in parts[0].items()}
    first = track(frame(spark, parts[0]), limits)
    second = track(frame(spark, parts[1]), limits, state_frame(spark, states))
    stored = E.final_rows(first, limits).unionByName(E.final_rows(second, limits))
    marked = reduce(lambda a, b: a.unionByName(b), [E.marks(first), E.marks(second)])
    whole = {k: run(s, limits) for k, s in by_key.items()}
    assert table(E.apply_marks(stored, marked, limits)) == model_rows(whole, "final")


def test_limits_are_validated():
    for bad in [dict(levels=(1.0,)), dict(gap_minutes=0), dict(slice_hours=0),
                dict(long_minutes=(480, 240, 120, 60, 10)), dict(hold_minutes=31)]:
        with pytest.raises(ValueError):
            Limits(**bad)
