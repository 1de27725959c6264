"""Centroid clustering against a plain model, with vectors that need Python's integers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from llm_rows import rows

from feederlens.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<double>, cluster int, id string"
COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def plain(data, k, rounds, dim):
    kept = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in data if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), x[1]))
    now = [v for _, v in starts[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(now))
    for _ in range(rounds):
        mine = [[] for _ in now]
        for _, v in kept:
            mine[near(v)[1]].append(v)
        now = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else old for m, old in zip(mine, now, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    fits = lambda x: min(x, cc.MOST)
    far = lambda d: min(d, 10**38 - 1)
    per = {j: fits(sum(far(d) for _, d, c in found if c == j)) for _, _, j in found}
    return [(i, j, fits(d), per[j], fits(sum(per.values())), hashlib.sha256(",".join(map(str, now[j])).encode()).hexdigest()) for i, d, j in found]


def groups(seed, n, dim):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((6, dim))
    return [(i, (centres[i % 6] + 0.3 * rnd.standard_normal(dim)).tolist()) for i in range(n)]


def odd(dim):
    return [
        (1000, None), (1001, []), (1002, [0.5] * (dim - 1)), (1003, [float("nan")] * dim), (1004, [float("inf")] + [0.0] * (dim - 1)),
        (1005, [None] + [0.0] * (dim - 1)), (1006, [0.0] * dim), (1006, [0.0] * dim), (1006, [0.25] * dim), (None, [1.0] * dim), (1007, [-0.001] * dim),
    ]


@pytest.mark.parametrize(("extra", "k"), [([], 7), ([(7, [3e9] * 8), (8, [-1e20] * 8), (9, [1e300] + [0.1] * 7)], 5), ([], 200)])
def test_clusters_equal_a_plain_model(llm, extra, k):
    data = groups(1, 120, 8) + odd(8) + extra
    made = llm.createDataFrame([(i, v, 3, "x") for i, v in data], SCHEMA).repartition(5)
    got = rows(cc.cluster(made, k=k, rounds=3, dim=8, lead=3), *COLUMNS)
    assert got == sorted(plain(data, k, 3, 8), key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_only_odd_vectors_and_none(llm):
    made = llm.createDataFrame([(i, v, 3, "x") for i, v in odd(8)[:6]], SCHEMA)
    assert cc.cluster(made, dim=8).count() == 0
    assert cc.cluster(made.limit(0), dim=8).columns == list(COLUMNS)


def test_bounds_are_below_the_distances():
    rnd = np.random.default_rng(3)
    raw = rnd.standard_normal((300, 16)) * np.linspace(3, 0.1, 16)
    axes = np.linalg.qr(rnd.standard_normal((16, 16)))[0]
    values = cc.whole(raw, 256)
    known = cc.Assigner([tuple(map(int, v)) for v in values[:9]], axes, 5, 256)
    lead, rest = cc.projected(values.astype(float), axes, 5)
    exact = ((values[:, None] - values[None, :9]) ** 2).sum(2)
    assert (known.bounds(lead, rest) <= exact).all()
    chosen, distance = known.nearest(values, lead, rest)
    assert (distance == exact.min(1)).all() and (chosen == exact.argmin(1)).all()
