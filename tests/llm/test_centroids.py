"""Clusters against plain integer k-means and against SQL; bounds that never exceed distances."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from checks.compare import compare, duck
from presswork.llm import centroids as ce

FOLDER = "/root/testdata/sf0.001"


def plain(rows, k, rounds, dim):
    """rows of (id, vector): cluster, distance and digest by Python integers."""
    good = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x) < 2**52 for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(good, key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v: min((far(v, c), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        own = [best(v)[1] for _, v in good]
        new = []
        for c in range(len(cents)):
            mine = [v for (_, v), o in zip(good, own) if o == c]
            new.append([sum(col) // len(mine) for col in zip(*mine)] if mine else cents[c])
        cents = new
    out = [(i, *best(v)) for i, v in good]
    fits = lambda s: s if s < 1 << 63 else None
    inertia = {c: sum(d for _, d, o in out if o == c) for c in range(len(cents))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    if any(d >= 1 << 63 for _, d, _ in out):
        lost = {o for _, d, o in out if d >= 1 << 63}
        return sorted(((i, o, fits(d), None if o in lost else fits(inertia[o]), None, digest[o]) for i, d, o in out), key=repr)
    return sorted(((i, o, d, fits(inertia[o]), fits(sum(inertia.values())), digest[o]) for i, d, o in out), key=repr)


def got(spark, rows, k=8, rounds=10, dim=4, lead=2):
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string").repartition(3)
    return sorted((tuple(r) for r in ce.report(*ce.cluster(frame, k=k, rounds=rounds, dim=dim, lead=lead)).collect()), key=repr)


def vectors(n, dim, seed, spread=1.0):
    rnd = random.Random(seed)
    return [(i, [rnd.choice([-1.0, 0.0, 1.0]) + rnd.gauss(0, 0.2) * spread for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("lead", [1, 4, 9])
def test_clusters(spark, lead):
    rows = vectors(200, 4, 3)
    rows += [(i + 500, [0.5, 0.5, 0.5, 0.5]) for i in range(100)] + [(7, v) for _, v in rows[:5]]
    assert got(spark, rows, lead=lead) == plain(rows, 8, 10, 4)


def test_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), float(i % 2), 0.0, 0.0]) for i in range(60)]
    rows += [
        (None, [9.0, 9.0, 9.0, 9.0]), (None, [1.0, 0.0, 0.0, 0.0]), (100, None), (101, []), (102, [1.0] * 5), (103, [1.0, None, 1.0, 1.0]),
        (104, [nan, 0.0, 0.0, 0.0]), (105, [0.0, -inf, 0.0, 0.0]), (106, [1e300, 0.0, 0.0, 0.0]), (107, [-0.0, 1e-9, -1e-9, 0.0]),
    ]
    assert got(spark, rows) == plain(rows, 8, 10, 4)


def test_wide_entries_are_exact(spark):
    rows = vectors(60, 4, 8, 1e6) + [(900, [2.0**51, 0.0, 0.0, 0.0]), (901, [-(2.0**51), 1.0, 2.0, 3.0])]
    assert got(spark, rows, k=3) == plain(rows, 3, 10, 4)


def test_few_and_no_rows(spark):
    for n in (0, 1, 3):
        rows = vectors(n, 4, 5)
        assert got(spark, rows) == plain(rows, 8, 10, 4)


def test_bounds_spare_most_distances():
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(8, 64)) * 1000
    x = np.floor(middle[rng.integers(0, 8, 4000)] + rng.normal(size=(4000, 64)) * 80).astype(np.int64)
    axes = np.linalg.eigh(np.cov(x.T.astype(float)))[1][:, ::-1]
    turn = ce.Rotation(x.mean(0), axes, 16)
    cents = np.floor(middle).astype(np.int64)
    best, distance, measured = ce.nearest(x, *turn.of(x), cents, turn)
    every = ((x[:, None, :] - cents) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert measured < 1.1 * len(x)


def test_query_matches_sql(spark):
    _, rows, problem = compare(spark, duck(FOLDER), "op12", ce.query, ce.SQL, FOLDER)
    assert rows and not problem, problem
