"""Rank-one updates, combined spectra and whitened rows against numpy's decomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from presswork.llm import whitening as wh

FOLDER = "/root/testdata/sf0.01"


def test_rank_one_updates():
    rng = np.random.default_rng(0)
    for t in range(200):
        n = rng.integers(1, 65)
        kinds = (
            rng.normal(size=n) ** 2, np.zeros(n), rng.integers(0, 4, n).astype(float), 10.0 ** rng.integers(-12, 12, n),
            np.repeat(rng.normal(size=1) ** 2, n) + 1e-14 * rng.normal(size=n),
        )
        d, z = np.sort(kinds[t % 5]), rng.normal(size=n) * 10.0 ** rng.integers(-6, 6)
        if t % 3 == 0:
            z[rng.random(n) < 0.5] = 0
        values, vectors = wh.rank_one(d, z)
        size = max(abs(d).max(), z @ z, 1e-300)
        assert abs(vectors @ np.diag(values) @ vectors.T - np.diag(d) - np.outer(z, z)).max() < 1e-12 * size
        assert abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12 and (np.diff(values) >= 0).all()


def test_rows_and_combined_spectra():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(700, 12)) * rng.integers(1, 900, 12)) + wh.OFFSET
    x[100:300] = x[7]
    parts = []
    for rows in (x[:1], x[1:5], x[5:400], x[400:]):
        parts.append(wh.Spectrum.empty(12))
        for row, n in zip(*np.unique(rows, axis=0, return_counts=True)):
            parts[-1].add(row, int(n))
    for other in parts[1:]:
        parts[0].combine(other)
    whole = (x - x.mean(0)).T @ (x - x.mean(0))
    s = parts[0]
    assert s.n == 700 and np.allclose(s.mean, x.mean(0), rtol=1e-12)
    assert abs(s.axes @ np.diag(s.spread) @ s.axes.T - whole).max() < 1e-9 * abs(whole).max()


def expected(rows, top=8):
    """{(id, component): figures} by exact sums and numpy's eigh."""
    good = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows]
    n, dim = len(good), len(good[0][1])
    sums = [sum(v[j] for _, v in good) for j in range(dim)]
    x = np.array([[v[j] - sums[j] // n for j in range(dim)] for _, v in good], float) - [(s % n) / n for s in sums]
    values, vectors = np.linalg.eigh(x.T @ x / n)
    out = []
    for (i, v), row in zip(good, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        for c in range(min(top, dim)):
            e = values[::-1][c]
            flat = e <= 1e-12 * values.sum()
            out.append((i, c + 1, n, deviation, None if flat else abs(row @ vectors[:, ::-1][:, c]) / math.sqrt(e),
                        e / values.sum() if values.sum() > 0 else None))
    return out


def check(made, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    made, want = sorted(map(tuple, made), key=key), sorted(want, key=key)
    assert [r[:4] for r in made] == [r[:4] for r in want]
    for a, b in zip(made, want):
        assert (a[4] is None) == (b[4] is None) and (a[5] is None) == (b[5] is None)
        assert a[4] is None or abs(abs(a[4]) - b[4]) < 1e-6 * (1 + b[4])
        assert a[5] is None or abs(a[5] - b[5]) < 1e-9


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n int").repartition(parts)


def test_whitened_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) * range(1, 11)).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in (0, 0, 400, None)]
    odd = [(1, None), (2, []), (3, [1.0] * 9), (4, [1.0] * 9 + [None]), (5, [float("nan")] * 10), (6, [1e300] * 10)]
    made = wh.whiten(frame(spark, rows + odd)).collect()
    check(made, expected(rows))
    assert {round(r.identity_error, 9) for r in made} == {0.0} and len({r.identity_error for r in made}) == 1


@pytest.mark.parametrize("parts", [1, 40])
def test_levels_of_spectra(spark, monkeypatch, parts):
    monkeypatch.setattr(wh, "FAN", 3)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=5) * [1, 2, 3, 5, 8]).tolist()) for i in range(120)]
    for fold in (1, 7):
        check(wh.whiten(frame(spark, rows, parts), fold=fold).collect(), expected(rows))


def test_flat_wide_and_empty(spark):
    same = [(i, [0.5, -0.25, 1.0]) for i in range(4)]
    check(wh.whiten(frame(spark, same)).collect(), expected(same))
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    check(wh.whiten(frame(spark, line)).collect(), expected(line))
    made = wh.whiten(frame(spark, [(1, [2.0**51, 0.0]), (2, [-(2.0**51), 0.0]), (3, [0.0, 1.0])])).collect()
    assert len(made) == 6 and {r.deviation for r in made if r.vec_id < 3} == {None}
    assert wh.whiten(frame(spark, []).limit(0)).collect() == []
    assert wh.whiten(frame(spark, [(1, None)])).collect() == []


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    made = wh.query(spark, FOLDER).collect()
    check([r[:6] for r in made], expected(rows))
    assert made[0].identity_error < 1e-9
