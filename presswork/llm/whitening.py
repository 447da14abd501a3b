"""PCA whitening of embeddings by an incremental eigendecomposition.

Every entry c becomes the integer floor(1024 * c) + 100000. A task goes through its rows
and keeps the spectrum of their scatter matrix: each row, centred on the mean so far, is a
rank-one update of it. The updated eigenvalues are the roots of the secular equation,
found between the old ones, after deflation: equal eigenvalues are reflected so that one of
them carries the update, and entries that the update does not touch stay as they are. The
eigenvectors follow from the update that has exactly these roots (Loewner's formula), so
they stay orthogonal. Equal rows of a batch are one update of their number.

Two spectra combine by successive rank-one updates too, one per eigenpair of the smaller
tree and one for the distance of the means; FAN spectra meet in one group, in as many
levels as it takes, so a group is a few matrices however many rows there are. At last a
distributed Rayleigh-Ritz step projects all rows, centred on the exact mean, on the basis
found, and its small matrix gives eigenvalues and components to double precision.

n and the sums S are exact integers. The driver holds matrices of dim x dim only. Fit rows
and every level lie in the shared folder, so a lost executor costs its running tasks.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries or
such of 2**52 and more, are left out, and so are vectors of another length than the
commonest (the longer one of a tie); repeated ids and vectors count each; null ids stay; an
empty table gives an empty result. A component without variance (at most 1e-12 of the
trace) has null ``whitened`` and no part in ``identity_error``; without any variance
``explained`` is null. A deviation beyond a long is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow, read, saved
from presswork.llm.vectors import exactly_summed, longs, matrix, scaled, summed, usable

OFFSET, TOP = 100_000, 8
#: Spectra that meet in one group of a combining level.
FAN = 16
#: Rows of one output batch.
OUT_ROWS = 4096
#: Least part of the trace that counts as variance.
FLAT = 1e-12
EPS = np.finfo(np.float64).eps

SPECTRUM = "slot long, n long, mean array<double>, spread array<double>, axes array<double>"


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum z^2 / (d - x), one above each of the rising, different d.

    Returned as offsets from a pole and, as rows, the distances d - pole, so that root
    minus d is known to full precision even beside a pole."""
    k = len(d)
    weight = z * z
    gap = np.append(np.diff(d), weight.sum())
    poles = np.arange(k)
    middle = 1 + (weight / (d - d[:, None] - gap[:, None] / 2)).sum(1)
    right = (middle < 0) & (poles < k - 1)
    origin = np.where(right, poles + 1, poles)
    far = d - d[origin][:, None]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    high[-1], low[-1] = gap[-1], 0.0
    x = np.where(right, low, high)
    x[-1] = gap[-1] / 2
    left = poles[None, :] <= poles[:, None]
    start = d - d[origin]
    end = np.where(right, 0.0, gap)
    for _ in range(80):
        step = far - x[:, None]
        part = weight / step
        slope = part / step
        value = 1 + part.sum(1)
        done = np.abs(value) <= EPS * (1 + np.abs(part).sum(1))
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        if (done | (high - low <= EPS * np.abs(x))).all():
            break
        # two poles with the slopes of both sides stand for all (the middle way)
        before = np.where(left, slope, 0).sum(1)
        a, b = start - x, end - x
        after = slope.sum(1) - before
        c = value - a * before - b * after
        p, q = (a + b) * value - a * b * (before + after), a * b * value
        root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
        with np.errstate(all="ignore"):
            move = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
        new = x + move
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return x, far


def rank_one(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of diag(d) + z z', for rising d."""
    size = len(d)
    z = z.copy()
    length = np.sqrt(z @ z)
    tiny = 8 * EPS * (np.abs(d).max() + length * length)
    turned = None
    starts = np.flatnonzero(np.append(True, np.diff(d) > tiny))
    if len(starts) < size:
        # equal eigenvalues: reflect their part of z onto its last entry
        turned = np.eye(size)
        for a, b in zip(starts, np.append(starts[1:], size)):
            norm = np.sqrt(z[a:b] @ z[a:b])
            if b - a == 1 or norm == 0:
                continue
            mirror = z[a:b].copy()
            mirror[-1] += norm if mirror[-1] >= 0 else -norm
            turned[a:b, a:b] -= np.outer(mirror, mirror) * (2 / (mirror @ mirror))
            last = -norm if z[b - 1] >= 0 else norm
            z[a:b] = 0
            z[b - 1] = last
    live = np.flatnonzero(np.abs(z) * length > tiny)
    values, vectors = d.copy(), np.eye(size) if turned is None else turned
    if len(live):
        poles, sign = d[live], np.sign(z[live])
        x, far = secular_roots(poles, z[live])
        over = x[:, None] - far  # root j minus pole i
        between = poles[:, None] - poles
        np.fill_diagonal(between, 1.0)
        weight = np.sqrt(np.abs((over / between).prod(0)))
        own = (sign * weight) / over
        own /= np.sqrt((own * own).sum(1))[:, None]
        values[live] = poles + over.diagonal()
        vectors[:, live] = vectors[:, live] @ own.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """n rows, their mean, and the eigenvalues and eigenvectors of their scatter matrix."""

    n: int
    mean: np.ndarray
    spread: np.ndarray
    axes: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def _update(self, vector: np.ndarray) -> None:
        self.spread, turn = rank_one(self.spread, self.axes.T @ vector)
        self.axes = self.axes @ turn

    def _meet(self, mean: np.ndarray, n: int) -> None:
        step, total = mean - self.mean, self.n + n
        if self.n and step.any():
            self._update(step * np.sqrt(self.n * (n / total)))
        self.mean = self.mean + step * (n / total)
        self.n = total

    def add(self, row: np.ndarray, n: int = 1) -> None:
        self._meet(row, n)

    def add_block(self, rows: np.ndarray) -> None:
        """Many rows as the rank-one updates of their triangular factor."""
        mean = rows.mean(0)
        for row in np.linalg.qr(rows - mean, mode="r"):
            if row.any():
                self._update(row)
        self._meet(mean, len(rows))

    def combine(self, other: Spectrum) -> None:
        for value, axis in zip(other.spread, other.axes.T):
            if value > 0:
                self._update(axis * np.sqrt(value))
        self._meet(other.mean, other.n)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    return scaled(matrix(column, dim)) + OFFSET


def _spectra(rows: DataFrame, dim: int, fold: int) -> DataFrame:
    """One spectrum per task."""

    def work(batches):
        kept = Spectrum.empty(dim)
        for batch in batches:
            x = integers(batch.column(0), dim)
            if fold > 1:
                for at in range(0, len(x), fold):
                    kept.add_block(x[at : at + fold].astype(np.float64))
            elif len(x):
                for row, n in zip(*np.unique(x, axis=0, return_counts=True)):
                    kept.add(row.astype(np.float64), int(n))
        if kept.n:
            yield _as_batch(TaskContext.get().partitionId(), kept)

    return saved(in_arrow(rows, work, SPECTRUM), "spectra")


def _as_batch(slot: int, s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"slot": slot, "n": s.n, "mean": s.mean.tolist(), "spread": s.spread.tolist(), "axes": s.axes.ravel().tolist()}],
        pa.schema([("slot", pa.int64()), ("n", pa.int64()), *[(c, pa.list_(pa.float64())) for c in ("mean", "spread", "axes")]]),
    )


def _spectrum(row) -> Spectrum:
    mean = np.array(row["mean"])
    return Spectrum(int(row["n"]), mean, np.array(row["spread"]), np.array(row["axes"]).reshape(len(mean), -1))


def _combined(spectra: DataFrame) -> Spectrum:
    """All spectra in one, by levels of groups of FAN neighbours."""

    def meet(table: pa.Table) -> pa.Table:
        first, *others = sorted(table.to_pylist(), key=lambda r: r["slot"])
        kept = _spectrum(first)
        for other in others:
            kept.combine(_spectrum(other))
        return pa.Table.from_batches([_as_batch(first["slot"] // FAN, kept)])

    while spectra.filter("slot > 0").count():
        group = F.floor(F.col("slot") / FAN).alias("slot_group")
        spectra = saved(spectra.groupBy(group).applyInArrow(meet, SPECTRUM), "spectra")
    return _spectrum(spectra.first().asDict())


@dataclass
class Whitening:
    """What a fit leaves: exact counts and sums, components by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row per vector; nan for components without variance."""
        out = np.full((len(x), len(self.values)), np.nan)
        good = self.valid()
        out[:, good] = (self.centred(x) @ self.components[:, good]) / np.sqrt(self.values[good])
        return out

    def valid(self) -> np.ndarray:
        return self.values > FLAT * max(self.trace, 0.0)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - S)^2, in longs where they fit and else in Python integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], object)
        step = x - whole
        most = (int(abs(step).max()) + 1) * self.n
        if x.shape[1] * most * most < 1 << 63:
            step = step * self.n - rest.astype(np.int64)
        else:
            step = step.astype(object) * self.n - rest
        return (step * step).sum(1).tolist()


def fit(rows: DataFrame, dim: int, top: int = TOP, fold: int = 1) -> Whitening:
    """The whitening of all ``rows``, a frame of one column ``vector``."""
    total = exactly_summed(
        rows, lambda b: np.append(integers(b.column(0), dim).astype(object).sum(0), b.num_rows), dim + 1
    )
    made = Whitening(total[-1], total[:-1], np.zeros(0), np.zeros((dim, 0)), 0.0, None)
    basis = np.linalg.qr(_combined(_spectra(rows, dim, fold)).axes)[0]

    def projected(batch):
        turned = made.centred(integers(batch.column(0), dim)) @ basis
        return (turned.T @ turned).ravel()

    ritz = summed(rows, projected, dim * dim).reshape(dim, dim) / made.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    components = basis @ turn[:, ::-1][:, :top]
    # the sign is free: the largest entry is positive
    components = components * np.sign(components[abs(components).argmax(0), np.arange(components.shape[1])])
    fitted = Whitening(made.n, made.sums, values[::-1][:top], components, float(np.trace(ritz)), None)
    good = int(fitted.valid().sum())
    if good:

        def products(batch):
            white = fitted.whitened(integers(batch.column(0), dim))[:, fitted.valid()]
            return np.append(white.sum(0), (white.T @ white).ravel())

        sums = summed(rows, products, good + good * good) / fitted.n
        covariance = sums[good:].reshape(good, good) - np.outer(sums[:good], sums[:good])
        fitted.error = float(abs(covariance - np.eye(good)).max())
    return fitted


def whiten(
    frame: DataFrame, ident: str = "vec_id", vector: str = "embedding", top: int = TOP, fold: int = 1
) -> DataFrame:
    """A row per usable vector and component, with the fit's figures.

    ``fold`` above 1 takes that many rows as the updates of their triangular factor, as
    many as there are dimensions: the same spectrum for a fraction of the time."""
    rows = frame.filter(usable(F.col(vector)) & (F.size(vector) > 0))
    rows = rows.select(F.col(ident).alias("id"), F.col(vector).alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return frame.sparkSession.createDataFrame([], schema).withColumnRenamed("id", ident)
    dim = lengths.dim
    rows = saved(rows.filter(F.size("vector") == dim), "fit-rows")
    made = fit(rows.select("vector"), dim, top, fold)
    top = len(made.values)
    explained = [float(e) / made.trace if made.trace > 0 else None for e in made.values]

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                cut = batch.slice(at, OUT_ROWS)
                x, m = integers(cut.column(1), dim), cut.num_rows
                each = pa.array(np.repeat(np.arange(m), top))
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column(0).take(each), pa.array(np.tile(np.arange(1, top + 1), m), pa.int32()),
                        pa.array(np.full(m * top, made.n), pa.int64()), longs(made.deviations(x)).take(each),
                        pa.array(made.whitened(x).ravel(), pa.float64(), from_pandas=True),
                        pa.array(explained * m, pa.float64()), pa.array([made.error] * (m * top), pa.float64()),
                    ],
                    names,
                )

    return in_arrow(rows, work, schema).withColumnRenamed("id", ident)


def query(spark, folder: str) -> DataFrame:
    return whiten(read(spark, folder, "embeddings"))
