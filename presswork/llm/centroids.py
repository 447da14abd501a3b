"""k-means over integer vectors, with distances bounded in a PCA-rotated space.

Vectors become integers, floor(1024 * x). One pass sums their second moments; the
eigenvectors of the covariance rotate them, and a stored table holds each vector's leading
rotated coordinates and the norm of the rest. In every round a centroid is rotated alike,
and the projected distance plus the squared difference of the two rest norms is at most
the true squared distance. A vector's centroid of the least bound is measured in integers
first; the others only where their bound, less the room for rounding, does not exceed the
best distance so far. So assignments are exact, ties included, and most exact distances
are never computed.

A round is one scan of the stored table and one aggregate of a partial sum per task,
centroid and dimension; only the k centroids reach the driver. Sums and means are exact
(Python integers and decimals). A large cluster is as many partial sums as any other. The
stored table and the assignments lie in the shared folder, so a lost executor costs its
running tasks. A round that changes no centroid ends the loop, as later ones repeat it.

Defined results: rows whose vector is null, has another length, or holds null, non-finite
entries or such of 2**52 and more are left out; rows that repeat an id or a vector are
clustered each on its own; null ids are clustered and start no centroid while others can;
with fewer than k vectors there are as many centroids as vectors; an empty table gives an
empty result. A distance or inertia beyond a long is null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow, read, saved
from presswork.llm.vectors import SCALE, exactly_summed, longs, matrix, scaled, summed, usable

DIM, K, ROUNDS = 64, 8, 10
#: Leading coordinates that are stored and compared.
LEAD = 16
#: Entries below this size have squared distances that fit a long (up to 64 of them).
NARROW = 1 << 27
#: Room for the rounding of a bound, relative to the squared norms.
SLACK = 1e-12


@dataclass
class Rotation:
    mean: np.ndarray
    axes: np.ndarray
    lead: int

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the others, one row each."""
        turned = (x.astype(np.float64) - self.mean) @ self.axes
        return turned[:, : self.lead], np.sqrt((turned[:, self.lead :] ** 2).sum(1))


def rotation(rows: DataFrame, dim: int, lead: int) -> Rotation:
    """The principal axes of all vectors, strongest first; any rotation keeps the bounds true."""

    def moments(batch):
        x = scaled(matrix(batch.column(0), dim)).astype(np.float64)
        return np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])

    total = summed(rows.select("vector"), moments, 1 + dim + dim * dim)
    n, mean = total[0], total[1 : 1 + dim] / max(total[0], 1)
    spread = total[1 + dim :].reshape(dim, dim) / max(n, 1) - np.outer(mean, mean)
    axes = np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1] if np.isfinite(spread).all() else np.eye(dim)
    return Rotation(mean, axes, min(lead, dim))


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances: in longs where they fit, else in Python integers."""
    step = x - centroid
    return (step * step).sum(1)


def nearest(x, lead, rest, centroids, turn: Rotation):
    """Numbers of the nearest centroids, their squared distances, and how many were measured."""
    wide = max(abs(x).max(), abs(centroids).max()) >= NARROW
    x, centroids = (x.astype(object), centroids.astype(object)) if wide else (x, centroids)
    own_lead, own_rest = turn.of(centroids)
    low = np.empty((len(x), len(centroids)))
    for c in range(len(centroids)):
        low[:, c] = ((lead - own_lead[c]) ** 2).sum(1) + (rest - own_rest[c]) ** 2
    room = SLACK * ((lead**2).sum(1)[:, None] + (rest**2)[:, None] + (own_lead**2).sum(1) + own_rest**2)
    best = low.argmin(1)
    distance = squared(x, centroids[best])
    measured = len(x)
    for c in range(len(centroids)):
        left = np.flatnonzero((best != c) & ~(low[:, c] - room[:, c] > distance.astype(np.float64)))
        if not len(left):
            continue
        measured += len(left)
        found = squared(x[left], centroids[c])
        won = left[(found < distance[left]) | ((found == distance[left]) & (c < best[left]))]
        distance[won] = squared(x[won], centroids[c])
        best[won] = c
    return best, distance, measured


def _stored(rows: DataFrame, keep: list[str], turn: Rotation, dim: int) -> DataFrame:
    names = [*keep, "vector", "lead", "rest"]

    def work(batches):
        for batch in batches:
            lead, rest = turn.of(scaled(matrix(batch.column(len(keep)), dim)))
            flat = pa.ListArray.from_arrays(np.arange(len(lead) + 1, dtype=np.int32) * turn.lead, lead.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, flat, pa.array(rest)], names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return saved(in_arrow(rows, work, f"{kinds}, lead array<double>, rest double"), "rotated")


def _parts(batch, at: int, dim: int, turn: Rotation):
    x = scaled(matrix(batch.column(at), dim))
    return x, matrix(batch.column(at + 1), turn.lead), batch.column(at + 2).to_numpy()


def _step(stored: DataFrame, centroids: np.ndarray, turn: Rotation) -> np.ndarray:
    """The centroids after one round."""
    k, dim = centroids.shape

    def sums(batch):
        x, lead, rest = _parts(batch, 0, dim, turn)
        best, _, _ = nearest(x, lead, rest, centroids, turn)
        if abs(x).max() >= NARROW:
            x = x.astype(object)
        out = np.zeros((k, dim + 1), object)
        for c in range(k):
            own = x[best == c]
            out[c, 0], out[c, 1:] = len(own), own.sum(0).astype(object) if len(own) else 0
        return out.ravel()

    total = exactly_summed(stored.select("vector", "lead", "rest"), sums, k * (dim + 1))
    moved = centroids.copy()
    for c in range(k):
        n, *own = total[c * (dim + 1) : (c + 1) * (dim + 1)]
        if n:
            moved[c] = [s // n for s in own]
    return moved


def seeds(rows: DataFrame, ident: str, k: int, salt: str) -> list:
    """The k vectors whose ids have the smallest sha256 of ``salt:id``."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(ident).cast("string")), 256)
    return [r.vector for r in rows.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k).collect()]


def cluster(
    frame: DataFrame, ident: str = "vec_id", vector: str = "embedding",
    k: int = K, rounds: int = ROUNDS, dim: int = DIM, lead: int = LEAD, salt: str = "3",
) -> tuple[DataFrame, np.ndarray]:
    """(``ident``, cluster, distance) of every usable row, and the final centroids."""
    rows = frame.filter(usable(F.col(vector)) & (F.size(vector) == dim))
    rows = rows.select(F.col(ident).alias("id"), F.col(vector).alias("vector"))
    first = seeds(rows, "id", k, salt)
    schema = f"id {dict(rows.dtypes)['id']}, cluster int, distance long"
    if not first:
        return frame.sparkSession.createDataFrame([], schema).withColumnRenamed("id", ident), np.zeros((0, dim), np.int64)
    centroids = scaled(np.array(first, np.float64))
    turn = rotation(rows, dim, lead)
    stored = _stored(rows, ["id"], turn, dim)
    for _ in range(rounds):
        moved = _step(stored, centroids, turn)
        if (moved == centroids).all():
            break
        centroids = moved

    def assign(batches):
        for batch in batches:
            best, distance, _ = nearest(*_parts(batch, 1, dim, turn), centroids, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.int32()), longs(distance)], ["id", "cluster", "distance"]
            )

    return saved(in_arrow(stored, assign, schema), "assigned").withColumnRenamed("id", ident), centroids


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assignments with the inertia of their cluster and of all, and their centroid's digest."""
    exact = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {c: s for c, s in assigned.groupBy("cluster").agg(exact).collect()}
    total = sum(sums.values()) if all(s is not None for s in sums.values()) else None
    number = lambda s: F.lit(None if s is None or s >= 1 << 63 else int(s)).cast("long")
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    pick = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)
    return assigned.withColumns({
        "cluster_inertia": pick([number(sums.get(c, 0)) for c in range(len(centroids))]).cast("long"),
        "inertia": number(total),
        "centroid_sha256": pick([F.lit(d) for d in digests]).cast("string"),
    })


def query(spark, folder: str) -> DataFrame:
    return report(*cluster(read(spark, folder, "embeddings")))


def _sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, c, d FROM (
    SELECT vec_id, c, sum((p.x - m.x) * (p.x - m.x)) AS d FROM p JOIN c{r} AS m USING (j) GROUP BY vec_id, c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, j, (s - ((s % n) + n) % n) // n AS x FROM (
    SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM p JOIN a{r} USING (vec_id) GROUP BY c, j)
  UNION ALL SELECT c, j, x FROM c{r} WHERE c NOT IN (SELECT c FROM a{r}))""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
p AS MATERIALIZED (SELECT vec_id, unnest(range({DIM})) AS j, unnest(v) AS x FROM k),
c0 AS MATERIALIZED (
  SELECT c, unnest(range({DIM})) AS j, unnest(v) AS x
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM k) WHERE c < {K}),
{", ".join(steps)},
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS h FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  h AS centroid_sha256
FROM a{ROUNDS} JOIN digest USING (c)
"""


SQL = _sql()
