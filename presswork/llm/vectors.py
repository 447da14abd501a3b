"""What the operators on embeddings share: usable rows, integer forms, sums over all rows."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow

SCALE = 1024
#: Entries from here on have no scaled form in a long and count as not finite.
LARGEST = float(1 << 52)
LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """A vector that is there, with entries that all are numbers of the range."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(fits(x.cast("double")), F.lit(False)))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), dim)


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as longs; the product is exact, as 1024 is a power of two."""
    return np.floor(values * SCALE).astype(np.int64)


def summed(frame: DataFrame, work, size: int) -> np.ndarray:
    """The sum over all rows of what ``work`` maps batches to, an array of ``size`` doubles.

    A task sends one partial sum per place; Spark adds them, ``size`` numbers come back."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += work(batch)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["at", "value"])

    out = np.zeros(size)
    for at, value in in_arrow(frame, run, "at int, value double").groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out


def exactly_summed(frame: DataFrame, work, size: int) -> list[int]:
    """As summed(), in integers; ``work`` maps batches to arrays of Python integers."""

    def run(batches):
        total = np.zeros(size, object)
        for batch in batches:
            if batch.num_rows:
                total = total + work(batch)
        value = pa.array([Decimal(int(x)) for x in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), value], ["at", "value"])

    out = [0] * size
    for at, value in in_arrow(frame, run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value")).collect():
        out[at] = int(value)
    return out


def longs(values) -> pa.Array:
    """Python integers as longs; those beyond a long are null."""
    return pa.array([v if abs(v) <= LONG else None for v in map(int, values)], pa.int64())
