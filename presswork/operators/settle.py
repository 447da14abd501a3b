"""Computed columns that are evaluated exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(frame: DataFrame, keep: list[str] | None = None, **columns: Column) -> DataFrame:
    """``frame`` plus computed columns whose expressions stay where they are.

    Spark moves a filter on a computed column below the projection by copying
    the expression into the filter; with parsing or hashing behind it, that
    work is then done again per use. A one-row inline() generates the columns
    instead, and filters and later projections read the stored values.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    names = frame.columns if keep is None else keep
    kept = [F.col(c) for c in names if c not in columns]
    return frame.select(*kept, F.inline(F.array(made)))
