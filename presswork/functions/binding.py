"""Evaluate an expression once and use it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed a single time per row.

    Plain Column reuse repeats the expression in the plan; inside a lambda it
    would even run once per array element. A one-element transform binds it.
    """
    return F.transform(F.array(value), body)[0]


def _literal(value: str | int | bool) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower()


def literal_array(values) -> Column:
    """An array of fixed texts, numbers or flags, made in one call."""
    return F.expr(f"array({', '.join(map(_literal, values))})")


def literal_map(pairs) -> Column:
    """A map of fixed keys and values, made in one call."""
    return F.expr(f"map({', '.join(_literal(x) for pair in pairs for x in pair)})")
