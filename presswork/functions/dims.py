"""Metric dimensions: cleaning, naming and canonical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.binding import let
from presswork.functions.text import strip

DIMENSION_CHARS = 128


def clean_dimension(value: Column) -> Column:
    """Trimmed and cut to the size the metric store accepts; null becomes ''."""
    return F.left(strip(F.coalesce(value.cast("string"), F.lit(""))), F.lit(DIMENSION_CHARS))


def clean_dimension_name(name: Column) -> Column:
    """snake_case to camelCase."""
    capital = lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substring(p, 2, 2**31 - 1)))
    return let(
        F.split(strip(name), "_"),
        lambda parts: F.concat(
            parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), capital), "")
        ),
    )


def _last_wins(entries: Column) -> Column:
    """Entries whose key does not come again later in the array."""
    return let(
        entries,
        lambda bound: F.filter(
            bound,
            lambda e, i: ~F.exists(
                F.slice(bound, i + 2, F.size(bound)), lambda later: later["key"] == e["key"]
            ),
        ),
    )


def clean_dimensions(dimensions: Column) -> Column:
    """map<string,string> -> array<struct<key,value>> of clean entries by key."""
    cleaned = F.transform(
        F.map_entries(dimensions),
        lambda e: F.struct(
            clean_dimension_name(e["key"]).alias("key"), clean_dimension(e["value"]).alias("value")
        ),
    )
    return F.sort_array(_last_wins(F.filter(cleaned, lambda e: e["value"] != "")))


def override(base: Column, extra: Column) -> Column:
    """Union of two maps in which the second wins."""
    return F.map_concat(
        F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k)), extra
    )


def entries_json(entries: Column) -> Column:
    """Canonical JSON object of sorted entries."""
    return F.to_json(F.map_from_entries(entries))


def dimension_entries(**values: Column) -> Column:
    """Sorted entries of named columns, taken as they are."""
    return F.array(
        *[
            F.struct(F.lit(k).alias("key"), values[k].cast("string").alias("value"))
            for k in sorted(values)
        ]
    )


def event_dimensions(dimensions: Column) -> Column:
    """Dimensions of a metric event: null and empty values dropped, sorted."""
    kept = F.map_filter(dimensions, lambda _, v: v.isNotNull() & (v != ""))
    return F.map_from_entries(F.sort_array(F.map_entries(kept)))
