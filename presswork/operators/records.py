"""Consumed bus records as events: decoding, required fields, the event's source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.errors import error_struct
from presswork.operators import bus
from presswork.operators.settle import settle

POSITION = ["topic", "partition", "offset"]
RECORD = "topic string, partition int, offset bigint, ts timestamp, value binary"


def failed(
    stage: str, message: Column, error_class: str | Column, retry: bool | Column | None = None,
    status_code: Column | None = None,
) -> Column:
    """The error struct of a rule that failed; ``retry`` None takes the stage's flag."""
    lit = lambda x: x if isinstance(x, Column) or x is None else F.lit(x)
    return error_struct(F.lit(stage), lit(error_class), message, lit(retry), status_code)


def decoded_events(records: DataFrame, version: str, fields: str, registry: DataFrame | None = None) -> DataFrame:
    """Records with the ``fields`` (DDL) of their event, and the ``error`` of those that
    have none: bytes that do not decode, a foreign schema, a required field missing."""
    read = bus.decode(records, registry)
    wanted = F.array(*map(F.lit, bus.REQUIRED_FIELDS[version]))
    parts = settle(
        read, _event=F.from_json("json", fields), _present=F.from_json("json", "map<string,string>")
    )
    missing = F.filter(wanted, lambda f: F.try_element_at(F.col("_present"), f).isNull())
    own = F.try_element_at(F.col("_present"), F.lit("schema_version"))
    error = (
        F.when(F.col("verdict").isNotNull(), F.col("verdict"))
        .when(~own.eqNullSafe(version), F.concat(F.lit("not an "), F.lit(version), F.lit(" event")))
        .when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")))
    )
    return settle(parts, _error=error).select(
        *records.columns, "_event.*",
        F.when(F.col("_error").isNotNull(), failed("event_decode", F.col("_error"), "ValueError")).alias("error"),
    )


def with_source(events: DataFrame, settings: DataFrame) -> DataFrame:
    """Events with their source's settings; an unknown or disabled source is an error.

    ``settings`` has one row per source_id, with ``enabled``."""
    known = events.join(settings.withColumn("_known", F.lit(True)), "source_id", "left")
    name = F.coalesce("source_id", F.lit(""))
    wrong = F.when(F.col("_known").isNull(), F.concat(F.lit("unknown source: "), name)).when(
        ~F.col("enabled"), F.concat(F.lit("disabled source: "), name)
    )
    error = F.when(wrong.isNotNull(), failed("source_select", wrong, "ValueError"))
    return known.withColumn("error", F.coalesce("error", error)).drop("_known", "enabled")
