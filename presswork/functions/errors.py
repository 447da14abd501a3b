"""Stages, error records, HTTP status classes and retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.binding import literal_map

# Stage -> does an untyped failure in it get retried?
STAGES = {
    "config_load": False,
    "source_select": False,
    "feed_select": False,
    "feed_parse": False,
    "event_decode": False,
    "event_bus_connect": True,
    "storage_connect": True,
    "event_consume": True,
    "event_commit": True,
    "event_publish": True,
    "checkpoint_read": True,
    "checkpoint_write": True,
    "payload_read": True,
    "payload_write": True,
    "feed_fetch": True,
    "article_fetch": True,
    "article_extract": False,
    "feed_item_validate": False,
    "schema_registry": True,
    "dlq_replay": False,
}


def stage_retryable(stage: Column) -> Column:
    """Default retry flag of a stage; unknown stages are not retried."""
    flags = literal_map(STAGES.items())
    return F.coalesce(F.try_element_at(flags, stage), F.lit(False))


def error_struct(
    stage: Column, error_class: Column, message: Column,
    own_flag: Column | None = None, status_code: Column | None = None,
    untyped: Column | None = None,
) -> Column:
    """The error record of a reject branch.

    ``own_flag`` is the retry flag a typed error brings along (null: take the
    stage's); ``untyped`` marks failures no stage claimed.
    """
    stray = F.lit(False) if untyped is None else F.coalesce(untyped, F.lit(False))
    flag = stage_retryable(stage)
    if own_flag is not None:
        flag = F.coalesce(own_flag, flag)
    code = F.lit(None).cast("int") if status_code is None else status_code.cast("int")
    return F.struct(
        F.when(stray, "unexpected").otherwise(stage).alias("stage"),
        (~stray & flag).alias("retryable"),
        error_class.alias("error_class"),
        message.alias("error_message"),
        F.when(~stray, code).alias("status_code"),
    )


def retryable_status(status: Column) -> Column:
    return status.isin(408, 425, 429) | (status >= 500)


def status_class(status: Column, blocked: Column | None = None, feed: bool = False) -> Column:
    """ok, blocked, retryable or permanent; feeds also know not_modified.

    The source's blocked codes are looked at first. Redirects count as
    'redirect': they are followed, not classified.
    """
    blocked_first = F.lit(False) if blocked is None else F.coalesce(
        F.array_contains(blocked, status), F.lit(False)
    )
    feed_304 = (status == 304) if feed else F.lit(False)
    return (
        F.when(feed_304, F.lit("not_modified"))
        .when((status >= 200) & (status < 300), F.lit("ok"))
        .when(status.isin(301, 302, 303, 307, 308), F.lit("redirect"))
        .when(blocked_first, F.lit("blocked"))
        .when(retryable_status(status), F.lit("retryable"))
        .otherwise(F.lit("permanent"))
    )


def http_retry_delay(attempt: Column, backoff_seconds: float) -> Column:
    return attempt * F.lit(float(backoff_seconds))


def consumer_retry_delay(
    attempt: Column, base: float = 1.0, maximum: float = 60.0, jitter: Column | float = 0.0
) -> Column:
    """Doubling delay with a ceiling; jitter is added below the ceiling."""
    extra = jitter if isinstance(jitter, Column) else F.lit(float(jitter))
    doubled = F.least(F.lit(float(maximum)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1))
    return F.least(F.lit(float(maximum)), doubled + extra)
