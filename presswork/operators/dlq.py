"""Dead letters: building, reading, replay rules and dispositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions import frames
from presswork.functions.ids import stable_id
from presswork.functions.text import iso_micros
from presswork.operators import bus
from presswork.operators.settle import settle


def dlq_events(failures: DataFrame, service: Column, now: Column) -> DataFrame:
    """DLQ rows of permanently failed records.

    failures: source_topic, source_partition, source_offset, value (bytes),
    stage, error_class, error_message. The payload keeps the record as JSON
    when it decodes and as base64 otherwise.
    """
    body = frames.frame_body(F.col("value")).cast("string")
    decoded = F.when(frames.frame_verdict(F.col("value")).isNull(), body)
    raw = F.to_json(
        F.struct(
            F.lit("base64").alias("encoding"),
            frames.base64_text(F.col("value")).alias("value"),
        )
    )
    # The decoded body is JSON text already, so it is spliced in as it is.
    failed = F.coalesce(F.concat(F.lit('{"encoding":"json","value":'), decoded, F.lit("}")), raw)
    payload = F.concat(
        F.lit('{"failed_event":'), failed,
        F.lit(',"service":'), _quoted(service),
        F.lit(',"stage":'), _quoted(F.col("stage")), F.lit("}"),
    )
    return failures.select(
        F.lit("news.dlq.v1").alias("schema_version"),
        stable_id("event", "news.dlq.v1", F.col("source_topic"), F.col("source_partition"),
                  F.col("source_offset"), F.col("error_class"), F.col("error_message"))
        .alias("event_id"),
        iso_micros(now).alias("event_time"),
        "source_topic", "source_partition", "source_offset", "error_class", "error_message",
        payload.alias("payload"),
    )


def _quoted(text: Column) -> Column:
    """JSON string literal of a text."""
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def _variant_is(value: Column, kind: str) -> Column:
    """Variant of the given type? Absent values are not."""
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def read_payload(dlq: DataFrame) -> DataFrame:
    """DLQ rows with the parts of their payload that decisions read.

    The JSON text is parsed once, to a variant; types are kept apart, so a
    numeric source id does not pass for a text.
    """
    parts = settle(dlq, _p=F.try_parse_json("payload")).withColumns(
        {
            "_failed": F.try_variant_get("_p", "$.failed_event", "variant"),
            "_stage": F.try_variant_get("_p", "$.stage", "variant"),
            "_encoding": F.try_variant_get("_p", "$.failed_event.encoding", "variant"),
            "_value": F.try_variant_get("_p", "$.failed_event.value", "variant"),
        }
    )
    is_json = _variant_is(F.col("_encoding"), "STRING") & (
        F.try_variant_get("_encoding", "$", "string") == "json"
    )
    source = F.try_variant_get("_value", "$.source_id", "variant")
    version = F.try_variant_get("_value", "$.schema_version", "variant")
    value_is_object = _variant_is(F.col("_value"), "OBJECT")
    return parts.select(
        *dlq.columns,
        _variant_is(F.col("_failed"), "OBJECT").alias("has_failed_event"),
        is_json.alias("is_json"),
        value_is_object.alias("value_is_object"),
        F.when(_variant_is(version, "STRING"), F.try_variant_get(version, "$", "string"))
        .alias("failed_schema"),
        F.when(value_is_object, F.to_json("_value")).alias("failed_value"),
        F.coalesce(
            F.when(
                is_json & value_is_object & _variant_is(source, "STRING"),
                F.try_variant_get(source, "$", "string"),
            ),
            F.lit("unknown"),
        ).alias("source_id"),
        F.coalesce(
            F.when(
                _variant_is(F.col("_stage"), "STRING"),
                F.nullif(F.try_variant_get("_stage", "$", "string"), F.lit("")),
            ),
            F.lit("unknown"),
        ).alias("stage"),
    )


def replay_verdict(dlq: DataFrame) -> DataFrame:
    """read_payload rows with the topic to replay to and why not, if so."""
    read = read_payload(dlq).withColumn("replay_topic_key", bus.topic_key(F.col("source_topic")))
    expected = bus.schema_version(F.col("replay_topic_key"))
    present = F.from_json("failed_value", "map<string,string>")
    complete = F.forall(
        bus.required_fields(F.col("failed_schema")),
        lambda f: F.try_element_at(present, f).isNotNull(),
    )
    verdict = (
        F.when(F.col("replay_topic_key").isNull(), F.lit("unknown_topic"))
        .when(F.col("replay_topic_key") == "dlq", F.lit("dlq_to_dlq"))
        .when(~F.col("has_failed_event"), F.lit("no_failed_event"))
        .when(~F.col("is_json"), F.lit("not_json_encoded"))
        .when(~F.col("value_is_object"), F.lit("value_not_object"))
        .when(~F.col("failed_schema").eqNullSafe(expected), F.lit("schema_mismatch"))
        .when(~complete, F.lit("invalid_event"))
    )
    return settle(read, verdict=verdict)


def dispose(
    dlq: DataFrame, action: str, operator_id: str, reason: str | None, limit: int | None = None
) -> DataFrame:
    """Disposition rows of an operator action on open DLQ events.

    inspect changes nothing; commit closes events; replay closes those that may
    be replayed. replay and commit need a reason. ``limit`` takes the first
    events in bus order, as an operator working through a backlog does.
    """
    if action not in ("inspect", "commit", "replay"):
        raise ValueError(f"unknown action: {action}")
    if action != "inspect" and not reason:
        raise ValueError("a reason is required for replay or commit")
    taken = dlq if limit is None else take_in_order(dlq, limit)
    judged = replay_verdict(taken)
    closes = F.lit(action == "commit") if action != "replay" else F.col("verdict").isNull()
    return judged.select(
        "event_id", "source_topic", "source_partition", "source_offset", "error_class",
        F.lit(operator_id).alias("operator_id"),
        F.lit(action).alias("disposition_action"),
        F.lit(reason if action != "inspect" else None).cast("string").alias("disposition_reason"),
        closes.alias("committed"),
        F.when(F.lit(action == "replay") & F.col("verdict").isNull(), F.col("replay_topic_key"))
        .alias("replayed_topic_key"),
        F.when(F.lit(action == "replay"), F.col("verdict")).alias("verdict"),
    )


def still_open(dlq: DataFrame, dispositions: DataFrame) -> DataFrame:
    """DLQ events no committed disposition has closed."""
    return dlq.join(dispositions.filter("committed").select("event_id"), "event_id", "left_anti")


def take_in_order(dlq: DataFrame, count: int) -> DataFrame:
    """The first ``count`` DLQ events in bus order (a distributed top-k)."""
    return dlq.orderBy("source_partition", "source_offset", "source_topic").limit(count)
