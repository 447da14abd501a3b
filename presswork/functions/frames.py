"""Framed event bytes: one zero byte, a big-endian schema id, UTF-8 JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.binding import let

FRAME_BYTES = 5


def frame_schema_id(value: Column) -> Column:
    """Schema id in bytes 1-4 (long), null when there are fewer than five bytes."""
    return F.when(
        F.octet_length(value) >= FRAME_BYTES,
        F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint"),
    )


def frame_body(value: Column) -> Column:
    """Bytes after the frame."""
    return F.substring(value, FRAME_BYTES + 1, 2**31 - 1)


def json_root(text: Column) -> Column:
    """Type name of the JSON root ('OBJECT<...>', 'ARRAY<...>', ...) or null."""
    return F.schema_of_variant(F.try_parse_json(text))


def frame_verdict(value: Column, allowed_ids: Column | None = None) -> Column:
    """First failing check of a frame, null when it decodes.

    ``allowed_ids`` is array<bigint> of known schema ids; null skips that check.
    """
    schema_id = frame_schema_id(value)
    known = F.lit(True) if allowed_ids is None else (
        allowed_ids.isNull() | F.array_contains(allowed_ids, schema_id)
    )
    # The body is cut out, checked and parsed once, and only behind a good frame.
    content = let(
        frame_body(value),
        lambda body: F.when(~F.is_valid_utf8(body), F.lit("not_utf8")).otherwise(
            let(
                json_root(body.cast("string")),
                lambda root: F.when(root.isNull(), F.lit("not_json"))
                .when(~root.startswith("OBJECT"), F.lit("not_an_object")),
            )
        ),
    )
    return (
        F.when(value.isNull(), F.lit("empty_payload"))
        .when(
            (F.octet_length(value) < FRAME_BYTES) | (F.hex(F.substring(value, 1, 1)) != "00"),
            F.lit("bad_framing"),
        )
        .when(schema_id <= 0, F.lit("bad_schema_id"))
        .when(~known, F.lit("unexpected_schema_id"))
        .otherwise(content)
    )


def frame(schema_id: Column, body: Column) -> Column:
    """Bytes of a framed event from an id and its JSON text."""
    return F.concat(
        F.unhex(F.lit("00")),
        F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")),
        F.encode(body, "UTF-8"),
    )


def canonical_json(**fields: Column) -> Column:
    """Compact JSON text with sorted keys and nulls kept."""
    return F.to_json(
        F.struct(*[fields[name].alias(name) for name in sorted(fields)]),
        {"ignoreNullFields": "false"},
    )


def wire_bytes(json_text: Column) -> Column:
    """Size of a JSON event on the wire, frame included."""
    return F.octet_length(json_text) + F.lit(FRAME_BYTES)


def base64_text(value: Column) -> Column:
    """Base64 on one line; null bytes count as empty."""
    bare = F.base64(F.coalesce(value, F.encode(F.lit(""), "UTF-8")))
    return F.replace(bare, F.lit("\r\n"), F.lit(""))
