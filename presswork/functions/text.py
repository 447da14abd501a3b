"""Text normalisation, titles, dates and boilerplate rules as Column code."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions.binding import let, literal_array, literal_map

# Python's str whitespace: Unicode White_Space plus the four separators.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# The runs that change when runs become one space: all but single spaces.
UNEVEN_SPACE = r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"

# Lines that are never article text. Matched case-insensitively
# with Unicode word rules.
BOILERPLATE_PATTERNS = (
    r"^\s*>>\s*",
    r"^\s*(tin liên quan|tin lien quan|xem thêm|xem them|đọc tiếp|doc tiep)\b",
    r"^\s*(theo dõi|bấm theo dõi|mời bạn đọc)\b",
    r"^\s*(nguồn|source)\s*:",
    r"^\s*chia sẻ\s*$",
    r"^\s*google news\s*$",
)
# One leading anchor: a search then gives up at once everywhere but at the start.
BOILERPLATE = "(?iU)^(?:" + "|".join(p.removeprefix("^") for p in BOILERPLATE_PATTERNS) + ")"

MIN_BLOCK_CHARS = 20
CAPTION_CHARS = (5, 500)


def strip(value: Column) -> Column:
    """Python's str.strip: Unicode whitespace on both ends."""
    return F.regexp_replace(value, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def norm_text(value: Column) -> Column:
    """Runs of whitespace become one space, ends trimmed, null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), UNEVEN_SPACE, " "))


#: Texts that a worker holds as Python objects.
TEXTS_AT_ONCE = 64


def html_unescape(value: Column, times: int = 1) -> Column:
    """Python's html.unescape, ``times`` times over.

    Texts without a reference stay where they are, and Python holds few of the others
    at a time: its workers do not grow with the rows of an Arrow batch.
    """

    @F.arrow_udf(T.StringType())
    def resolved(values: pa.Array) -> pa.Array:
        done = [pa.array([], pa.string())]
        for at in range(0, len(values), TEXTS_AT_ONCE):
            texts = values[at : at + TEXTS_AT_ONCE].to_pylist()
            for _ in range(times):
                texts = [t and html.unescape(t) for t in texts]
            done.append(pa.array(texts, pa.string()))
        return pa.concat_arrays(done)

    return F.coalesce(resolved(let(value, lambda v: F.when(v.contains("&"), v))), value)


def norm_html_text(value: Column) -> Column:
    """norm_text after resolving character references."""
    return norm_text(html_unescape(value))


def first_present(*values: Column) -> Column:
    """First non-empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def clean_title(value: Column) -> Column:
    """Headline without the ' - Site' or ' | Site' tail; null when empty."""
    parts = F.split(value, r"(?U)[\s\x1c-\x1f]+[-|][\s\x1c-\x1f]+", 2)
    return F.when(F.length(value) > 0, norm_text(parts[0]))


def is_boilerplate(value: Column) -> Column:
    return value.rlike(BOILERPLATE)


def block_skip(value: Column) -> Column:
    """True when a text block is too short or a boilerplate line."""
    return (F.char_length(value) < MIN_BLOCK_CHARS) | is_boilerplate(value)


def caption_valid(value: Column) -> Column:
    low, high = CAPTION_CHARS
    return F.char_length(value).between(low, high) & ~is_boilerplate(value)


def block_key(value: Column) -> Column:
    """Identity of a block: lower-cased letters, digits and underscores."""
    return F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}_]+", "")


# The zone names of RFC 2822 and the offsets they stand for.
RFC2822_ZONES = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_RFC2822 = (
    r"^\s*(?:[A-Za-z]+\s*,\s*|[A-Za-z]+\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s-]+"
    r"(\d{4}|\d{2})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+([A-Za-z]+|[+-]\d{4}))?\s*$"
)


def rfc2822_datetime(value: Column) -> Column:
    """struct<at timestamp, iso string> of an RFC 2822 date, null when unreadable.

    ``iso`` keeps the writer's offset, because record hashes are built from it;
    a date without a usable zone counts as UTC.
    """

    months = literal_array(MONTHS)
    zones = literal_map(RFC2822_ZONES.items())

    def year(p):
        number = p.try_cast("int")
        return (
            F.when(F.length(p) == 4, number)
            .when(number > 68, number + 1900)
            .otherwise(number + 2000)
        )

    def offset(p):
        zone = F.when(p.rlike("^[+-]"), p).otherwise(F.try_element_at(zones, F.upper(p)))
        return F.regexp_replace(
            F.coalesce(F.nullif(zone, F.lit("-0000")), F.lit("+0000")), r"(\d{2})$", ":$1"
        )

    def iso(p):
        two = lambda i: F.lpad(p[i], 2, "0")
        month = F.lpad(F.array_position(months, F.lower(p[1])).cast("string"), 2, "0")
        seconds = F.when(p[5] == "", F.lit("00")).otherwise(p[5])
        return F.concat(
            F.lpad(year(p[2]).cast("string"), 4, "0"), F.lit("-"), month, F.lit("-"), two(0),
            F.lit("T"), two(3), F.lit(":"), p[4], F.lit(":"), seconds, offset(p[6]),
        )

    # One match yields all seven groups, one per list element.
    groups = F.when(value.rlike(_RFC2822), F.regexp_replace(value, _RFC2822, "$1|$2|$3|$4|$5|$6|$7"))
    return let(
        let(F.split(groups, r"\|"), iso),
        lambda text: F.when(
            text.try_cast("timestamp").isNotNull(),
            F.struct(text.try_cast("timestamp").alias("at"), text.alias("iso")),
        ),
    )


def iso_datetime(value: Column) -> Column:
    """Timestamp of an ISO 8601 date or date-time, also in basic and week form;
    naive values count as UTC."""
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"

    def extended(text):
        """Separators put in, a week date turned into a calendar date."""
        day, rest = F.regexp_extract(text, r"^(\d{4}-?W?\d+(?:-?\d+)?)", 1), r"^\d{4}-?W?\d+(?:-?\d+)?"
        week = F.regexp_extract(day, r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$", 2)
        year = F.regexp_extract(day, r"^(\d{4})", 1)
        weekday = F.regexp_extract(day, r"W\d{2}-?([1-7])$", 1)
        # week 1 holds January 4th
        fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
        monday = F.date_sub(fourth, F.weekday(fourth))
        at = F.date_add(monday, (week.try_cast("int") - 1) * 7
                        + F.coalesce(weekday.try_cast("int"), F.lit(1)) - 1)
        calendar = F.when(F.weekofyear(at) == week.try_cast("int"), at.cast("string"))
        plain = F.regexp_replace(day, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
        time = F.regexp_replace(F.regexp_replace(text, rest, ""), ",", ".")
        time = F.regexp_replace(time, r"^([T ]\d{2})(\d{2})(\d{2})?(?=[.Z+-]|$)", "$1:$2:$3")
        time = F.regexp_replace(time, r":(?=[.Z+-]|$)", "")
        return F.concat(F.when(week != "", calendar).otherwise(plain), time)

    def read(text):
        text = F.regexp_replace(text, r"(:\d{2}|T\d{2})([+-]\d{2})(\d{2})$", "$1$2:$3")
        text = F.regexp_replace(text, r"([T ]\d{2})(?=$|Z|[+-])", "$1:00")
        text = F.regexp_replace(text, r"([T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00")
        return text.try_cast("timestamp")

    return let(
        let(strip(value), extended), lambda text: F.when(text.rlike(shape), read(text))
    )


def first_datetime(values: Column) -> Column:
    """First readable date of an array of candidates, ISO before RFC 2822."""
    read = F.transform(values, lambda v: F.coalesce(iso_datetime(v), rfc2822_datetime(v)["at"]))
    return F.get(F.array_compact(read), F.lit(0))


def article_datetime(*values: Column) -> Column:
    """first_datetime() of several columns."""
    return first_datetime(F.array(*values))


def iso_micros(ts: Column) -> Column:
    """UTC wire text of a timestamp with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_utc(ts: Column) -> Column:
    """UTC text with whole seconds and a +00:00 offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
