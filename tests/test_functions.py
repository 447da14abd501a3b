"""Golden cases of the scalar functions."""

from __future__ import annotations

import html
import re
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presswork.functions import dims, errors, frames, ids, text, urls
from presswork.functions.summary import summary_text
from presswork.operators.screening import (
    document_verdict,
    ipv4_number,
    is_global_address,
    screen_urls,
    size_verdict,
)

QUICK = settings(max_examples=8, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])


def apply(spark, values, function, schema="v string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in frame.select("i", function(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


@QUICK
@given(st.lists(st.text(alphabet=" ab\t\n\x0b\x1c\x1f\x85\xa0 é", max_size=12), min_size=1, max_size=30))
def test_norm_text_equals_python(spark, values):
    want = [re.sub(r"\s+", " ", v).strip() for v in values]
    assert apply(spark, values, text.norm_text) == want


def test_html_text_and_summary(spark):
    assert apply(spark, ["a &amp;amp; b", None], text.norm_html_text) == ["a &amp; b", ""]
    raw = '<a href="x"><img src="a.jpg"></a></br>\n Short <b>te</b>xt.<li>next&nbsp;one'
    assert apply(spark, [raw, "", None, "<br>", "plain"], summary_text) == [
        "Short text. next one", None, None, None, "plain"]


def test_clean_title(spark):
    values = ["Head - Site", "Head | Site - X", "Semi-final", "  ", "", None, "A - B"]
    assert apply(spark, values, text.clean_title) == [
        "Head", "Head", "Semi-final", "", None, None, "A"]


def test_boilerplate_is_unicode_and_case_blind(spark):
    values = ["XEM THÊM tin", "xem themes", ">> x", "NGUỒN: báo", "Chia sẻ", "chia sẻ tin", "a >> b"]
    assert apply(spark, values, text.is_boilerplate) == [True, False, True, True, True, False, False]


def test_block_and_caption_limits(spark):
    assert apply(spark, ["x" * 19, "x" * 20], text.block_skip) == [True, False]
    assert apply(spark, ["x" * 4, "x" * 5, "é" * 500, "x" * 501], text.caption_valid) == [
        False, True, True, False]
    assert apply(spark, ["Đây là: _Tin 1!"], text.block_key) == ["đâylà_tin1"]


RFC_DATES = [
    "Mon, 01 Jun 2026 05:00:00 +0700", "1 Jun 2026 05:00 GMT", "Mon, 1 Jun 26 05:00:00 EST",
    "01 Jun 2026 05:00:00 -0000", "Mon, 01 Jun 2026 05:00:00 -0330",
]


def test_rfc2822_dates(spark):
    got = apply(spark, RFC_DATES, lambda v: F.unix_timestamp(text.rfc2822_datetime(v)["at"]))
    want = []
    for value in RFC_DATES:
        at = parsedate_to_datetime(value)
        from datetime import UTC

        want.append(int((at if at.tzinfo else at.replace(tzinfo=UTC)).timestamp()))
    assert got == want
    assert apply(spark, RFC_DATES[:1], lambda v: text.rfc2822_datetime(v)["iso"]) == [
        "2026-06-01T05:00:00+07:00"]
    assert apply(spark, ["soon", "", None, "32 Jun 2026 05:00:00 GMT", "1 Abc 2026 05:00:00 GMT"],
                 text.rfc2822_datetime) == [None] * 5


def test_article_dates(spark):
    values = ["2026-06-01T08:00:00+07:00", "2026-06-01T08:00:00Z", "2026-06-01", "2026-06-01 08:00",
              "2026", "2026-13-01", "Mon, 01 Jun 2026 05:00:00 +0700", "x", "2026-06-01T08:00:00.5+0700"]
    got = apply(spark, values, lambda v: text.iso_micros(text.article_datetime(v)))
    assert got == [
        "2026-06-01T01:00:00.000000Z", "2026-06-01T08:00:00.000000Z", "2026-06-01T00:00:00.000000Z",
        "2026-06-01T08:00:00.000000Z", None, None, "2026-05-31T22:00:00.000000Z", None,
        "2026-06-01T01:00:00.500000Z"]


def test_norm_url(spark):
    values = ["HTTPS://News.Test/A?utm_source=x&b=2&UTM_y=1&a=1#top", "https://n.test/?utm_a=1",
              "https://u@N.test:8080/p", "not a url"]
    assert apply(spark, values, urls.norm_url) == [
        "https://news.test/A?b=2&a=1", "https://n.test/", "https://u@n.test:8080/p", "not a url"]


def test_url_verdict(spark):
    values = ["https://example.test/a", "https://www.example.test./", "http://example.test/", "https:///x",
              "https://badexample.test/", "https://example.test.evil/", "https://bücher.example.test/"]
    domains = F.array(F.lit("example.test"), F.lit("xn--bcher-kva.test"))
    values.append("https://www.BÜCHER.test/")
    frame = spark.createDataFrame(list(enumerate(values)), "i int, url string")
    rows = screen_urls(frame, "url", domains).orderBy("i").collect()
    assert [r.verdict for r in rows] == [
        None, None, "not_https", "no_host", "outside_domain", "outside_domain", None, None]
    assert rows[-1].host == "www.xn--bcher-kva.test"


@pytest.mark.parametrize("base", ["https://n.test/a/b.html", "https://n.test", "http://n.test/a/b/?q=2#f", "/x", ""])
def test_resolve_url(spark, base):
    names = ["/x", "y.html", "../z", "?q=1", "//cdn.test/a", "mailto:a@b", "", "./", "../../../up", "a/./b/../c?x#y",
             "#top", "..", "http://o.test/../p", " z\n", "/a/../b/."]
    want = [urljoin(base, c.strip().replace("\n", "")) for c in names]
    got = apply(spark, names, lambda v: urls.resolve_url(F.lit(base), v))
    assert got == [w if w.startswith("http") and "//" in w else None for w in want]
    assert apply(spark, ["https://[::1/x", None], lambda v: urls.resolve_url(F.lit("https://n.test/a"), v)) == [
        None, "https://n.test/a"]


def test_first_usable(spark):
    frame = spark.createDataFrame([(1, [["data:x", " ", "/i.jpg", "j"], [None, "mailto:a"], []]), (2, None)],
                                  "i int, found array<array<string>>")
    rows = frame.orderBy("i").select(urls.resolve_first_usable(F.lit("https://n.test/a/"), F.col("found")).alias("r"))
    assert [r.r for r in rows.collect()] == [["https://n.test/i.jpg", None, None], None]


def test_srcset(spark):
    assert apply(spark, ["a.jpg 1x, b.jpg 2x", " a.jpg", ", b", ""], urls.srcset_first) == [
        "a.jpg", "a.jpg", "", ""]


def test_stable_ids_keep_places(spark):
    frame = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    got = [r[0] for r in frame.select(ids.stable_id("t", F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert got[0] != got[1] and all(re.fullmatch(r"t_[0-9a-f]{32}", g) for g in got)


def test_frame_verdicts(spark):
    head = b"\x00\x00\x00\x00\x02"
    values = [None, b"\x00\x00", b"\x01\x00\x00\x00\x02{}", b"\x00\x00\x00\x00\x00{}", b"\x00\x00\x00\x00\x03{}",
              head + b"\xff", head + b"nope", head + b"[1]", head + b'{"a":1}', b"\x00\xff\xff\xff\xff{}"]
    allowed = F.array(F.lit(2).cast("bigint"), F.lit(1).cast("bigint"))
    got = apply(spark, [bytearray(v) if v is not None else None for v in values],
                lambda v: frames.frame_verdict(v, allowed), "v binary")
    assert got == ["empty_payload", "bad_framing", "bad_framing", "bad_schema_id", "unexpected_schema_id",
                   "not_utf8", "not_json", "not_an_object", None, "unexpected_schema_id"]
    assert apply(spark, [bytearray(b"not-json")], frames.base64_text, "v binary") == ["bm90LWpzb24="]


def test_canonical_json_keeps_nulls_and_sorts(spark):
    got = apply(spark, ["é\""], lambda v: frames.canonical_json(b=v, a=F.lit(None).cast("string")))
    assert got == ['{"a":null,"b":"é\\""}']


def test_status_classes(spark):
    blocked = F.array(F.lit(428), F.lit(503))
    codes = [200, 204, 304, 301, 404, 408, 425, 428, 429, 500, 503]
    assert apply(spark, codes, lambda v: errors.status_class(v, blocked), "v int") == [
        "ok", "ok", "permanent", "redirect", "permanent", "retryable", "retryable", "blocked",
        "retryable", "retryable", "blocked"]
    assert apply(spark, [304, 503], lambda v: errors.status_class(v, feed=True), "v int") == [
        "not_modified", "retryable"]


def test_retry_delays(spark):
    assert apply(spark, [1, 2, 3], lambda v: errors.consumer_retry_delay(v, 2, 5), "v int") == [2, 4, 5]
    assert apply(spark, [1, 2], lambda v: errors.http_retry_delay(v, 1), "v int") == [1, 2]


def test_error_struct(spark):
    frame = spark.createDataFrame(
        [("feed_fetch", None, 503, False), ("feed_fetch", False, 404, False), ("feed_parse", None, None, False),
         ("feed_fetch", True, 1, True)],
        "stage string, own boolean, code int, stray boolean")
    rows = frame.select(errors.error_struct(
        F.col("stage"), F.lit("E"), F.lit("m"), F.col("own"), F.col("code"), F.col("stray")).alias("e")
    ).select("e.*").collect()
    assert [(r.stage, r.retryable, r.status_code) for r in rows] == [
        ("feed_fetch", True, 503), ("feed_fetch", False, 404), ("feed_parse", False, None),
        ("unexpected", False, None)]


def test_addresses(spark):
    values = ["8.8.8.8", "10.0.0.1", "172.31.255.255", "172.32.0.1", "192.0.0.9", "100.64.0.1", "256.1.1.1",
              "1.2.3", "::1", "2606:4700::1111", "224.0.0.1"]
    assert apply(spark, values, lambda v: is_global_address(v, ipv6=True)) == [
        True, False, False, True, True, False, False, False, False, True, True]
    assert apply(spark, ["1.2.3.4", "01.2.3.4.", "a"], ipv4_number) == [16909060, None, None]


def test_documents(spark):
    page = bytearray(b"<html><TITLE>Just a moment...</title>")
    fine = bytearray(b"<html><title>News</title> custom-marker")
    frame = spark.createDataFrame(
        [(1, "text/html; charset=x", page), (2, "application/json", fine), (3, None, fine), (4, "", fine)],
        "i int, t string, p binary")
    extra = F.when(F.col("i") == 3, F.array(F.lit(" "), F.lit("Custom-Marker")))
    got = [r[0] for r in frame.orderBy("i").select(document_verdict(F.col("t"), F.col("p"), extra)).collect()]
    assert got == ["marker: <title>just a moment", "not_html: application/json", "marker: Custom-Marker", None]


def test_unescape_keeps_plain_texts_out_of_python(spark):
    """Twice over in one pass, for more texts than a worker holds; texts without a reference stay in the JVM."""
    values = [v for n in range(90) for v in (None, "", f"plain {n}", f"R&amp;amp;D &#x{n + 33:x} &notit; &amp;lt {n}")]
    want = [v and html.unescape(html.unescape(v)) for v in values]
    assert apply(spark, values, lambda v: text.html_unescape(v, times=2)) == want
    plan = spark.createDataFrame([("a",)], "v string").select(text.html_unescape(F.col("v"), times=2))
    python = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "ArrowEvalPython" in line]
    assert len(python) == 1 and "Contains(" in plan._jdf.queryExecution().executedPlan().toString()


def test_markers_keep_their_blanks(spark):
    """A blank at a marker's end is part of it: 'Is ' is not the start of 'Island'."""
    pages = [bytearray(b"<h1>Island news</h1>"), bytearray(b"<H1>Is it so</H1>"), bytearray(b"nothing")]
    extra = F.array(F.lit(" "), F.lit("<h1>Is "))
    got = apply(spark, pages, lambda p: document_verdict(F.lit("text/html"), p, extra), "v binary")
    assert got == [None, "marker: <h1>Is ", None]


def test_sizes(spark):
    frame = spark.createDataFrame(
        [(1, "11", b"x"), (2, "soon", b"x" * 11), (3, None, b""), (4, "10", b"x" * 10)], "i int, d string, p binary")
    got = [r[0] for r in frame.orderBy("i").select(size_verdict(F.col("d"), F.col("p"), 10)).collect()]
    assert got == ["declared_too_large", "too_large", "empty", None]


def test_dimension_names_and_overrides(spark):
    assert apply(spark, ["source_id", "error_CLASS_x", " a ", "x__y"], dims.clean_dimension_name) == [
        "sourceId", "errorClassX", "a", "xY"]
    frame = spark.createDataFrame([({"service": "b", "a_b": "1", "a_B": "2", "n": None},)], "m map<string,string>")
    merged = dims.override(F.create_map(F.lit("service"), F.lit("a")), F.col("m"))
    got = frame.select(dims.entries_json(dims.clean_dimensions(merged))).collect()[0][0]
    assert got in ('{"aB":"2","service":"b"}', '{"aB":"1","service":"b"}')


def test_unescape_helper_matches_stdlib(spark):
    values = ["&lt;b&gt;", "caf&eacute;", "&#39;x&#39;", "a & b"]
    assert apply(spark, values, text.html_unescape) == [html.unescape(v) for v in values]


def test_iso_basic_and_week_forms(spark):
    from datetime import datetime, timezone

    values = ["20260531T220000Z", "20260531", "2026-W22-7", "2026W22", "2026-05-31T22:00:00,25", "2026-05-31T2200+0200",
              "20260531 2200", "2020-W01-1", "2026-02-30", "2026-W60-1", "x"]

    def want(v):
        try:
            at = datetime.fromisoformat(v)
        except ValueError:
            return None
        return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")

    got = apply(spark, values, lambda v: F.date_format(text.iso_datetime(v), "yyyy-MM-dd HH:mm:ss"))
    assert got == [want(v) for v in values[:8]] + [None, None, None]
