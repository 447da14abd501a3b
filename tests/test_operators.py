"""Golden cases of the table operators."""

from __future__ import annotations

import hashlib
import json
import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presswork.operators import bus, dlq, feeds, fetching, lookup, metrics
from presswork.operators.ordering import first_per_key, number_rows
from presswork.operators.screening import address_screen, enrich_source, select_feeds
from presswork.plans import article_flow
from presswork.sources import landing, rss
from presswork.sources.state import read_deltas, upsert, write_version

QUICK = settings(max_examples=6, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])
ITEM = "source_id string, feed_id string, pos bigint, link string, title string, summary string, published_iso string"


def items(spark, *rows):
    return spark.createDataFrame(
        [(s, f, i, link, title, "", "") for i, (s, f, link, title) in enumerate(rows)], ITEM)


def hashed(spark, *rows):
    return feeds.with_hashes(feeds.dedupe_items(feeds.classify_items(items(spark, *rows))))


# --- feeds -------------------------------------------------------------------

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><link>https://paper.test/</link>
<item><link>https://paper.test/river.html</link><title>River falls</title>
<pubDate>Tue, 09 Jan 2024 18:30:00 -0200</pubDate>
<description>&lt;p&gt;Lowest &lt;b&gt;level&lt;/b&gt; in years.&lt;/p&gt;</description></item>
<item><title>Nowhere to go</title></item>{more}</channel></rss>"""


def test_rss(spark):
    again = '<item><title>Once more</title><link>https://paper.test/river.html?utm_medium=x#end</link></item>'
    payloads = spark.createDataFrame(
        [(1, RSS.format(more="")), (2, RSS.format(more=again)), (3, "<html><p>Please wait</p></html>"),
         (4, "<rss><channel></channel></rss>"), (5, "<rss><item/></rss>"), (6, "not xml"),
         (7, RSS.format(more="").replace("rss", "feed"))], "feed_id int, payload string")
    parsed = rss.parse_feeds(payloads)
    got = {r.feed_id: (r.verdict, r.parsed, r.skipped, r.duplicates) for r in parsed.collect()}
    assert got == {1: (None, 1, 1, 0), 2: (None, 1, 1, 1), 3: ("not_rss", 0, 0, 0),
                   4: ("no_valid_items", 0, 0, 0), 5: ("not_rss", 0, 0, 0), 6: ("not_rss", 0, 0, 0),
                   7: ("not_rss", 0, 0, 0)}
    row = rss.feed_item_rows(parsed).filter("feed_id = 1").collect()[0]
    assert (row.article_url, row.title, row.summary) == ("https://paper.test/river.html", "River falls", "Lowest level in years.")
    assert str(row.published_at) == "2024-01-09 20:30:00"
    assert row.published_iso == "2024-01-09T18:30:00-02:00"


def test_semantic_hash_is_blind_to_order(spark):
    rows = [("s", "f", f"https://n.test/{i}", "t") for i in range(6)] + [("s", "g", "https://n.test/1", "t")]
    table = hashed(spark, *rows)
    of = lambda frame: {r.feed_id: r.content_hash for r in feeds.semantic_hash(frame).collect()}
    first = of(table)
    assert of(hashed(spark, *reversed(rows))) == first and len(set(first.values())) == 2
    own = [(r.feed_item_id, r.record_hash) for r in table.filter("feed_id = 'f'").collect()]
    digests = [hashlib.sha256(f"{i}:{h}".encode()).hexdigest() for i, h in own]
    sums = [sum(int(d[k : k + 16], 16) for d in digests) for k in (0, 16, 32, 48)]
    assert first["f"] == hashlib.sha256(":".join(map(str, [6, *sums])).encode()).hexdigest()
    rows[2] = ("s", "f", "https://n.test/2", "other title")
    changed = of(hashed(spark, *rows))
    assert changed["f"] != first["f"] and changed["g"] == first["g"]


def test_same_item_in_two_feeds(spark):
    table = hashed(spark, ("s", "f", "https://n.test/1", "t"), ("s", "g", "https://n.test/1", "t"))
    ready = table.withColumn("run_id", F.lit("r")).withColumn("observed_at", F.lit("2026-01-01").cast("timestamp"))
    assert table.select("feed_item_id").distinct().count() == 2
    assert feeds.fetch_requests(ready).select("event_id").distinct().count() == 1


@QUICK
@given(
    st.dictionaries(st.integers(0, 12), st.integers(0, 1), max_size=10),
    st.dictionaries(st.integers(0, 12), st.integers(0, 1), min_size=1, max_size=10),
    st.integers(1, 12),
)
def test_diff_and_retention_equal_a_dict_model(spark, before, now, keep):
    ids = {n: hashlib.sha256(f"id{n}".encode()).hexdigest() for n in range(13)}
    schema = "source_id string, feed_id string, feed_item_id string, record_hash string"
    old = spark.createDataFrame([("s", "f", ids[n], str(h)) for n, h in before.items()], schema)
    cur = spark.createDataFrame(
        [("s", "f", ids[n], str(h), i) for i, (n, h) in enumerate(now.items())], schema + ", pos bigint")
    changed = {r.feed_item_id for r in feeds.diff_items(cur, old).collect()}
    assert changed == {ids[n] for n, h in now.items() if before.get(n) != h}
    # The saved state has sorted keys; new keys follow in document order.
    model = {k: str(before[n]) for k, n in sorted((ids[n], n) for n in before)}
    model.update({ids[n]: str(h) for n, h in now.items()})
    want = dict(list(model.items())[-keep:])
    kept = feeds.retain_items(feeds.merge_items(old, cur), keep).collect()
    assert {r.feed_item_id: r.record_hash for r in kept} == want


def test_feed_status(spark):
    feed = "source_id string, feed_id string"
    responses = spark.createDataFrame([("s", f, c) for f, c in zip("abcdef", (304, 304, 200, 200, 200, 200))],
                                      feed + ", status_code int")
    counts = spark.createDataFrame([("s", f, 2, 1, 0) for f in "cdf"],
                                   feed + ", parsed long, skipped long, duplicates long")
    hashes = spark.createDataFrame([("s", f, "h", 2) for f in "cdf"], feed + ", content_hash string, items long")
    changed = spark.createDataFrame([("s", "d")], feed)
    checkpoints = spark.createDataFrame(
        [("s", "a", "x", True), ("s", "b", "x", False), ("s", "c", "h", True), ("s", "d", "h", False)],
        feed + ", content_hash string, events_published boolean")
    rejected = spark.createDataFrame([("s", "f", 1)], feed + ", off_domain long")
    rows = feeds.feed_status(responses, counts, hashes, changed, checkpoints, rejected).collect()
    assert {r.feed_id: (r.status, r.discovered, r.skipped) for r in rows} == {
        "a": ("not_modified", 0, 0), "b": ("unbacked_304", 0, 0), "c": ("unchanged", 0, 1),
        "d": ("published", 1, 1), "e": ("no_valid_items", 0, 0), "f": ("rejected", 0, 0)}


def test_unpublished_content_keeps_its_time(spark):
    feed = "source_id string, feed_id string, content_hash string"
    hashes = spark.createDataFrame([("s", "a", "h"), ("s", "b", "h")], feed)
    before = spark.createDataFrame([("s", "a", "h", "2026-01-01"), ("s", "b", "x", "2026-01-01")],
                                   feed + ", at string").withColumn("observed_at", F.col("at").cast("timestamp"))
    rows = feeds.observed_at(hashes, before, F.lit("2026-02-02").cast("timestamp")).collect()
    assert {r.feed_id: str(r.observed_at)[:10] for r in rows} == {"a": "2026-01-01", "b": "2026-02-02"}


def test_run_rollup(spark):
    polls = spark.createDataFrame(
        [("one_bad", False, False, False), ("one_bad", True, False, False), ("all_bad", True, False, False),
         ("fatal", True, True, False), ("fatal", False, False, False), ("stray", True, False, True),
         ("stray", False, False, False)],
        "source_id string, failed boolean, retryable boolean, untyped boolean")
    rows = {r.source_id: (r.outcome, r.fatal) for r in feeds.run_rollup(polls).collect()}
    assert rows == {"one_bad": ("success", 0), "all_bad": ("failed", 0), "fatal": ("failed", 1),
                    "stray": ("failed", 1)}


# --- ordering ------------------------------------------------------------------


@QUICK
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60))
def test_bucketed_numbers_equal_plain_row_numbers(spark, rows):
    table = spark.createDataFrame([(g, b, o, i) for i, (g, b, o) in enumerate(rows)], "g int, b int, o int, i int")
    got = {r.i: r.n for r in number_rows(table, ["g"], ["b"], ["o", "i"], "n").collect()}
    seen, want = Counter(), {}
    for g, b, o, i in sorted((g, b, o, i) for i, (g, b, o) in enumerate(rows)):
        seen[g] += 1
        want[i] = seen[g]
    assert got == want


def test_first_per_key_limits_before_the_shuffle(spark):
    table = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    chosen = first_per_key(table, ["k"], ["id"])
    assert sorted(r.id for r in chosen.collect()) == [0, 1, 2]
    assert "WindowGroupLimit" in chosen._jdf.queryExecution().executedPlan().toString()


# --- metrics ---------------------------------------------------------------------

RECORD = ("at string, topic_key string, source_id string, stage string, error_class string, service string, "
          "metric_name string, metric_value double, metric_unit string, dimensions map<string,string>")


def records(spark, *rows):
    table = spark.createDataFrame(rows, RECORD)
    return table.withColumn("window", metrics.flush_window(F.col("at").cast("timestamp")))


def test_points(spark):
    day = "2026-06-11 01:00:00"
    table = records(
        spark,
        (day, "article_fetched", "s", None, None, None, None, None, None, None),
        (day, "article_extracted", "s", None, None, None, None, None, None, None),
        (day, "pipeline_metric", None, None, None, "fetcher", "article_fetch_retry_count", 2.0, "count",
         {"source_id": "s", "error_class": "ReadTimeout"}),
        (day, "pipeline_metric", None, None, None, "fetcher", "unheard_of", 9.0, "count", {}),
        *[(day, "dlq", "d", "article_extract", " Bad ", None, None, None, None, None)] * 3,
        *[(day, "dlq", "s", "article_extract", "Bad", None, None, None, None, None)] * 3,
        *[(day, "dlq", "few", "article_extract", "Bad", None, None, None, None, None)] * 2,
        *[(day, "dlq", "unknown", "article_extract", "Bad", None, None, None, None, None)] * 5,
    )
    points = {(r.name, r.dimensions): r.value for r in metrics.metric_points(table).collect()}
    assert points[("ArticleFetchSuccessCount", '{"sourceId":"s"}')] == 1
    assert points[("ArticleExtractionSuccessCount", '{"sourceId":"s"}')] == 1
    assert points[("ArticleFetchRetryCount",
                   '{"errorClass":"ReadTimeout","service":"fetcher","sourceId":"s"}')] == 2
    both = '{"errorClass":"Bad","sourceId":"d","stage":"article_extract"}'
    assert points[("ArticleRejectedCount", both)] == points[("DlqEventCount", both)] == 3
    assert [k[1] for k in points if k[0] == "SourceExtractionFailure"] == ['{"sourceId":"d"}']


def test_lag(spark):
    committed = spark.createDataFrame(
        [("g", "t", 0, 5), ("g", "t", 1, -1), ("g", "t", 2, 9), ("g", "gone", 0, 1), ("h", "t", 1, -1)],
        "group_id string, topic string, partition int, committed bigint")
    latest = spark.createDataFrame([("t", 0, 8), ("t", 1, 4), ("t", 2, 7)], "topic string, partition int, latest bigint")
    lag = metrics.consumer_lag(committed, latest)
    assert {(r.group_id, r.partition): r.lag for r in lag.collect()} == {("g", 0): 3, ("g", 2): 0}
    assert {r.group_id: r.total_lag for r in metrics.lag_totals(committed, lag).collect()} == {"g": 3, "h": 0}


# --- bus, dead letters, lookups -------------------------------------------------------


def test_replay_rules(spark):
    fetched = {k: "x" for k in bus.REQUIRED_FIELDS["article.fetched.v2"]} | {"schema_version": "article.fetched.v2"}
    short = {k: v for k, v in fetched.items() if k != "content_hash"}
    wrap = lambda value, enc="json": json.dumps({"stage": "s", "failed_event": {"encoding": enc, "value": value}})
    cases = [
        ("news.article_fetched", wrap(fetched), None), ("news.dlq", wrap(fetched), "dlq_to_dlq"),
        ("news.article_fetched", '{"failed_event":1}', "no_failed_event"),
        ("news.article_fetched", wrap("bm90", "base64"), "not_json_encoded"),
        ("news.article_fetched", wrap([1]), "value_not_object"),
        ("news.article_extracted", wrap(fetched), "schema_mismatch"),
        ("news.article_fetched", wrap(short), "invalid_event"), ("other", wrap(fetched), "unknown_topic"),
    ]
    table = spark.createDataFrame(
        [(str(i), t, 0, i, "E", p) for i, (t, p, _) in enumerate(cases)],
        "event_id string, source_topic string, source_partition int, source_offset bigint, error_class string, payload string")
    got = {r.event_id: r.verdict for r in dlq.replay_verdict(table).collect()}
    assert got == {str(i): want for i, (_, _, want) in enumerate(cases)}
    with pytest.raises(ValueError, match="reason"):
        dlq.dispose(table, "replay", "me", None)
    done = dlq.dispose(table, "replay", "me", "fixed", limit=3)
    assert [r.event_id for r in done.filter("committed").collect()] == ["0"]
    assert dlq.still_open(table, done).count() == len(cases) - 1
    assert dlq.dispose(table, "inspect", "me", None).filter("committed").count() == 0


def test_sources_and_feeds(spark):
    feed = "array<struct<feed_id:string,category:string,url:string>>"
    sources = spark.createDataFrame(
        [("on", True, [("f", "c", "u")]), ("off", False, [])], f"source_id string, enabled boolean, feeds {feed}")
    events = spark.createDataFrame([("on",), ("off",), ("none",)], "source_id string")
    got = {r.source_id: r.source_verdict for r in enrich_source(events, sources).collect()}
    assert got == {"on": None, "off": "disabled source: off", "none": "unknown source: none"}
    wanted = spark.createDataFrame([("on", "f"), ("on", "g")], "source_id string, feed_id string")
    assert {r.feed_id: r.verdict for r in select_feeds(wanted, sources).collect()} == {
        "f": None, "g": "unknown feed of on: g"}


def test_address_screen(spark):
    table = spark.createDataFrame(
        [("ok", "8.8.8.8"), ("bad", "8.8.8.8"), ("bad", "10.0.0.1"), ("bad", "10.0.0.1"), ("none", None)],
        "host string, address string")
    got = {r.host: (r.verdict, r.retryable, r.blocked) for r in address_screen(table).collect()}
    assert got == {"ok": (None, False, []), "bad": ("non_public", False, ["10.0.0.1"]),
                   "none": ("no_addresses", True, [])}


def test_redirects(spark):
    site = "https://a.test"
    edges = [(f"{site}/1", "/2"), (f"{site}/2", "https://b.test/x"), (f"{site}/evil", "https://c.test/"),
             (f"{site}/lost", None)] + [(f"{site}/l{i}", f"/l{i + 1}") for i in range(7)]
    starts = [f"{site}/1", f"{site}/evil", f"{site}/lost", f"{site}/l0", f"{site}/l1", f"{site}/l2",
              f"{site}/plain", "https://b.test/x"]
    table = spark.createDataFrame([(u, ["a.test"], ["b.test"]) for u in starts],
                                  "url string, domains array<string>, redirect_domains array<string>")
    hops = fetching.redirect_edges(spark.createDataFrame(edges, "url string, location string"))
    got = {r.url: (r.final_url, r.hops, r.verdict, r.retryable)
           for r in fetching.follow_redirects(table, hops).collect()}
    assert got[f"{site}/1"] == ("https://b.test/x", 2, None, False)
    assert got[f"{site}/evil"] == (f"{site}/evil", 0, "outside_domain", False)
    assert got[f"{site}/lost"] == (f"{site}/lost", 0, "malformed_redirect", True)
    assert got[f"{site}/l0"] == (f"{site}/l5", 5, "redirect_limit", False)
    assert got[f"{site}/l1"] == (f"{site}/l6", 5, "redirect_limit", False)
    assert got[f"{site}/l2"] == (f"{site}/l7", 5, None, False)
    assert got[f"{site}/plain"] == (f"{site}/plain", 0, None, False)
    assert got["https://b.test/x"][2] == "outside_domain"


def test_redirects_match_plain_walks(spark):
    """Chains, cycles, dead ends and foreign targets, followed one hop at a time."""
    rnd = random.Random(6)
    urls = [f"https://{h}.test/{i}" for i in range(40) for h in ("a", "b")] + ["http://a.test/plain", "https:///x"]
    known = urls[:-1]
    table = {u: rnd.choice([*known, *known, None, "", "https://c.test/"]) for u in urls if rnd.random() < 0.8}
    allowed = {"a": (["a.test"], ["b.test"]), "b": (["b.test"], []), "ab": (["a.test", "b.test"], ["c.test"])}
    verdict = lambda u, own: next((v for bad, v in (
        (not u.startswith("https:"), "not_https"), ("https:///" in u, "no_host"),
        (not any(f"//{d}/" in u for d in own), "outside_domain")) if bad), None)

    def walk(url, name, limit):
        own, more = allowed[name]
        at, hops, found = url, 0, verdict(url, own)
        while found is None and at in table:
            target = table[at]
            found = "redirect_limit" if hops == limit else "malformed_redirect" if not target else verdict(target, own + more)
            if found is None:
                at, hops = target, hops + 1
        return at, hops, found

    edges = spark.createDataFrame(list(table.items()), "url string, location string")
    starts = spark.createDataFrame(
        [(u, n, *allowed[n]) for u in urls for n in allowed],
        "url string, name string, domains array<string>, redirect_domains array<string>")
    for limit in (0, 1, 5, 8):
        got = {(r.url, r.name): (r.final_url, r.hops, r.verdict)
               for r in fetching.follow_redirects(starts, fetching.redirect_edges(edges), limit).collect()}
        assert got == {(u, n): walk(u, n, limit) for u in urls for n in allowed}


def test_lookup(spark):
    table = spark.createDataFrame(
        [("a", "fetched", 1, 0, 0), ("a", "extracted", 2, 0, 1), ("a", "fetched", 3, 0, 2), ("a", "fetched", 3, 0, 3)],
        "article_id string, stage string, ts int, partition int, offset bigint")
    got = {r.stage: r.offset for r in lookup.latest_per_stage(table).collect()}
    assert got == {"fetched": 2, "extracted": 1}
    one, two = (spark.range(1).select(lookup.lookup_id(None, u).alias("x")).collect()[0].x
                for u in ("https://N.test/a?utm_source=x", "https://n.test/a"))
    assert one == two
    with pytest.raises(ValueError):
        lookup.lookup_id(None, None)


# --- landing, state, size split --------------------------------------------------------


def test_write_if_absent(spark, tmp_path):
    folder = str(tmp_path / "landing")
    row = "payload_uri string, content_hash string, source_id string, ingest_date string, payload binary"
    first = spark.createDataFrame([("u1", "h", "s", "2026-01-01", b"1"), ("u1", "h", "s", "2026-01-01", b"1")], row)
    more = spark.createDataFrame([("u1", "h", "s", "2026-01-01", b"1"), ("u2", "h", "s", "2026-01-02", b"2")], row)
    landing.write_if_absent(first, folder)
    landing.write_if_absent(more, folder)
    landing.write_if_absent(more, folder, days=["2026-01-01", "2026-01-02"])
    stored = spark.read.parquet(folder)
    assert sorted(r.payload_uri for r in stored.collect()) == ["u1", "u2"]
    asked = spark.createDataFrame(
        [("u1", hashlib.sha256(b"1").hexdigest()), ("u2", "00"), ("u3", "00")], "payload_uri string, content_hash string")
    got = {r.payload_uri: r.verdict for r in landing.read_verified(asked, stored).collect()}
    assert got == {"u1": None, "u2": "hash_mismatch", "u3": "missing_payload"}


def test_state_tables(spark, tmp_path):
    root = str(tmp_path / "state")
    one, two = (spark.createDataFrame([(k, v)], "k string, v int") for k, v in (("a", 1), ("b", 2)))
    assert read_deltas(spark, root, 0, "k string, v int").count() == 0
    write_version(one, root, 0)
    write_version(two, root, 1)
    write_version(two, root, 1)
    assert [r.k for r in read_deltas(spark, root, 1, "k string, v int").collect()] == ["a"]
    assert read_deltas(spark, root, 2, "k string, v int").count() == 2
    merged = upsert(one.unionByName(two), spark.createDataFrame([("a", 9)], "k string, v int"), ["k"], [F.desc("v")])
    assert {r.k: r.v for r in merged.collect()} == {"a": 9, "b": 2}


def test_oversize_split(spark):
    block = "array<struct<type:string,text:string,ordinal:int>>"
    image = "array<struct<url:string,alt:string,caption:string,ordinal:int>>"
    texts = [f"Paragraph number {i} with some more words in it." for i in range(20)]
    rows = [("a", "\n\n".join(texts), [("paragraph", t, i) for i, t in enumerate(texts)]),
            ("b", texts[0], [("paragraph", texts[0], 0)])]
    table = spark.createDataFrame(rows, f"article_id string, body_text string, content_blocks {block}").select(
        "*", *[F.lit("x").alias(c) for c in (
            "run_id", "source_id", "ingest_date", "requested_url", "canonical_url", "title", "summary", "author",
            "source_document_id", "payload_uri", "extractor_version")],
        F.array().cast(image).alias("images"), F.lit(None).cast("timestamp").alias("published_at"))
    events = article_flow.extracted_events(table, F.lit("2026-06-01").cast("timestamp"))
    split = article_flow.split_oversize(events, 1300)
    got = {r.article_id: r for r in split.collect()}
    big, small = got["a"], got["b"]
    assert big.body_text == "" and big.content_blocks == [] and big.size_verdict is None
    assert hashlib.sha256(big.side_json.encode()).hexdigest() == big.extracted_payload_hash
    assert f"extracted_payload_hash={big.extracted_payload_hash}" in big.extracted_payload_uri
    full = json.loads(big.side_json)
    assert len(full["content_blocks"]) == 20 and list(full) == sorted(full)
    assert small.side_json is None and small.extracted_payload_uri is None and small.body_text == texts[0]
    assert article_flow.side_payloads(split).count() == 1
    tiny = article_flow.split_oversize(events, 100).collect()
    assert all(r.size_verdict.startswith("slim event too large") for r in tiny)


def test_rss_first_child_all_channels_and_end(spark):
    item = "<item><title>{0}</title><title>second</title><link>https://p.test/{0}</link></item>"
    two = f"<rss><channel>{item.format('a')}</channel><channel>{item.format('b')}</channel></rss>"
    payloads = spark.createDataFrame(
        [(1, two), (2, two + "<!-- end -->\n"), (3, two + "tail"), (4, two + "<x/>")], "feed_id int, payload string")
    parsed = rss.parse_feeds(payloads).collect()
    assert {r.feed_id: r.verdict for r in parsed} == {1: None, 2: None, 3: "not_rss", 4: "not_rss"}
    assert [[i.title for i in r["items"]] for r in parsed if r.feed_id < 3] == [["a", "b"]] * 2


def test_feed_domain_in_either_form(spark):
    rows = items(spark, ("s", "f", "https://xn--bo-mia.vn/1", "t"), ("s", "g", "https://www.báo.vn/2", "t"),
                 ("s", "h", "https://bao.vn/3", "t"))
    kept = feeds.dedupe_items(feeds.classify_items(rows))
    domains = spark.createDataFrame([("s", "Báo.vn")], "source_id string, domain string")
    off = {r.feed_id: r.off_domain for r in feeds.off_domain_feeds(kept, domains).collect()}
    assert off == {"h": 1}


def test_checkpoints_keep_validators_of_accepted_content(spark):
    from presswork.plans.feed_scan import scan_feeds

    names = ["new", "same", "gone304", "empty", "rejected", "unpolled"]
    raw = [(n, "f", 0, f"https://{'evil.test' if n == 'rejected' else 'p.test'}/{n}", n, "", "")
           for n in ("new", "same", "rejected")]
    raw = spark.createDataFrame(raw, ITEM)
    responses = spark.createDataFrame(
        [(n, "f", 304 if n == "gone304" else 200, f"etag2-{n}", "later") for n in names if n != "unpolled"],
        "source_id string, feed_id string, status_code int, etag string, last_modified string")
    domains = spark.createDataFrame([(n, "p.test") for n in names], "source_id string, domain string")
    prior = {r.source_id: r.content_hash for r in feeds.semantic_hash(feeds.with_hashes(
        feeds.dedupe_items(feeds.classify_items(raw)))).collect()}
    checkpoints = spark.createDataFrame(
        [(n, "f", prior.get(n, "old") if n == "same" else "old", True, f"etag1-{n}", "early", f"uri-{n}") for n in names[1:]],
        "source_id string, feed_id string, content_hash string, events_published boolean, etag string,"
        " last_modified string, payload_uri string").withColumn("observed_at", F.lit("2024-01-01").cast("timestamp"))
    remembered = spark.createDataFrame([], "source_id string, feed_id string, feed_item_id string, record_hash string")
    scan = scan_feeds(raw, responses, domains, remembered, checkpoints, F.lit("2024-02-01").cast("timestamp"))
    got = {r.source_id: r for r in scan.checkpoints.collect()}
    assert {n: got[n].etag for n in names} == {
        "new": "etag2-new", "same": "etag2-same", "gone304": "etag1-gone304", "empty": "etag1-empty",
        "rejected": "etag1-rejected", "unpolled": "etag1-unpolled"}
    assert got["same"].payload_uri == "uri-same" and got["new"].payload_uri and len(got) == len(names)
    assert scan.items.filter("source_id = 'new'").count() == 1


def test_select_content_tells_what_is_missing(spark):
    latest = spark.createDataFrame(
        [("a", "extracted", "", "s1", None), ("b", "extracted", "", "s2", None), ("c", "fetched", None, None, "p1"),
         ("d", "extracted", "body", None, None), ("d", "fetched", None, None, "p1"), ("e", "fetched", None, None, "p2")],
        "article_id string, stage string, body_text string, extracted_payload_uri string, payload_uri string")
    side = spark.createDataFrame([("s1", "side")], "extracted_payload_uri string, side_text string")
    pages = spark.createDataFrame([("p1", "<p>")], "payload_uri string, html string")
    got = {r.article_id: (r.content, r.verdict) for r in lookup.select_content(latest, side, pages).collect()}
    assert got == {"a": ("side", None), "b": (None, "missing_side_payload"), "c": ("<p>", None), "d": ("body", None),
                   "e": (None, "missing_payload")}


def test_metric_sums_are_exact_in_any_order(spark):
    """Against rational sums: tiny, huge, cancelling and ordinary amounts."""
    rnd = random.Random(8)
    pools = [
        [5e-324, 2.2e-308, -5e-324, 1e-300], [1e300, -1e300, 1.5e300, 3.0], [0.1, 0.2, 0.3, -0.6], [1e16, 1.0, -1e16, 1e-16],
        [2.0**k for k in range(-40, 40)], [123.45, 0.01, 99.99, 1e9, 1e10], [1.7e308, 1.7e308], [0.0, -0.0],
    ]
    rows, want = [], {}
    for i, pool in enumerate(pools):
        amounts = [rnd.choice(pool) for _ in range(rnd.randrange(2, 60))] + pool
        rows += [(f"s{i}", a) for a in amounts]
        total = sum(map(Fraction, amounts))
        try:
            want[f"s{i}"] = float(total)
        except OverflowError:
            want[f"s{i}"] = math.inf if total > 0 else -math.inf
    rows += [("odd", math.inf), ("odd", 1.0), ("nan", math.nan), ("none", None), ("none", None), ("mixed", None), ("mixed", 0.25)]
    want |= {"odd": math.inf, "none": 2.0, "mixed": 1.25}
    rnd.shuffle(rows)
    none = F.lit(None).cast("string")
    records = spark.createDataFrame(rows, "service string, metric_value double").repartition(7).select(
        F.window(F.lit("2024-01-01").cast("timestamp"), "1 day").alias("window"), F.lit("pipeline_metric").alias("topic_key"),
        none.alias("source_id"), none.alias("stage"), none.alias("error_class"), "service",
        F.lit("consumer_retry_count").alias("metric_name"), F.lit("count").alias("metric_unit"), "metric_value",
        F.lit(None).cast("map<string,string>").alias("dimensions"))
    got = {r.entries[0].value: r.value for r in metrics.metric_counts(records).collect()}
    assert math.isnan(got.pop("nan")) and got == want


def test_poll_in_one_pass_equals_single_steps(spark):
    from presswork.plans.feed_scan import scan_feeds

    rnd = random.Random(12)
    urls = [f"https://{h}/{i}" for h in ("p.test", "www.p.test", "evil.test", "www.bé.test", "xn--b-bja.test") for i in range(6)] + ["ftp://x", ""]
    raw = [
        (s, f, i, rnd.choice(urls[:12] if f != "g" else urls) + rnd.choice(["", "?utm_source=x"]), rnd.choice(["a", "b", ""]), "", "")
        for i, (s, f) in enumerate([(s, f) for s in "stu" for f in "fgh"] * 12)
    ]
    raw = spark.createDataFrame(raw, ITEM)
    domains = spark.createDataFrame([("s", "p.test"), ("t", "Bé.test")], "source_id string, domain string")
    current = feeds.with_hashes(feeds.dedupe_items(feeds.classify_items(raw)))
    seen = [(r.source_id, r.feed_id, r.feed_item_id, rnd.choice([r.record_hash, "old"])) for r in current.collect() if rnd.random() < 0.6]
    seen += [("s", "f", "gone", "h"), ("z", "f", "elsewhere", "h")]
    remembered = spark.createDataFrame(seen, "source_id string, feed_id string, feed_item_id string, record_hash string")
    hashes = {(r.source_id, r.feed_id): r.content_hash for r in feeds.semantic_hash(current).collect()}
    checkpoints = spark.createDataFrame(
        [(s, f, hashes.get((s, f)) if f == "h" else "x", True) for s in "st" for f in "fgh"],
        "source_id string, feed_id string, content_hash string, events_published boolean",
    ).withColumns({"observed_at": F.lit("2024-01-01").cast("timestamp"), "etag": F.lit("e"), "last_modified": F.lit("l")})
    responses = spark.createDataFrame(
        [(s, f, 304 if (s, f) == ("u", "f") else 200, "e", "l") for s in "stuv" for f in "fgh"],
        "source_id string, feed_id string, status_code int, etag string, last_modified string")
    scan = scan_feeds(raw, responses, domains, remembered, checkpoints, F.lit("2024-02-01").cast("timestamp"))
    classified = feeds.classify_items(raw)
    changed = feeds.diff_items(current, remembered)
    status = feeds.feed_status(
        responses, feeds.item_counts(classified), feeds.semantic_hash(current), changed, checkpoints,
        feeds.off_domain_feeds(current, domains))
    outcomes = sorted(map(repr, scan.outcomes.collect()))
    assert outcomes == sorted(map(repr, status.collect()))
    published = {(r.source_id, r.feed_id) for r in status.collect() if r.status == "published"}
    assert published and len({r.status for r in status.collect()}) > 3
    want = {(r.feed_item_id, r.record_hash, r.title) for r in changed.collect() if (r.source_id, r.feed_id) in published}
    assert {(r.feed_item_id, r.record_hash, r.title) for r in scan.discovered.collect()} == want
    now = [r for r in current.collect() if (r.source_id, r.feed_id) in published]
    state = {r[2]: r[3] for r in seen} | {r.feed_item_id: r.record_hash for r in now}
    assert {r.feed_item_id: r.record_hash for r in scan.items.collect()} == state


def test_oversize_split_makes_the_json_once(spark):
    """The bus JSON comes with the split: as a whole where it fits, slim where it does not."""
    block = "array<struct<type:string,text:string,ordinal:int>>"
    image = "array<struct<url:string,alt:string,caption:string,ordinal:int>>"
    rows = [("a", "x" * 900, [("paragraph", "x" * 900, 0)]), ("b", "short", [("paragraph", "short", 0)])]
    table = spark.createDataFrame(rows, f"article_id string, body_text string, content_blocks {block}").select(
        "*", *[F.lit("x").alias(c) for c in (
            "run_id", "source_id", "ingest_date", "requested_url", "canonical_url", "title", "summary", "author",
            "source_document_id", "payload_uri", "extractor_version")],
        F.array().cast(image).alias("images"), F.lit(None).cast("timestamp").alias("published_at"))
    split = article_flow.split_oversize(article_flow.extracted_events(table, F.lit("2026-06-01").cast("timestamp")), 1500)
    got = {r.article_id: r for r in split.withColumn("again", article_flow.event_json(split)).collect()}
    assert all(r.json == r.again and r.inline_event_bytes == len(r.json.encode()) + 5 for r in got.values())
    assert json.loads(got["a"].json)["body_text"] == "" and json.loads(got["b"].json)["body_text"] == "short"
    assert got["a"].side_json is not None and got["b"].side_json is None
