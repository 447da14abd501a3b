"""Flows over batch manifests: kills between sinks, retries, completions, keyed runs."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from presswork.functions.frames import frame
from presswork.operators.extraction import compile_config
from presswork.plans import extract_flow, fetch_flow
from presswork.session import new_run_folder
from presswork.sources.runs import KeyedRuns
from presswork.streaming import jobs, manifest
from presswork.streaming.manifest import committed

P = "A paragraph of the story that is long enough to be kept by every rule of the extractor."
PAGE = f"<html><head><title>Story</title></head><body><article><p>{P}</p><p>{P[::-1]}</p></article></body></html>"


def at():
    return F.lit("2024-02-01").cast("timestamp")


def records(spark, folder, topic, *events):
    """Appends framed events (offset, dict or raw bytes) to the folder of a stream."""
    rows = spark.createDataFrame(
        [(o, e if isinstance(e, str) else json.dumps(e), isinstance(e, str)) for o, e in events], "o bigint, body string, raw boolean")
    rows.select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col("o").alias("offset"), at().alias("ts"),
        F.when(F.col("raw"), F.encode("body", "UTF-8")).otherwise(frame(F.lit(1), F.col("body"))).alias("value"),
    ).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(extract_flow.RECORD).parquet(folder)


def die_at(monkeypatch, step):
    """The first time a batch reaches ``step`` its run is killed before the manifest knows."""
    mark, left = manifest._mark, [step]

    def killed(spark, root, batch_id, at, rows):
        if at in left:
            left.remove(at)
            raise RuntimeError(f"killed at {at}")
        return mark(spark, root, batch_id, at, rows)

    monkeypatch.setattr(manifest, "_mark", killed)


def fetched_event(i, html, day="2024-01-02", **other):
    digest = hashlib.sha256(html.encode()).hexdigest()
    return {
        "schema_version": "article.fetched.v2", "event_id": f"e{i}", "event_time": "t", "run_id": "r", "source_id": "s",
        "ingest_date": day, "article_id": f"a{i}", "requested_url": f"https://n.test/{i}", "source_document_id": f"d{i}",
        "fetched_at": "t", "status_code": 200, "content_length_bytes": 1, "content_hash": digest, "fetch_status": "success",
        "payload_uri": f"u{i}", **other,
    }


EXTRACT_SINKS = {
    "events": extract_flow.EVENTS, "side": extract_flow.SIDE, "dead": extract_flow.DEAD, "retries": extract_flow.RETRIES,
    "metrics": extract_flow.METRICS,
}


def extraction(spark, root, landed, **how):
    settings = compile_config(spark.createDataFrame(
        [("s", "html_article", None, True), ("off", "html_article", None, False)],
        "source_id string, extractor string, attribution_policy string, enabled boolean"))
    table = spark.createDataFrame([(u, d, bytearray(h.encode())) for u, d, h in landed], "payload_uri string, ingest_date string, payload binary")
    jobs.extract_records(stream(spark, f"{root}/in"), table, settings, root, at(), limit=1400, **how)


def sinks(spark, root, kinds):
    return {name: sorted(map(repr, committed(spark, root, name, kind).collect())) for name, kind in kinds.items()}


def test_extraction_survives_kills_and_retries(spark, monkeypatch):
    long = PAGE.replace("</article>", f"<p>{P.replace('story', 'tale') * 12}</p></article>")
    events = [
        (1, fetched_event(1, PAGE)), (2, fetched_event(2, long)), (3, "{not framed"), (4, fetched_event(4, PAGE, source_id="off")),
        (5, fetched_event(5, PAGE, source_id="who")), (6, fetched_event(6, PAGE)), (7, fetched_event(7, "<p>short</p>")),
        (8, fetched_event(8, PAGE, content_hash="0")), (9, fetched_event(9, PAGE, schema_version="x")),
        (10, {k: v for k, v in fetched_event(10, PAGE).items() if k != "title" and k != "run_id"}),
    ]
    landed = [(f"u{i}", "2024-01-02", h) for i, h in ((1, PAGE), (2, long), (7, "<p>short</p>"), (8, PAGE))]
    calm, hurt = new_run_folder(spark, "calm"), new_run_folder(spark, "hurt")
    for root in (calm, hurt):
        records(spark, f"{root}/in", "news.article_fetched", *events)
    extraction(spark, calm, landed)
    for step in ("side", "visible"):
        with monkeypatch.context() as patch:
            die_at(patch, step)
            with pytest.raises(Exception, match=f"killed at {step}"):
                extraction(spark, hurt, landed)
        assert all(not rows for rows in sinks(spark, hurt, EXTRACT_SINKS).values())
    extraction(spark, hurt, landed)
    got = sinks(spark, calm, EXTRACT_SINKS)
    assert sinks(spark, hurt, EXTRACT_SINKS) == got
    shown = {r.message_key: r for r in committed(spark, calm, "events", extract_flow.EVENTS).collect()}
    assert set(shown) == {"a1", "a2"}
    slim = json.loads(shown["a2"].json)
    side = committed(spark, calm, "side", extract_flow.SIDE).collect()
    assert [s.payload_uri for s in side] == [slim["extracted_payload_uri"]] and slim["body_text"] == ""
    assert hashlib.sha256(side[0].payload).hexdigest() == slim["extracted_payload_hash"] == side[0].content_hash
    dead = {r.source_offset: r.error_message for r in committed(spark, calm, "dead", extract_flow.DEAD).collect()}
    assert dead == {
        3: "bad_framing", 4: "disabled source: off", 5: "unknown source: who", 7: "rejected: no blocks", 8: "hash_mismatch",
        9: "not an article.fetched.v2 event", 10: "missing fields: run_id",
    }
    # the missing payload lands before the next batch, which tries its event again
    assert [(r.offset, r.attempts) for r in committed(spark, calm, "retries", extract_flow.RETRIES).collect()] == [(6, 1)]
    records(spark, f"{calm}/in", "news.article_fetched", (11, fetched_event(1, PAGE)), (12, fetched_event(2, long)))
    extraction(spark, calm, [*landed, ("u6", "2024-01-02", PAGE)])
    later = committed(spark, calm, "events", extract_flow.EVENTS).filter("batch = 1").collect()
    assert sorted(r.message_key for r in later) == ["a1", "a2", "a6"]
    assert committed(spark, calm, "side", extract_flow.SIDE).filter("batch = 1").count() == 0
    assert committed(spark, calm, "retries", extract_flow.RETRIES).filter("batch = 1").count() == 0


def request(i, revision="r1", source="s", url=None):
    return {
        "schema_version": "article.fetch_requested.v3", "event_id": f"q{i}", "event_time": "t", "run_id": "r", "source_id": source,
        "ingest_date": "2024-01-02", "article_id": f"a{i}", "requested_url": url or f"https://n.test/{i}", "request_revision": revision,
    }


def fetching(spark, root, answers):
    sites = spark.createDataFrame(
        [("s", True, "n.test", ["m.test"], [451], ["forbidden words"])],
        "source_id string, enabled boolean, domain string, redirect_domains array<string>, blocked_status_codes array<int>, "
        "invalid_document_markers array<string>")
    rows = [
        (url, n, status, place, "text/html", None, None if body is None else bytearray(body.encode()))
        for url, tries in answers.items() for n, (status, place, body) in enumerate(tries, 1)
    ]
    jobs.fetch_requests(
        stream(spark, f"{root}/in"), spark.createDataFrame(rows, fetch_flow.RESPONSE), sites, root, at(), max_bytes=1000)


def test_fetches_complete_once_and_failed_ones_stay_open(spark, monkeypatch):
    ok = [(200, None, PAGE)]
    answers = {
        "https://n.test/1": ok, "https://n.test/2": [(503, None, None), (200, None, PAGE)], "https://n.test/3": [(503, None, None)] * 3,
        "https://n.test/4": [(302, "https://m.test/4", None)], "https://m.test/4": [(200, None, PAGE + "4")],
        "https://n.test/5": [(302, "https://x.test/", None)], "https://n.test/6": [(451, None, None)], "https://n.test/7": [(404, None, None)],
        "https://n.test/8": [(200, None, "x" * 1001)], "https://n.test/9": [(200, None, "<p>Forbidden words</p>")],
    }
    root = new_run_folder(spark, "fetch")
    records(spark, f"{root}/in", "news.article_fetch_requested",
            *[(i, request(i)) for i in range(1, 11)], (20, request(1)), (21, request(1, "r2")))
    with monkeypatch.context() as patch:
        die_at(patch, "events")
        with pytest.raises(Exception, match="killed at events"):
            fetching(spark, root, answers)
    # payloads have landed, events are not known to be out, nothing is shown yet
    half = {(r.article_id, r.request_revision): r.state for r in fetch_flow.states(spark, root).collect()}
    assert half["a1", "r1"] == half["a2", "r1"] == "landed" and half["a3", "r1"] == half["a7", "r1"] == "open"
    assert committed(spark, root, "landing", fetch_flow.LANDING).count() == 0
    fetching(spark, root, answers)
    got = {r.offset: (r.status, r.error_message) for r in committed(spark, root, "answers", fetch_flow.ANSWERS).collect()}
    assert got == {
        1: ("published", None), 2: ("published", None), 3: ("retry", "status 503"), 4: ("published", None), 5: ("dlq", "outside_domain"),
        6: ("dlq", "blocked status 451"), 7: ("dlq", "status 404"), 8: ("dlq", "too_large"), 9: ("dlq", "marker: forbidden words"),
        10: ("retry", "no answer"), 20: ("already_processed", None), 21: ("published", None),
    }
    events = committed(spark, root, "events", fetch_flow.EVENTS).collect()
    assert sorted(r.message_key for r in events) == ["a1", "a1", "a2", "a4"]
    assert committed(spark, root, "landing", fetch_flow.LANDING).count() == 3  # both revisions of a1 have one payload
    metrics = committed(spark, root, "metrics", extract_flow.METRICS).collect()
    assert sorted((m.metric_name, json.loads(m.dimensions).get("status_code")) for m in metrics) == sorted(
        [("article_fetch_retry_count", "503")] * 3 + [("consumer_retry_count", None)] * 2, key=repr)
    # a later batch: completed fetches answer, the open one succeeds
    records(spark, f"{root}/in", "news.article_fetch_requested", (30, request(1)), (31, request(2, url="https://n.test/7")))
    fetching(spark, root, {**answers, "https://n.test/3": ok})
    later = committed(spark, root, "answers", fetch_flow.ANSWERS).filter("batch = 1").collect()
    assert {r.offset: (r.status, r.attempts) for r in later} == {
        3: ("published", 2), 10: ("retry", 2), 30: ("already_processed", 1), 31: ("already_processed", 1)}
    assert len({r.source_document_id for r in later if r.article_id == "a2"} - {None}) == 1
    states = {(r.article_id, r.request_revision): r.state for r in fetch_flow.states(spark, root).collect()}
    assert states["a3", "r1"] == "completed" and states["a10", "r1"] == "open" and states["a5", "r1"] == "open"


def test_keyed_runs_match_a_dictionary(spark):
    """Random changes, ends of keys and repeated versions; few runs whatever the number of batches."""
    rnd = random.Random(2)
    state = KeyedRuns(new_run_folder(spark, "runs"), ("k", "part"), "k string, part int, v string, level int", buckets=3, fan=3, group=("k",))
    want = {}
    assert state.read(spark, -1).collect() == []
    for version in range(11):
        touched = {(rnd.choice("abcdef"), rnd.randrange(3)): rnd.random() < 0.3 for _ in range(rnd.randrange(5))}
        rows = [(k, p, None if gone else f"{version}", version, gone) for (k, p), gone in touched.items()]
        for _ in range(2 if version % 4 == 0 else 1):  # a repeated batch ends in the same version
            state.write(spark.createDataFrame(rows, "k string, part int, v string, level int, gone boolean"), version)
        for (k, p), gone in touched.items():
            want.pop((k, p), None)
            if not gone:
                want[k, p] = (f"{version}", version)
        live = state.live(spark, version)
        assert all(sum(1 for level, _ in live if level == n) < 3 for n in range(4))
    assert state.latest(spark) == 10
    read = lambda frame: {(r.k, r.part): (r.v, r.level) for r in frame.collect()}
    assert read(state.read(spark, 10)) == want
    of = spark.createDataFrame([("a", 0), ("a", 0), ("c", 1), ("zz", 9)], "k string, part int")
    assert read(state.read(spark, 10, of)) == {k: v for k, v in want.items() if k in (("a", 0), ("c", 1))}
    assert read(state.read(spark, 10, of.select("k"))) == {k: v for k, v in want.items() if k[0] in "ac"}
    dead, live = state.dead_runs(spark, 10), state.live(spark, 10)
    assert dead and not {state._run_folder(*r) for r in live} & set(dead)
    # one batch with everything holds the same rows
    whole = KeyedRuns(new_run_folder(spark, "whole"), state.keys, state.schema)
    whole.write(spark.createDataFrame([(*k, *v) for k, v in want.items()], state.schema), 0)
    assert read(whole.read(spark, 0)) == want


def test_unclaimed_errors_stop_before_anything_is_shown(spark):
    from presswork.functions.errors import error_struct

    root = new_run_folder(spark, "routes")
    rows = spark.createDataFrame(
        [(1, "ok"), (2, "retry"), (3, "dlq"), (4, "stray")], "offset bigint, kind string")
    rows.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", "kind").write.parquet(f"{root}/in")
    source = spark.readStream.schema("topic string, partition int, offset bigint, kind string").parquet(f"{root}/in")
    error = error_struct(F.lit("article_fetch"), F.lit("E"), F.lit("m"), F.col("kind") == "retry")
    consumed = source.select(
        "topic", "partition", "offset", frame(F.lit(1), F.lit("{}")).alias("value"), F.lit("s").alias("source_id"),
        (F.col("kind") == "stray").alias("untyped"), F.when(F.col("kind") != "ok", error).alias("error"))
    with pytest.raises(Exception, match="unclaimed errors"):
        jobs.route_records(consumed, root, "svc", at())
    assert manifest.visible_upto(spark, root) == -1
    jobs.route_records(consumed, root, "svc", at(), park_unclaimed=True)
    kept = lambda sink: [r.offset for r in committed(spark, root, sink, "offset bigint").collect()]
    assert (kept("accepted"), kept("retries"), kept("parked")) == ([1], [2], [4])
    assert [r.source_offset for r in committed(spark, root, "dead", extract_flow.DEAD).collect()] == [3]
    assert committed(spark, root, "metrics", extract_flow.METRICS).count() == 1


def test_a_fetch_is_judged_by_markers_as_written(spark):
    rows = [(bytearray(b"<h1>Island news</h1>"),), (bytearray(b"<h1>is it so</h1>"),)]
    answers = spark.createDataFrame(rows, "payload binary").selectExpr(
        "payload", "200 AS status_code", "CAST(null AS string) AS verdict", "'ok' AS kind",
        "CAST(null AS string) AS declared_length", "'text/html' AS content_type",
        "array('<h1>Is ', ' ') AS invalid_document_markers")
    wrong = fetch_flow._fetch_error(1000)["error_message"]
    assert [r[0] for r in answers.select(wrong).collect()] == [None, "marker: <h1>Is "]


def test_only_the_deciding_answer_brings_its_content(spark):
    page = lambda text: bytearray(text.encode())
    rows = [
        ("u1", 1, 503, None, "text/html", None, page("busy")), ("u1", 2, 200, None, "text/html", "4", page("page")),
        ("u1", 3, 200, None, "text/html", None, page("late")), ("u2", 1, 404, None, "text/html", None, page("gone")),
        ("u3", 1, None, None, None, None, None), ("u4", 4, 200, None, "text/html", None, page("too late")),
        ("u5", 1, 302, "u1", None, None, page("moved")), ("u6", 1, 204, None, "text/html", None, page("")),
    ]
    edges, answers, content = fetch_flow._apart(spark.createDataFrame(rows, fetch_flow.RESPONSE), 3)
    assert [f.name for f in answers.schema["answers"].dataType.elementType] == ["attempt", "status_code"]
    assert sorted(bytes(r.payload) for r in content.collect()) == [b"", b"late", b"page"]
    requests = spark.createDataFrame(
        [("t", 0, i, url, verdict) for i, (url, verdict) in enumerate(
            [("u1", None), ("u2", None), ("u3", None), ("u4", None), ("u1", "not_https"), ("u6", None), ("u1", None)])],
        "topic string, partition int, offset bigint, final_url string, verdict string",
    ).selectExpr("*", "CAST(null AS string) AS error", "CAST(null AS string) AS done", "array(451) AS blocked_status_codes")
    got = {r.offset: r for r in fetch_flow._with_answer(requests, answers, content).collect()}
    assert {o: (r.kind, r.status_code, r.payload and bytes(r.payload), len(r.retried or [])) for o, r in got.items()} == {
        0: ("ok", 200, b"page", 1), 1: ("permanent", 404, None, 0), 2: ("transport", None, None, 0), 3: (None, None, None, 0),
        4: (None, None, None, 0), 5: ("ok", 204, bytearray(), 0), 6: ("ok", 200, b"page", 1)}
    assert got[0].declared_length == "4" and [e.from_url for e in edges.collect()] == ["u5"]


def test_empty_pages_are_refused_unless_the_caller_takes_them(spark):
    answers = spark.createDataFrame([(bytearray(b""),), (bytearray(b"<p>x</p>"),)], "payload binary").selectExpr(
        "payload", "200 AS status_code", "CAST(null AS string) AS verdict", "'ok' AS kind",
        "CAST(null AS string) AS declared_length", "'text/html' AS content_type",
        "array('marker') AS invalid_document_markers")
    said = lambda *how: [r[0] for r in answers.select(fetch_flow._fetch_error(1000, *how)["error_message"]).collect()]
    assert said() == ["empty", None] and said(True) == [None, None]
