"""Archives round trip; records by plain gzip; ranges; the query against SQL."""

from __future__ import annotations

import gzip
import hashlib

import pytest
from pyarrow import fs

from checks.compare import compare, duck
from presswork.llm import warc

FOLDER = "/root/testdata/sf0.001"
LONG = "<p>" + "é x " * 60 + "</p>"
ROWS = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, "http://a/9\r\nX: 1 é", LONG), (None, None, LONG), (3, "http://a/3", LONG),
    (1, "http://a/1", None), (2, "http://a/2", ""), (4, None, "small"), (6, "u", "small"), (7, "v", "\r\n\r\n" * 50),
    (8, "w", "\r\n\r\n" * 50), (10, "z", "q" * 3_000_000),
]


def plain(rows):
    out, first = [], {}
    data = [(i, u, (t or "").encode()) for i, u, t in rows]
    for i, u, b in sorted(data, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        if len(b) >= 100:
            first.setdefault(b, (i, u))
    for i, u, b in data:
        revisit = b in first and first[b] != (i, u)
        out.append((i, u, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[b][0] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("roll", [1 << 30, 500])
def test_round_trip(spark, monkeypatch, roll):
    monkeypatch.setattr(warc, "ROLL", roll)
    pages = spark.createDataFrame([(*r, "s") for r in ROWS], "page_id int, url string, html string, file string").repartition(3)
    index = warc.write_archives(pages)
    assert sum(r.n for r in [index.selectExpr("count(*) AS n").first()]) == len(ROWS)
    got = warc.read_records(index).collect()
    assert sorted([tuple(r)[:6] for r in got], key=repr) == plain(ROWS)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    some = warc.read_records(index.filter("page_id in (4, 7, 10)")).collect()
    assert sorted(r.page_id for r in some) == [4, 7, 10]
    for file, offset in {r.file: r.offset for r in index.orderBy("offset").collect()}.items():
        store, path = fs.FileSystem.from_uri(file)
        with store.open_input_file(path) as source:
            whole = gzip.decompress(source.read())
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")


def test_ranges():
    assert warc.ranges([(0, 10), (10, 5), (40, 5)], most=100, hole=20) == [[0, 15, 0, 2], [40, 45, 2, 3]]
    assert warc.ranges([(0, 10), (12, 5), (17, 90)], most=50, hole=20) == [[0, 17, 0, 2], [17, 107, 2, 3]]
    assert warc.ranges([]) == []


def test_broken_record_is_an_error():
    raw = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, False)
    assert warc.parsed(raw)["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(raw.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="no WARC"):
        warc.parsed(b"x")


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.write_archives(pages)).collect() == []


def test_query_matches_sql(spark):
    _, rows, problem = compare(spark, duck(FOLDER), "op7", warc.query, warc.SQL, FOLDER)
    assert rows and not problem, problem
