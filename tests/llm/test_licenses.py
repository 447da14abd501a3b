"""License rules against plain matching without gates; base places against word lists."""

from __future__ import annotations

import random
import re

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from presswork.llm import licenses
from presswork.llm.license_rules import KINDS, rules

FOLDER = "/root/testdata/sf0.001"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TABLE = rules()


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text):
    """n_words, base places and labels with every rule run and pairs compared."""
    row = words(text)
    joined = " ".join(row).encode().decode("latin-1")
    base = sorted(
        (i, PHRASES[p]) for p in PHRASES for i in range(len(row)) if row[i : i + len(p.split())] == p.split()
    )
    found = []
    for rule in TABLE:
        for m in rule.pattern.finditer(joined):
            first = joined.count(" ", 0, m.start())
            found.append((first, first + m[0].count(" ") + 1, rule))
    stronger = lambda a, b: (-a[2].priority, a[0] - a[1], a[2].number) < (-b[2].priority, b[0] - b[1], b[2].number)
    keep = [
        f for f in found
        if f[2].kind == "base" or not any(o[0] <= f[0] and f[1] <= o[1] and o[2].kind != "base" and stronger(o, f) for o in found)
    ]
    left = 1.0
    for kind in sorted({f[2].kind for f in keep}):
        left *= 1 - KINDS[kind][1]
    return (
        len(row), len(base), base[0][0] if base else None, base[-1][0] if base else None,
        ",".join(sorted({x for _, x in base})), ",".join(sorted({f[2].label for f in keep})), 1 - left,
    )


def rows(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = licenses.scan(frame).select("doc_id", *licenses.report()).collect()
    return [tuple(r)[1:] for r in sorted(made)]


def test_known_statements(spark):
    cases = {
        "This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-3.0"),
        "Licensed under CC BY-NC 4.0.": ("cc-by", "cc-by,cc-by-nc-4.0"),
        "Released under the MIT License.": ("", "mit"),
        "Licensed under the Apache License, Version 2.0.": ("", "apache-2.0"),
        "SPDX-License-Identifier: BSD-3-Clause": ("", "bsd-3-clause"),
        "GNU Lesser General Public License v2.1": ("gpl", "gpl,lgpl-2.1"),
        "https://creativecommons.org/licenses/by-sa/4.0/": ("", "cc-by-sa-4.0"),
        "Acme 2019. All rights reserved. ALL RIGHTS\nRESERVED": ("reserved", "reserved"),
        "Tous droits réservés": ("", "rights"),
        "a permit, a committee, unlicensed general publications": ("", ""),
    }
    got = rows(spark, list(cases))
    assert [r[4:6] for r in got] == list(cases.values())
    assert got[7][:4] == (8, 2, 2, 5) and got[9][6] == 0 and got[4][6] > got[1][6] - 0.5


def test_against_every_rule_run(spark):
    rnd = random.Random(4)
    pieces = [
        "licensed under the", "gnu", "general public license", "lesser general public license", "version 3", "v2.1", "CC BY", "CC-BY-SA 4.0",
        "all rights", "reserved", "mit license", "apache license", "2.0", "see LICENSE.txt for details", "copyright (c) 2020", "mozilla public license",
        "spdx-license-identifier: mit", "word", "é", "is in the public domain", "or", "distributed under the terms of the", "ﬁ", "\n", " ",
    ]
    texts = [" ".join(rnd.choices(pieces, k=rnd.randrange(25))) for _ in range(200)]
    texts += [None, "", " .,", "CC BY " * 3000, "cc by cc by", "x" * 200_000, "© 2020 all rights reserved"]
    assert rows(spark, texts) == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_every_match_holds_a_gate(data):
    rule = data.draw(st.sampled_from(TABLE))
    inner = re.compile(rule.pattern.pattern[len("(?<![^ ])"):-len("(?![^ ])")])
    text = data.draw(st.from_regex(inner, fullmatch=True).filter(lambda t: "\n" not in t))
    assert any(g in text for g in rule.gates), (rule, text)


def test_table():
    assert len(TABLE) > 400 and {r.kind for r in TABLE} == set(KINDS)
    assert all(re.fullmatch("[^ ]+( [^ ]+)*", g) for r in TABLE for g in r.gates)


def test_staircase_equals_pairs():
    rnd = random.Random(9)
    for _ in range(200):
        spans = [(a := rnd.randrange(30), a + rnd.randrange(1, 9), rnd.randrange(len(TABLE))) for _ in range(rnd.randrange(25))]
        spans = list(set(spans))
        key = lambda f: (-TABLE[f[2]].priority, f[0] - f[1], f[2])
        want = sorted(
            f for f in spans
            if TABLE[f[2]].kind == "base"
            or not any(o[0] <= f[0] and f[1] <= o[1] and TABLE[o[2]].kind != "base" and key(o) < key(f) for o in spans)
        )
        assert licenses.suppressed(spans, TABLE) == want


def test_columns_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "cc by", "kept", 7)], "doc_id long, text string, found string, n_words int")
    made = licenses.scan(frame, out="here").first()
    assert (made.found, made.n_words, made.here.n_words, made.here.found[0].label) == ("kept", 7, 2, "cc-by")
    assert licenses.scan(frame.limit(0)).collect() == []


def test_query(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = [tuple(r) for r in licenses.query(spark, FOLDER).collect()]
    assert sorted(got) == sorted((i, *plain(t)) for i, t in texts)
