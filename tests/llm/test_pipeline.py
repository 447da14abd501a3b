"""The pipeline's stages against plain models of their decisions."""

from __future__ import annotations

import base64

import public_tokenizers
import tiktoken

import corpus_pipeline
from presswork.llm import toxicity
from presswork.llm.common import saved
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_simhash import groups
from tests.llm.test_simhash import plain as plain_hash

FOLDER = "/root/testdata/sf0.001"


def test_stages_match_plain_models(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, tables = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, FOLDER), f"test-{name}")
        if name != "tokens":
            assert docs.columns == columns
        tables[name] = {r.doc_id: r for r in docs.collect()}
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    scores = {r.doc_id: r.predicted for r in toxicity.query(spark, FOLDER).collect()}
    left = {i: t for i, t in first.items() if not scores[i]}
    assert {i: r.text for i, r in tables["toxicity"].items()} == left
    left = {i: x[2] for i, x in plain_lines(list(left.items()), 50).items()}
    assert {i: r.text for i, r in tables["line_dedup"].items()} == left
    hashes = {}
    for i, t in left.items():
        hashes[plain_hash(t)] = min(i, hashes.get(plain_hash(t), i))
    of = groups(hashes, lambda a, b: (a ^ b).bit_count() <= 4)
    left = {i: t for i, t in left.items() if of[plain_hash(t)] == i}
    assert {i: r.text for i, r in tables["near_dedup"].items()} == left
    dirty = set()
    for i, t in left.items():
        n, hit, _ = plain_hits(t, items, 13)
        if hit and 20 * len(hit) >= n:
            dirty.add(i)
    left = {i: t for i, t in left.items() if i not in dirty}
    assert {i: r.text for i, r in tables["decontamination"].items()} == left
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as rows:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rows)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: r.ids for i, r in tables["tokens"].items()} == {i: library.encode_ordinary(t) for i, t in left.items()}
    assert all(r.round_trip for r in tables["tokens"].values())
    ran = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r.doc_id for r in ran.collect()) == sorted(left)


def test_odd_tables(spark):
    """Nulls, empty texts, repeated rows and ids, columns with the stages' own names, no n_chars."""
    kind = "doc_id long, text string, n_lines string, Items string, n_words int, spans string, row int, fp string"
    line, tail = (" ".join(f"{w}{i}" for i in range(60)) for w in ("word", "tail"))
    texts = [
        (1, "one text about a river and its long way to the sea"), (2, "one text about a river and its long way to the sea"),
        (2, "quite another story of two mountains that nobody climbed before"),
        (3, "quite another story of two mountains that nobody climbed before"),
        (None, None), (5, ""), (None, "a text that has no id but words enough to stand alone"),
        (None, "a text that has no id but words enough to stand alone"), (7, line), (8, f"{line}\n{tail}"),
    ]
    docs = spark.createDataFrame([(i, t, "l", "i", 4, "s", 5, "f") for i, t in texts], kind).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = saved(stage(spark, docs, FOLDER), f"odd-{name}")
        assert made.columns == docs.columns, name
        assert {tuple(r)[2:] for r in made.collect()} == {("l", "i", 4, "s", 5, "f")}
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()), key=repr)
    want = [texts[0], texts[2], texts[5], texts[6], texts[8], texts[9]]
    assert kept == sorted(want, key=repr)
    cut = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, FOLDER).collect()}
    assert cut[7] == line and cut[8] == tail
    rows = corpus_pipeline.tokenize(spark, docs, FOLDER).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
