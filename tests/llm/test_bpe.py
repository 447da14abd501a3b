"""Encoding against tiktoken, decoding against the texts."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from presswork.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\n c", " \n \nx", "\t\tx  y", "it's I'LL we've '  's", "x y   z",
    "　 a \x85b \x1c c\x1c d", "é è́ ñ ß 中文字 かな 한글 🙂🙂 🇫🇷", "1234567890 12.5e-7 ½ Ⅷ", "<|endoftext|> a",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 700, "ab" * 400, "\n" * 300 + " x", "!?!?,,;;  --==", "\x00\x01 ﻿",
]


def test_odd_texts(library):
    tool = bpe.Codec(PATH, PATTERN)
    for _ in range(2):  # the second time from the memo
        got = tool.encode(ODD)
        assert [list(memoryview(x).cast("i")) for x in got] == [library.encode_ordinary(t) for t in ODD]


def test_random_texts(library):
    rnd = random.Random(3)
    alphabet = "aeiou  \n\t'strdm.,!19é中  \x1c\x85" + "🙂"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(3000)]
    got = bpe.Codec(PATH, PATTERN).encode(texts)
    assert [list(memoryview(x).cast("i")) for x in got] == [library.encode_ordinary(t) for t in texts]


def test_long_words(library):
    rnd = random.Random(5)
    texts = ["=" * 120_000, " " * 120_000 + "x", "中文字" * 40_000, "".join(rnd.choices("etaoinshr", k=120_000)),
             *("".join(rnd.choices("abcdeé中", k=k)) for k in range(40, 130)), "a\n" + "\n" * 100_000]
    got = bpe.Codec(PATH, PATTERN).encode(texts)
    assert [list(memoryview(x).cast("i")) for x in got] == [library.encode_ordinary(t) for t in texts]


def test_frames(spark, library):
    rows = [(i, t, "kept", 1.5) for i, t in enumerate([*ODD, None, "x " * 9000])]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, IDS string, `we ird.` double").repartition(3)
    made = bpe.encode(docs, PATH, PATTERN)
    assert made.columns == ["doc_id", "text", "we ird.", "ids"]
    back = bpe.decode(made, PATH, PATTERN).collect()
    assert len(back) == len(rows) + 1
    for r in back:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(none, PATH, PATTERN).first().decoded) == b""
    assert bpe.decode(bpe.encode(docs.limit(0), PATH, PATTERN), PATH, PATTERN).collect() == []


def test_unknown_id(spark):
    bad = spark.createDataFrame([(1, [50_256])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, PATH, PATTERN).collect()


def test_query(spark, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(F.col("doc_id"), "text").collect()}
    got = bpe.query(spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())
