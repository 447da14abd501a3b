"""Byte-level BPE by recursive SQL, one DuckDB database per Python worker.

Encoding. A text is cut into the pattern's matches (words). The distinct words of a
batch become token-position rows; a recursive query joins each position and its
right neighbour with the merge table and contracts every word's leftmost pair of
minimum rank until no word has a pair left. The recursion keeps the rows of every
round, which grow with the square of a word; words above LONG bytes are contracted
in the same order by a heap of pairs, in memory linear in the word. Words met before
come from a bounded memo that lives as long as the worker, through all its tasks. Decoding joins token ids with the vocabulary and aggregates
their bytes in position order.

Texts are first cut before every space that a non-space follows. The pattern never
matches across such a place, so equal pieces have equal tokens and each distinct
piece is matched once.

Defined results: null texts and null id lists count as empty; empty texts have no
ids; repeated rows give repeated result rows; an id outside the vocabulary is an
error. Columns named like a new one are replaced.
"""

from __future__ import annotations

import base64
import re
from heapq import heapify, heappop, heappush

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import carried, fresh, once_per_worker, parts, read

#: Texts encoded together, in bytes; words contracted together, in bytes.
SLICE, WORDS_SLICE = 2 << 20, 250_000
#: Bytes from which a word is long; rows of all rounds (half the squares of the words' bytes) made together.
LONG, ROWS_SLICE = 64, 2_500_000
#: Memoised words and pieces, each, before all but SHORT ones are dropped; long ones are never kept.
MEMO, MEMO_LENGTH, SHORT = 250_000, 64, 6
DECODE_SLICE = 400_000

CONTRACT = """
WITH RECURSIVE s(w, pos, e, t, n, k, step) AS (
  SELECT w, pos, pos + 1, t, n, m.r::BIGINT * 4294967296 + pos, 0
  FROM tokens LEFT JOIN merges m ON m.pair = t * 65536::BIGINT + n
 UNION ALL
  -- the pair (bp, be) becomes one token at bp; its left neighbour sees the new token
  SELECT w, p, e, t, n, m.r::BIGINT * 4294967296 + p, step FROM (
    SELECT s.w, CASE WHEN s.pos = be THEN bp ELSE s.pos END p, s.e,
      CASE WHEN s.pos = be THEN br ELSE s.t END t, CASE WHEN s.e = bp THEN br ELSE s.n END n,
      step + 1 AS step
    FROM s JOIN (
      SELECT w, (k >> 32)::INT br, (k & 4294967295)::INT bp, be
      FROM (SELECT w, min(k) k, arg_min(e, k) be FROM s GROUP BY w) WHERE k IS NOT NULL
    ) b USING (w)
    WHERE s.pos <> bp
  ) LEFT JOIN merges m ON m.pair = t * 65536::BIGINT + n
)
SELECT w, list(t ORDER BY pos) AS ids
FROM s SEMI JOIN (SELECT w, max(step) step FROM s GROUP BY w) USING (w, step)
GROUP BY w ORDER BY w
"""

DECODE = """
SELECT d, string_agg(h, '') AS h
FROM (SELECT d, h FROM ids JOIN vocabulary USING (t) ORDER BY d, pos) GROUP BY d
"""

_cut = re.compile(r"(?= \S)").split


def _short(memo: dict[str, bytes]) -> dict[str, bytes]:
    """What a full memo keeps: short texts, the likeliest to come again."""
    kept = {k: v for k, v in memo.items() if len(k) <= SHORT}
    return kept if len(kept) <= MEMO // 2 else {}


class Codec:
    """One worker's database of a rank file, and its memo."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = regex.compile(pattern).findall
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], "i4")
        self.ranks, self.made = ranks, set()
        self.token_of = {r: t for t, r in ranks.items()}
        self.con = duckdb.connect(
            config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": True}
        )
        self.size = 1 + max(ranks.values())
        self.word_ids: dict[str, bytes] = {}
        self.piece_ids: dict[str, bytes] = {}
        self.glued: set[str] = set()
        self.first_ids: dict[str, bytes] = {}

    def _merges(self) -> pa.Table:
        """All pairs of tokens that make up a token, by its rank."""
        ranks = self.ranks
        halves = [
            (ranks[t[:i]] * 65536 + ranks[t[i:]], r)
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        pair, rank = zip(*halves)
        return pa.table({"pair": pa.array(pair, pa.int64()), "r": pa.array(rank, pa.int32())})

    def _vocabulary(self) -> pa.Table:
        return pa.table({"t": pa.array(list(self.ranks.values()), pa.int32()), "h": [t.hex() for t in self.ranks]})

    def _table(self, name: str, make) -> None:
        """A table that stays, made when it is first needed: a worker encodes or decodes."""
        if name in self.made:
            return
        self.made.add(name)
        rows = make()
        self.con.register("_rows", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM _rows")
        self.con.unregister("_rows")

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word (not empty), as int32 bytes."""
        self._table("merges", self._merges)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        tokens = self.of_byte[np.frombuffer(b"".join(words), "u1")]
        ends = np.cumsum(lengths)
        last = np.zeros(len(tokens), bool)
        last[ends - 1] = True
        rows = pa.table({
            "w": np.repeat(np.arange(len(words), dtype="i4"), lengths),
            "pos": (np.arange(len(tokens)) - np.repeat(ends - lengths, lengths)).astype("i4"),
            "t": tokens,
            "n": pa.array(np.append(tokens[1:], 0).astype("i4"), mask=last),
        })
        self.con.register("tokens", rows)
        ids = self.con.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
        self.con.unregister("tokens")
        flat, offsets = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        raw, at = flat.astype("<i4").tobytes(), ((offsets - offsets[0]) * 4).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def contract_long(self, word: bytes) -> bytes:
        """Ids of one word, as int32 bytes: its leftmost pair of minimum rank by a heap."""
        ranks, names = self.ranks, self.token_of
        size = len(word)
        tokens = self.of_byte[np.frombuffer(word, "u1")].tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        known: dict[tuple[int, int], int | None] = {}

        def rank(a: int, b: int) -> int | None:
            if (a, b) not in known:
                known[a, b] = ranks.get(names[a] + names[b])
            return known[a, b]

        pairs = (rank(a, b) for a, b in zip(tokens, tokens[1:]))
        heap = [r << 32 | i for i, r in enumerate(pairs) if r is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            at, made = top & 0xFFFFFFFF, top >> 32
            right = after[at]
            # a pair whose tokens changed since has another rank, or none
            if tokens[at] < 0 or right >= size or rank(tokens[at], tokens[right]) != made:
                continue
            tokens[at], tokens[right] = made, -1
            after[at] = later = after[right]
            if later < size:
                before[later] = at
                if (r := rank(made, tokens[later])) is not None:
                    heappush(heap, r << 32 | at)
            if (left := before[at]) >= 0 and (r := rank(tokens[left], made)) is not None:
                heappush(heap, r << 32 | left)
        return np.array([t for t in tokens if t >= 0], "<i4").tobytes()

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of exact pieces of text."""
        cut = [self.words(p) for p in pieces]
        new = sorted({w for words in cut for w in words}.difference(self.word_ids))
        found, part, raw, size, rows = {}, [], [], 0, 0
        for word in new:
            as_bytes = word.encode()
            if len(as_bytes) > LONG:
                found[word] = self.contract_long(as_bytes)
                continue
            part.append(word)
            raw.append(as_bytes)
            size += len(as_bytes)
            rows += len(as_bytes) ** 2 // 2
            if size >= WORDS_SLICE or rows >= ROWS_SLICE:
                found.update(zip(part, self.contract(raw)))
                part, raw, size, rows = [], [], 0, 0
        if part:
            found.update(zip(part, self.contract(raw)))
        get = lambda w: found.get(w) or self.word_ids[w]
        out = [b"".join(map(get, words)) for words in cut]
        if len(self.word_ids) > MEMO:
            self.word_ids = _short(self.word_ids)
        self.word_ids.update((w, i) for w, i in found.items() if len(w) <= MEMO_LENGTH)
        return out

    def _tidy(self) -> None:
        if len(self.piece_ids) > MEMO:
            self.piece_ids, self.glued = _short(self.piece_ids), set()
        if len(self.first_ids) > MEMO // 8:
            self.first_ids = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as int32 bytes."""
        self._tidy()
        rows = [t.split(" ") for t in texts]
        pieces, firsts, glued = self.piece_ids, self.first_ids, self.glued
        new = set().union(*rows).difference(pieces, glued)
        # a piece that is empty or starts with white space joins what precedes it
        glued.update(p for p in new if not p or p[0].isspace())
        plain = list(new.difference(glued))
        pieces.update(zip(plain, self._learn([" " + p for p in plain])))
        joined = {i: _cut(t) for i, (t, row) in enumerate(zip(texts, rows)) if not glued.isdisjoint(row)}
        exact = {p for i, row in enumerate(rows) for p in joined.get(i, row[:1])}
        new = list(exact.difference(firsts))
        firsts.update(zip(new, self._learn(new)))
        out = [
            b"".join(map(firsts.__getitem__, joined[i])) if i in joined
            else firsts[row[0]] + b"".join(map(pieces.__getitem__, row[1:]))
            for i, row in enumerate(rows)
        ]
        for p in plain:
            if len(p) > MEMO_LENGTH:
                del pieces[p]
        for p in new:
            if len(p) > MEMO_LENGTH:
                del firsts[p]
        return out

    def decode(self, flat: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Bytes of every id list."""
        if len(flat) and (flat.min() < 0 or flat.max() >= self.size):
            raise ValueError("an id is not in the vocabulary")
        self._table("vocabulary", self._vocabulary)
        rows = np.repeat(np.arange(len(lengths), dtype="i4"), lengths)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.con.register("ids", pa.table({"d": rows, "pos": at.astype("i4"), "t": flat}))
        found = self.con.execute(DECODE).fetchall()
        self.con.unregister("ids")
        out = [b""] * len(lengths)
        for d, h in found:
            out[d] = bytes.fromhex(h)
        return out


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a rank file, with what earlier tasks have met."""
    return once_per_worker(f"codec {path} {pattern}", lambda: Codec(path, pattern))


def _encoded(tool: Codec, texts: list[str]) -> pa.Array:
    made = tool.encode(texts)
    offsets = np.cumsum([0, *(len(x) // 4 for x in made)]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), "<i4")))


def _decoded(tool: Codec, ids: pa.Array) -> pa.Array:
    sizes, out = [n or 0 for n in ids.value_lengths().to_pylist()], []
    for a, b in parts(sizes, DECODE_SLICE):
        flat = ids.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype("i4")
        out += tool.decode(flat, np.array(sizes[a:b], "i8"))
    return pa.array(out, pa.binary())


def encode(frame: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``frame`` with the token ids of its texts."""

    def work(column):
        tool, texts = codec(path, pattern), [t or "" for t in column.to_pylist()]
        for a, b in parts([len(t) for t in texts], SLICE):
            yield a, b, _encoded(tool, texts[a:b])

    return carried(frame, text, ids, "array<int>", work)


def decode(frame: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``frame`` with the bytes that its token ids stand for."""

    def work(column):
        tool = codec(path, pattern)
        sizes = [n or 0 for n in column.value_lengths().to_pylist()]
        for a, b in parts(sizes, DECODE_SLICE):
            yield a, b, _decoded(tool, column.slice(a, b - a))

    return carried(frame, ids, out, "binary", work)


def round_trip(
    frame: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``frame`` with the token ids of its texts and the bytes these stand for.

    Both in one pass, so a task has one Python worker with one codec."""

    def work(column):
        tool, texts = codec(path, pattern), [t or "" for t in column.to_pylist()]
        for a, b in parts([len(t) for t in texts], SLICE):
            made = _encoded(tool, texts[a:b])
            yield a, b, pa.StructArray.from_arrays([made, _decoded(tool, made)], ["ids", "decoded"])

    both = fresh(frame, "both")
    made = carried(frame, text, both, "struct<ids: array<int>, decoded: binary>", work)
    return made.withColumns({ids: F.col(f"{both}.ids"), out: F.col(f"{both}.decoded")}).drop(both)


def query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return round_trip(docs, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
