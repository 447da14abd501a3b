"""Token counts that follow edits: a segment tree of pre-token pieces per document.

A text is cut before every space that a non-space follows; the pre-token pattern never
matches across such a place, whatever stands around it, so the pieces' counts add up.
A tree holds the pieces' lengths and token counts in blocks, and the sums of blocks in
two segment trees. An edit finds its pieces by their offsets, re-encodes only the pieces
it touches (with the one before, whose last cut it may undo) and updates the sums on
the way up.

Documents and their edits meet by one shuffle on the id, sorted so that each document
precedes its edits: a task holds the tree of the current document and streams its edits,
however many they are.

Defined results: null texts and inserts count as empty; null or outlying positions and
lengths are clamped to the text; edits of unknown or null ids are ignored; documents of
one id are edited alike; rows of the same id and text give repeated rows; an empty table
gives an empty result; other columns are not kept.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow, read

#: Pieces in a block when a tree is built.
BLOCK = 64
#: Memoised pieces before the memo is emptied; longer ones are not kept.
MEMO, MEMO_LENGTH = 300_000, 64

cut = re.compile(r"(?= \S)").split

RESULT = "doc_id long, n_tokens_before long, n_tokens long, n_chars long, n_recounted long, n_edits long"
TREE = "pieces array<struct<chars:int,tokens:int>>"


class Counter:
    """Token counts of pieces by a rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memo: dict[str, int] = {}

    def __call__(self, pieces: list[str]) -> list[int]:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        out = list(map(memo.get, pieces))
        for i, n in enumerate(out):
            if n is None:
                piece = pieces[i]
                n = out[i] = memo.get(piece) or len(self.encode(piece))
                if len(piece) <= MEMO_LENGTH:
                    memo[piece] = n
        return out


_counters: dict[tuple[str, str], Counter] = {}


def counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _counters:
        _counters[path, pattern] = Counter(path, pattern)
    return _counters[path, pattern]


class PieceTree:
    """A text with the token counts of its pieces under segment trees."""

    def __init__(self, text: str, count: Counter) -> None:
        self.text, self.count, self.recounted = text, count, 0
        pieces = [p for p in cut(text) if p]
        self._build(list(map(len, pieces)), count(pieces))

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.blocks = [
            (chars[i : i + BLOCK], tokens[i : i + BLOCK]) for i in range(0, max(1, len(chars)), BLOCK)
        ]
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        for sums, side in ((self.chars, 0), (self.tokens, 1)):
            sums[self.size : self.size + len(self.blocks)] = [sum(b[side]) for b in self.blocks]
            level = self.size
            while level > 1:
                sums[level // 2 : level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
                level //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def pieces(self) -> list[tuple[int, int]]:
        return [x for b in self.blocks for x in zip(*b)]

    def find(self, at: int) -> tuple[int, int, int]:
        """Block, piece and offset of the piece that holds the character at ``at``."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at >= start + self.chars[node]:
                start += int(self.chars[node])
                node += 1
        block = node - self.size
        for i, n in enumerate(self.blocks[block][0]):
            if at < start + n:
                return block, i, start
            start += n
        raise IndexError(at)

    def _update(self, block: int) -> None:
        node = self.size + block
        self.chars[node], self.tokens[node] = map(sum, self.blocks[block])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int | None, removed: int | None, insert: str | None) -> None:
        """Replaces ``removed`` characters at ``start`` by ``insert``."""
        n, insert = len(self.text), insert or ""
        start = min(max(start or 0, 0), n)
        end = min(start + max(removed or 0, 0), n)
        if start == end and not insert:
            return
        if not n:
            self.__init__(insert, self.count)
            self.recounted = len(insert)
            return
        first, i, low = self.find(min(max(start - 2, 0), n - 1))
        last, j, high = self.find(min(max(end - 1, low), n - 1))
        high += self.blocks[last][0][j]
        region = self.text[low:start] + insert + self.text[end:high]
        self.text = self.text[:start] + insert + self.text[end:]
        pieces = [p for p in cut(region) if p]
        self.recounted += len(region)
        new = (list(map(len, pieces)), self.count(pieces))
        tail = tuple(x[j + 1 :] for x in self.blocks[last])
        for b in range(first + 1, last + 1):
            self.blocks[b] = ([], [])
        self.blocks[first] = tuple(x[:i] + y + z for x, y, z in zip(self.blocks[first], new, tail))
        if len(self.blocks[first][0]) > 8 * BLOCK:
            self._build(*map(list, zip(*self.pieces())))
            return
        for b in range(first, last + 1):
            self._update(b)


def recount(
    docs: DataFrame, edits: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text",
    keep_trees: bool = False,
) -> DataFrame:
    """Token counts before and after the edits (doc_id, seq, start, removed, insert),
    applied in order of seq; positions refer to the text that earlier edits left.
    With ``keep_trees`` also the edited text and its pieces."""
    own = F.col(id).cast("long")
    rows = docs.select(
        own.alias("id"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("removed"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    changes = edits.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), F.lit(1).alias("kind"), F.col("seq").cast("long").alias("seq"),
        F.col("start").cast("long").alias("start"), F.col("removed").cast("long").alias("removed"),
        F.col("insert").cast("string").alias("text"),
    )
    # rows without an id would meet in one task; they have no edits, so any task will do
    spread = F.coalesce("id", F.xxhash64("text"))
    ordered = (
        rows.unionByName(changes).withColumn("spread", spread).repartition("spread")
        .sortWithinPartitions("spread", "id", "kind", "seq", "start", "removed", "text").drop("spread")
    )
    names = [x.split()[0] for x in RESULT.split(", ")]

    def work(batches):
        count = counter(path, pattern)
        now, held, edited = None, {}, 0

        def finished():
            made = []
            for tree, before, copies in held.values():
                row = {
                    "doc_id": now, "n_tokens_before": before, "n_tokens": tree.total, "n_chars": len(tree.text),
                    "n_recounted": tree.recounted, "n_edits": edited,
                }
                if keep_trees:
                    row |= {"text": tree.text, "pieces": [{"chars": c, "tokens": t} for c, t in tree.pieces()]}
                made += [row] * copies
            return made

        out = []
        for batch in batches:
            for own, kind, start, removed, body in zip(*(batch.column(c).to_pylist() for c in ("id", "kind", "start", "removed", "text"))):
                if own != now or own is None:
                    out += finished()
                    now, held, edited = own, {}, 0
                if kind == 0:
                    if body in held:
                        tree, before, copies = held[body]
                        held[body] = (tree, before, copies + 1)
                    else:
                        tree = PieceTree(body, count)
                        held[body] = (tree, tree.total, 1)
                else:
                    edited += 1
                    for tree, _, _ in held.values():
                        tree.edit(start, removed, body)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        out += finished()
        yield pa.RecordBatch.from_pylist(out, schema)

    fields = [(n, pa.int64()) for n in names]
    if keep_trees:
        piece = pa.struct([("chars", pa.int32()), ("tokens", pa.int32())])
        fields += [("text", pa.string()), ("pieces", pa.list_(piece))]
    schema = pa.schema(fields)
    return in_arrow(ordered, work, RESULT + (f", text string, {TREE}" if keep_trees else ""))


def sample_edits(docs: DataFrame) -> DataFrame:
    """Three edits of every document: its opening again in the middle, a cut in the
    first half, its source at the front."""
    n = F.length("text")
    each = F.array(*[
        F.struct(
            F.lit(seq).alias("seq"), F.floor(start).cast("long").alias("start"), F.floor(removed).cast("long").alias("removed"),
            insert.alias("insert"),
        )
        for seq, start, removed, insert in (
            (1, n / 2, F.lit(0), F.substring("text", 1, 40)), (2, n / 4, F.least(F.lit(60), n / 8), F.lit("")),
            (3, F.lit(0), F.lit(0), F.concat("source", F.lit(" "))),
        )
    ])
    return docs.filter("text IS NOT NULL").select("doc_id", F.inline(each))


def query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return recount(docs, sample_edits(docs), path, public_tokenizers.PATTERN)
