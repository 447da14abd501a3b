"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text's pieces (single sentences of one paragraph, numbered when they repeat) are
hashed to 64-bit digests. No piece depends on what stands before it. A sketch has three rows of ``width`` cells; every digest
enters one cell of each row with its count, digest and check sum. Sketches are sparse
cell tables, made by one aggregation that also subtracts the sketches of two texts
(counts of the second text are negative, equal digests cancel). Peeling takes out the
digests that stand alone in a cell, again and again, until no cell is left: the
digests that only one text has. The first sketch of a pair is wide and its first
peeling step is one more aggregation, which empties nearly every sketch (the digests
taken out must add up to all cells of a row). The other pairs get a larger sketch with
other hash values and are peeled to the end, again larger if cells stay full.

A fingerprint is the sketch of BASE cells a row. likeness = common / all digests
(Jaccard) with the digests that peeling recovered.

The aggregations run on the partitions that the join of the texts left, so exploded
digests are never shuffled in the main pass.

Defined results: null texts count as empty; a text without pieces has the empty
fingerprint; two such texts are alike (1.0); a null id counts as the smallest; rows of
the same id and text are one document and get the same result; an empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.binding import let
from presswork.llm.common import read, saved

#: A sentence of a paragraph without the white space before it; marks that follow no word are one too.
PIECE = r"[^ \t\r\n.!?][^.!?\n]*[.!?]*|[.!?]+"
#: Cells in a row of a fingerprint; least cells and cells per digest in a row of a pair's first sketch.
BASE, LEAST, PER_DIGEST = 4, 256, 32
#: Peeling steps before a sketch counts as too small.
STEPS = 12
SMALLEST = -(1 << 63)


def digests(text: Column) -> Column:
    """Digests of a text's pieces; equal pieces differ by their number."""
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    hashed = F.array_sort(F.transform(pieces, lambda p: F.xxhash64(p)))
    return let(hashed, lambda xs: F.transform(
        xs, lambda x, i: F.xxhash64(x, (i - F.array_position(xs, x)).cast("int"))
    ))


def width(digests: Column, rung: int) -> Column:
    """Cells in a row for a pair of so many digests: a power of two."""
    wanted = F.greatest(digests * PER_DIGEST, F.lit(LEAST)) * (1 << rung)
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(wanted)).cast("int"))


def _check(k: Column) -> Column:
    return F.hash(k, F.lit(-7))


def _cell(k: Column, row: Column, wide: Column, rung: int) -> Column:
    """The cell of a digest in one of the three rows."""
    return row * wide + F.pmod(F.xxhash64(k, row, F.lit(rung)), wide)


def sketches(items: DataFrame, keys: list[str], rung: int) -> DataFrame:
    """(keys, kind, wide, cell, c, k, h) from rows (keys, kind, wide, sign, k): the
    cells of every kind of sketch that are not empty."""
    rows = items.select("*", F.explode(F.array(*[F.lit(i).cast("long") for i in range(3)])).alias("row"))
    # kind (two bits), wide (its power of two, six bits) and cell are one number, as cells are held by the million
    cell = _cell(F.col("k"), F.col("row"), F.col("wide"), rung)
    place = cell * 256 + F.bit_count(F.col("wide") - 1) * 4 + F.col("kind")
    made = rows.groupBy(*keys, place.alias("place")).agg(
        F.sum("sign").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor(_check(F.col("k"))).alias("h")
    ).filter("c <> 0 OR k <> 0 OR h <> 0 OR place IS NULL")
    power = F.shiftright("place", 2).bitwiseAND(63).cast("int")
    return made.select(
        *keys, F.col("place").bitwiseAND(3).cast("int").alias("kind"),
        F.call_function("shiftleft", F.lit(1).cast("long"), power).alias("wide"),
        F.shiftright("place", 8).alias("cell"), "c", "k", "h",
    )


def alone(cell) -> Column:
    """Whether one digest stands alone in a cell (c, k, h)."""
    return (F.abs(cell("c")) == 1) & (_check(cell("k")) == cell("h"))


def _less(cell: Column, out: Column) -> Column:
    """A cell without a digest that was taken out (c and k of its lone cell)."""
    return F.struct(
        cell["cell"].alias("cell"), (cell["c"] - out["c"]).alias("c"), cell["k"].bitwiseXOR(out["k"]).alias("k"),
        cell["h"].bitwiseXOR(_check(out["k"])).alias("h"),
    )


def peeled(cells: Column, wide: Column, rung: int) -> Column:
    """struct(ok, n): whether all cells were emptied, and by how many digests."""
    is_alone = lambda cell: alone(cell.getField)

    def step(state: Column, _: Column) -> Column:
        lone = F.array_distinct(F.transform(F.filter(state["cells"], is_alone), lambda c: F.struct(c["c"], c["k"])))

        def go(out: Column) -> Column:
            left = F.transform(
                F.filter(state["cells"], lambda c: ~is_alone(c)),
                lambda c: F.aggregate(
                    F.filter(out, lambda x: _cell(x["k"], F.floor(c["cell"] / wide), wide, rung) == c["cell"]), c, _less
                ),
            )
            full = F.filter(left, lambda c: (c["c"] != 0) | (c["k"] != 0) | (c["h"] != 0))
            return F.when(F.size(out) == 0, state).otherwise(
                F.struct(full.alias("cells"), (state["n"] + F.size(out)).alias("n"))
            )

        return let(lone, go)

    start = F.struct(cells.alias("cells"), F.lit(0).cast("long").alias("n"))
    end = F.aggregate(F.array(*[F.lit(i) for i in range(STEPS)]), start, step)
    return let(end, lambda x: F.struct((F.size(x["cells"]) == 0).alias("ok"), x["n"].alias("n")))


def fingerprint(cells: Column) -> Column:
    """A sketch as text: cell, count and, in hex, digest and check sum."""
    return F.array_join(F.transform(F.array_sort(cells), lambda c: F.concat_ws(
        ".", c["cell"].cast("string"), c["c"].cast("string"), F.lower(F.hex(c["k"])),
        F.lower(F.hex(c["h"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))),
    )), " ")


def following(keys: DataFrame) -> DataFrame:
    """(id, mark, copies, next_id, next_mark): the next smaller distinct key of each
    and its rows; after the smallest the largest. Keys are numbered inside ranges, and only the first
    key of each range meets those of the others."""
    down = [F.desc("id"), F.desc("mark")]
    ranges = saved(
        keys.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("copies")).repartitionByRange(*down).withColumn("part", F.spark_partition_id()), "iblt-ranges"
    )
    inside = Window.partitionBy("part").orderBy(*down)
    key = F.struct("id", "mark")
    firsts = ranges.groupBy("part").agg(F.max(key).alias("first"))
    order = Window.orderBy("part")
    after = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(order), F.first("first").over(order.rowsBetween(Window.unboundedPreceding, 0))
        ).alias("later"),
    )
    placed = ranges.withColumn("next", F.lead(key).over(inside)).join(after, "part")
    chosen = F.coalesce("next", "later")
    return placed.select("id", "mark", "copies", chosen["id"].alias("next_id"), chosen["mark"].alias("next_mark"))


def _documents(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, mark, text) of every row; a document is (id, mark)."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.select(F.coalesce("id", F.lit(SMALLEST)).alias("id"), F.xxhash64("text").alias("mark"), "text")


def edited_pairs(rows: DataFrame, order: DataFrame) -> DataFrame:
    """Each distinct document with its edited text's SHA-256 (bytes) and three digest lists:
    its own, the edited text's and the next document's."""
    base = rows.groupBy("id", "mark").agg(F.first("text").alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    mine = base.join(order, ["id", "mark"]).select(
        "next_id", "next_mark", "id", "mark", "copies", n.cast("long").alias("n_chars"), half.alias("half"),
        F.substring("text", F.lit(1), n - half).alias("head"), digests(F.col("text")).alias("own"),
    )
    others = base.select(
        F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("text").alias("other"),
    )
    edited = F.concat("head", F.substring("other", F.lit(1), F.col("half")))
    return (
        mine.join(others, ["next_id", "next_mark"])
        .select("*", edited.alias("text_edited"), digests(F.col("other")).alias("after")).drop("head", "other", "half")
        .withColumn("edited", digests(F.col("text_edited")))
        .withColumn("edited_sha256", F.unhex(F.sha2(F.col("text_edited").cast("binary"), 256)))
        .drop("text_edited")
    )


#: The next document names a pair, as each has one before it; facts stand on one row of a pair only, so cells are narrow.
KEYS = ["next_id", "next_mark", "facts"]
PAIR = KEYS[:2]
FACTS = ["id", "mark", "copies", "n_chars", "edited_sha256", "n_own", "n_edited", "n_after"]


def _items(pairs: DataFrame, rung: int, prints: bool) -> DataFrame:
    """(KEYS, kind, wide, sign, k): the digests of both pairs (kinds 0 and 1: edited,
    next) and, if asked for, of the two fingerprints (kinds 2 and 3); one row of a pair
    has its facts and no kind."""
    lists = ["own", "edited", "own", "after", *(["own", "edited"] if prints else [])]
    sized = pairs.select(
        "*", *[F.size(c).cast("long").alias(f"n_{c}") for c in ("own", "edited", "after")]
    ).select("*", F.posexplode(F.concat(F.array(F.lit(None).cast("long")), *lists)).alias("pos", "k"))
    ends, at = [], F.lit(1)
    for c in lists:
        at = at + F.col(f"n_{c}")
        ends.append(at)
    pos = F.col("pos")
    kind = F.when(pos == 0, None).when(pos < ends[1], 0).when(pos < ends[3], 1)
    if prints:
        kind = kind.when(pos < ends[4], 2).when(pos < ends[5], 3)
    second = ((pos >= ends[0]) & (pos < ends[1])) | ((pos >= ends[2]) & (pos < ends[3]))
    wide = F.when(pos < ends[1], width(F.col("n_own") + F.col("n_edited"), rung)).when(
        pos < ends[3], width(F.col("n_own") + F.col("n_after"), rung)
    ).otherwise(F.lit(BASE).cast("long"))
    facts = F.when(pos == 0, F.struct(*FACTS))
    return sized.select(*PAIR, facts.alias("facts"), kind.alias("kind"), wide.alias("wide"), F.when(second, -1).otherwise(1).alias("sign"), "k")


def _found(pairs: DataFrame) -> DataFrame:
    """Per document: what the first peeling step says about both pairs (ok: nothing is
    left, n: digests taken out), and the fingerprints."""
    cells = sketches(_items(pairs, 0, True), KEYS, 0)
    # kinds 0 and 1 by the digest that is taken out, kinds 2 and 3 by cell
    group = F.when(F.col("kind") >= 2, F.col("cell")).when(alone(F.col), F.col("k"))
    first = (F.col("kind") >= 2) | (F.col("cell") < F.col("wide"))
    taken = cells.groupBy(*KEYS, "kind", group.alias("g")).agg(
        F.bit_xor(F.when(first, F.col("k"))).alias("k"), F.bit_xor(F.when(first, F.col("h"))).alias("h"),
        F.sum(F.when(first, F.col("c"))).alias("c"),
    )
    g = F.col("g")
    summed = taken.groupBy(*KEYS, "kind", F.when(F.col("kind") >= 2, g).alias("cell")).agg(
        F.count("g").alias("n"), F.bit_xor(g).alias("out_k"), F.bit_xor(F.when(g.isNotNull(), _check(g))).alias("out_h"),
        F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.sum("c").alias("c"),
    )
    ok = (F.coalesce("out_k", F.lit(0)) == F.coalesce("k", F.lit(0))) & (
        F.coalesce("out_h", F.lit(0)) == F.coalesce("h", F.lit(0))
    )
    kind = lambda x: F.col("kind") == x
    none = F.struct(F.lit(True).alias("ok"), F.lit(0).cast("long").alias("n"))  # equal texts leave no cell
    peel = F.struct(ok.alias("ok"), F.col("n").alias("n"))
    cell = F.struct("cell", "c", "k", "h")
    return summed.groupBy(*PAIR).agg(
        F.first("facts", True).alias("facts"), F.coalesce(F.max(F.when(kind(0), peel)), none).alias("with_edited"),
        F.coalesce(F.max(F.when(kind(1), peel)), none).alias("with_next"),
        fingerprint(F.collect_list(F.when(kind(2), cell))).alias("fingerprint"),
        fingerprint(F.collect_list(F.when(kind(3), cell))).alias("edited_fingerprint"),
    ).select(*PAIR, "facts.*", "with_edited", "with_next", "fingerprint", "edited_fingerprint")


def _retried(pairs: DataFrame, rung: int) -> DataFrame:
    """Per document: what a larger sketch, peeled to the end, says about both pairs."""
    each = sketches(_items(pairs, rung, False), KEYS, rung).groupBy(*KEYS, "kind", "wide").agg(
        F.collect_list(F.struct("cell", "c", "k", "h")).alias("cells")
    )
    each = each.withColumn("peel", peeled(F.col("cells"), F.col("wide"), rung))
    none = F.struct(F.lit(True).alias("ok"), F.lit(0).cast("long").alias("n"))
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("peel")))
    return each.groupBy(*PAIR).agg(
        F.first("facts", True).alias("facts"), F.coalesce(of(0), none).alias("with_edited"),
        F.coalesce(of(1), none).alias("with_next"),
    ).select(*PAIR, "facts.*", "with_edited", "with_next")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row."""
    rows = _documents(docs, id, text)
    order = saved(following(rows.select("id", "mark")), "iblt-order")
    done = saved(_found(edited_pairs(rows, order)), "iblt-found")
    key, out, rung = ["id", "mark"], None, 0
    while True:
        good = done.filter("with_edited.ok AND with_next.ok")
        out = good if out is None else out.unionByName(good)
        failed = saved(done.filter("NOT (with_edited.ok AND with_next.ok)"), "iblt-failed")
        if failed.isEmpty():
            break
        # a few pairs with two digests in the same three cells: larger, and hashed anew
        rung += 1
        again = order.join(failed.select(*key), key, "left_semi")
        wanted = saved(
            failed.select(*key).union(failed.select("next_id", "next_mark")).distinct(), "iblt-wanted"
        )
        pairs = edited_pairs(rows.join(wanted, key, "left_semi"), again)
        prints = failed.select(*key, "fingerprint", "edited_fingerprint")
        done = saved(_retried(pairs, rung).join(prints, key), "iblt-found").select(done.columns)
    either = lambda other, peel: F.when(F.col("n_own") + F.col(other) == 0, 1.0).otherwise(
        (F.col("n_own") + F.col(other) - F.col(peel)["n"]) / (F.col("n_own") + F.col(other) + F.col(peel)["n"])
    )
    return out.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(
        F.nullif("id", F.lit(SMALLEST)).alias("doc_id"), "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", either("n_edited", "with_edited").alias("near_edited"),
        either("n_after", "with_next").alias("near_next"),
    )


def query(spark, folder: str) -> DataFrame:
    return fingerprints(read(spark, folder, "documents").select("doc_id", "text"))
