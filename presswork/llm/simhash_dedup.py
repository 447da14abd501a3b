"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into ``segments`` parts, so few that among at
most ``max_bits`` differing bits one part holds at most one. Every fingerprint is
indexed once per bit under that bit's part with the bit cleared (a one-wildcard
variant); fingerprints that meet in an equality join on such a variant are
verified by their Hamming distance inside the join.

Only what decides connectivity is joined. Each bucket first links its members to
four pivots (the ends of two orders), which contracts dense groups in linear work;
afterwards only members outside a bucket's largest component meet the others of it.

Defined results: null text counts as empty; a text without words has fingerprint
zero; repeated rows give repeated result rows; a null id never names a component
unless all ids of it are null; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.llm.common import carried, fresh, in_arrow, saved, text_bytes
from presswork.llm.components import components

#: Hashes whose bits are counted at once (64 bytes each).
BLOCK = 1 << 15


def simhash(text: bytes, width: int = 4, seed: int = 42) -> int:
    """Fingerprint of a UTF-8 text over its word shingles, repeats included."""
    words = text.lower().split()  # of bytes: A-Z, and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n < width:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = np.array(
            [digest(joined[s:e], seed) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])], "<u8"
        )
        bits = np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(doc_id long, fp long) of every row; fp holds the unsigned fingerprint's bits."""

    def work(batches):
        for batch in batches:
            made = np.array([simhash(t, width) for t in text_bytes(batch.column(1))], "u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view("i8"))], ["doc_id", "fp"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return in_arrow(rows, work, "doc_id long, fp long")


def variants(fps: DataFrame, segments: int = 3) -> DataFrame:
    """``fps`` with a row per bit of column fp and its key: the number of the bit
    and the bit's segment of fp with that bit cleared."""
    edges, keys = [round(64 * i / segments) for i in range(segments + 1)], []
    for low, high in zip(edges, edges[1:]):
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for bit in range(low, high):
            # the number of the bit stands above the segment; segments have at most 32 bits
            keys.append(part.bitwiseAND(F.lit(~(1 << (bit - low)))).bitwiseOR(F.lit(bit << 32)))
    return fps.select("*", F.explode(F.array(*keys)).alias("key"))


def _near(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _stars(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """Links (a, b) of bucket members to their bucket's pivots."""
    bucket = Window.partitionBy("key")
    mixed = F.xxhash64("fp")
    pivots = {
        "p0": F.min("fp"), "p1": F.max("fp"), "p2": F.min_by("fp", mixed), "p3": F.max_by("fp", mixed),
    }
    at = variants(fps.select("fp"), segments).select("fp", *[x.over(bucket).alias(n) for n, x in pivots.items()])
    for n in pivots:
        at = at.withColumn(n, F.when((F.col("fp") != F.col(n)) & _near("fp", n, max_bits), F.col(n)))
    at = at.filter(" OR ".join(f"{n} IS NOT NULL" for n in pivots))
    each = F.explode(F.array_compact(F.array(*pivots)))
    return at.select(F.col("fp").alias("a"), each.alias("b")).distinct()


def classes(fps: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(node, label) for every fingerprint of ``fps`` (distinct, column fp) that
    links to another one: label is the smallest fingerprint reachable."""
    if segments < 2 or segments * 2 <= max_bits:
        raise ValueError("some segment of at most 32 bits must differ by at most one bit")
    first = saved(components(_stars(fps, max_bits, segments)), "simhash-first")
    nodes = fps.select("fp").join(first.withColumnRenamed("node", "fp"), "fp", "left")
    placed = variants(nodes.withColumn("label", F.coalesce("label", "fp")), segments)
    bucket, part = Window.partitionBy("key"), Window.partitionBy("key", "label")
    open_ = saved(
        placed.withColumn("n", F.count(F.lit(1)).over(part))
        .withColumn("most", F.max(F.struct("n", "label")).over(bucket)["label"])
        .withColumn("mixed", F.min("label").over(bucket) != F.max("label").over(bucket))
        .filter("mixed").select("key", "fp", "label", "most"),
        "simhash-open",
    )
    few = open_.filter("label <> most").select("key", F.col("fp").alias("fp2"), F.col("label").alias("label2"))
    rest = (
        few.join(
            open_.drop("most"),
            (few.key == open_.key) & (F.col("label") != F.col("label2")) & _near("fp", "fp2", max_bits),
        )
        .select(F.col("label").alias("a"), F.col("label2").alias("b")).distinct()
    )
    second = components(rest).select(F.col("node").alias("label"), F.col("label").alias("_to"))
    second = saved(second, "simhash-second")
    moved = first.join(second, "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
    own = second.select(F.col("label").alias("node"), F.col("_to").alias("label"))
    return saved(moved.unionByName(own).distinct(), "simhash-classes")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4, segments: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id
    that can be reached over links of at most ``max_bits`` differing bits."""
    rows = saved(fingerprints(docs, id, text, width), "simhash-fps")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("_first")), "simhash-nodes")
    linked = classes(nodes.select("fp"), max_bits, segments).withColumnRenamed("node", "fp")
    placed = nodes.join(linked, "fp", "left").select("fp", "_first", F.coalesce("label", "fp").alias("label"))
    names = placed.groupBy("label").agg(F.min("_first").alias("component_id"))
    of = saved(placed.join(names, "label").select("fp", "component_id"), "simhash-names")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4, segments: int = 3
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, nulls last,
    and of rows that share it one of them. Rows are told apart by a number of their
    own, so an id that occurs with several texts loses no group."""
    fp, row = fresh(docs, "fp"), fresh(docs, "row")

    def work(column):
        made = np.array([simhash(t, width) for t in text_bytes(column)], "u8")
        yield 0, len(made), pa.array(made.view("i8"))

    rows = carried(docs, text, fp, "long", work).withColumn(row, F.monotonically_increasing_id())
    rows = saved(rows, "simhash-rows")
    own, words = (F.col("`" + c.replace("`", "``") + "`") for c in (id, text))
    place = F.struct(own.isNull().alias("none"), own.alias("id"), F.xxhash64(words).alias("text"), F.col(row).alias("row"))
    nodes = saved(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(place).alias("best")), "simhash-nodes")
    linked = classes(nodes.select("fp"), max_bits, segments).withColumnRenamed("node", "fp")
    labelled = nodes.join(linked, "fp", "left").select("best", F.coalesce("label", "fp").alias("label"))
    winners = labelled.groupBy("label").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return rows.join(winners, row, "left_semi").drop(fp, row)


def query(spark, folder: str) -> DataFrame:
    from presswork.llm.common import read

    found = near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
