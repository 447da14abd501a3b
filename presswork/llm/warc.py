"""WARC archives with an index, and reads of selected records by coalesced ranges.

write_archives() puts every page into a gzip member of its own and notes file, offset,
length, URL and digest of each record in an index table, which is written before
anything is read. read_records() takes any part of that index, sorts it by file and
offset, reads neighbouring records with one range request and parses them.

Of equal payloads of at least MIN_REVISIT bytes the record with the smallest page id
(nulls last, then URL) is the response and the others are revisits that carry its id,
the digest and the length, not the payload. The choice is a minimum per digest, which
combines before the shuffle; pages join it by digest, and Spark may split hot digests.

Archives lie in the shared folder and are written and read through pyarrow.fs, so its
URI may name any store that pyarrow reaches. A task's files have names of their own:
a repeated task writes new files, and the index lists only those of tasks that counted.

Defined results: null html is an empty payload; small payloads are always responses;
rows that repeat the response's page id and URL are responses too; a null page id or URL
stays null; an empty table gives an empty index. Other columns are not kept.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow, read, saved
from presswork.session import new_run_folder

MIN_REVISIT = 100
#: Bytes after which a task begins a new file; most bytes and largest hole of one read.
ROLL, READ, HOLE = 64 << 20, 8 << 20, 64 << 10
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "file string, offset long, length long, url string, payload_digest string, "
    "page_id long, payload_bytes long, record_type string, refers_to long"
)
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record."""
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}", f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-Id: {refers_to}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """What a record says; its digest and length are checked against its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    _, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].partition(":")[2]
    size = int(fields["X-Payload-Length"])
    if kind == "response":
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError("a payload differs from its digest")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("X-Page-Id"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number("X-Refers-To-Page-Id"), "payload": payload if kind == "response" else None,
    }


def _judged(pages: DataFrame) -> DataFrame:
    """Pages with digest, size, record type and the response's page id."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    large, small = F.length("payload") >= MIN_REVISIT, F.length("payload") < MIN_REVISIT
    order = F.struct(F.col("page_id").isNull().alias("nil"), F.col("page_id"), F.col("url"))
    first = rows.filter(large).groupBy("payload_digest").agg(F.min(order).alias("first"))
    own = F.col("first.page_id").eqNullSafe(F.col("page_id")) & F.col("first.url").eqNullSafe(F.col("url"))
    big = rows.filter(large).join(first, "payload_digest").select(
        "page_id", "url", "payload", "payload_digest", (~own).alias("revisit"),
        F.when(~own, F.col("first.page_id")).alias("refers_to"),
    )
    return big.unionByName(
        rows.filter(small).select("*", F.lit(False).alias("revisit"), F.lit(None).cast("long").alias("refers_to"))
    )


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes all pages below the shared folder and returns the index, a written table."""
    folder = new_run_folder(pages.sparkSession, "warc")

    def work(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, offset, rows = None, "", 0, []

        def finish():
            out.close()
            columns = zip(*rows)
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in INDEX.split(", ")]
            )

        for batch in batches:
            for page_id, url, payload, digest, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, offset, rows = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(record(page_id, url, payload, digest, refers_to, revisit)) + packer.flush()
                out.write(member)
                kind = "revisit" if revisit else "response"
                rows.append((name, offset, len(member), url, digest, page_id, len(payload), kind, refers_to))
                offset += len(member)
                if offset >= ROLL:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    rows = _judged(pages).select("page_id", "url", "payload", "payload_digest", "revisit", "refers_to")
    index = in_arrow(rows, work, INDEX).withColumn("file", F.concat(F.lit(folder + "/"), F.col("file")))
    return saved(index, "warc-index")


def ranges(spans: list[tuple[int, int]], most: int = READ, hole: int = HOLE) -> list[list[int]]:
    """Sorted (offset, length) spans as [start, end, first span, last span + 1] reads."""
    out: list[list[int]] = []
    for i, (offset, length) in enumerate(spans):
        if out and offset - out[-1][1] <= hole and offset + length - out[-1][0] <= most:
            out[-1][1:] = [max(out[-1][1], offset + length), out[-1][2], i + 1]
        else:
            out.append([offset, offset + length, i, i + 1])
    return out


def read_records(index: DataFrame) -> DataFrame:
    """The records of (part of) an index, with payloads; revisits have none."""

    def work(batches):
        held: dict[str, tuple] = {}
        for batch in batches:
            files, offsets, lengths, urls, digests = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                if files[at] not in held:
                    store, path = fs.FileSystem.from_uri(files[at])
                    held = {files[at]: (store, path)}
                store, path = held[files[at]]
                with store.open_input_file(path) as source:
                    for start, stop, a, b in ranges(list(zip(offsets[at:end], lengths[at:end]))):
                        raw, made = source.read_at(stop - start, start), []
                        for i in range(at + a, at + b):
                            skip = offsets[i] - start
                            found = parsed(zlib.decompress(raw[skip : skip + lengths[i]], 31))
                            if found["payload_digest"] != digests[i]:
                                raise ValueError("a record differs from its index entry")
                            made.append({"url": urls[i], **found})
                        yield pa.RecordBatch.from_pylist(made, schema)
                at = end

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in RECORD.split(", "))])
    block = F.floor(F.col("offset") / READ)
    rows = (
        index.select("file", "offset", "length", "url", "payload_digest", block.alias("block"))
        .repartition("file", "block").sortWithinPartitions("file", "offset").drop("block")
    )
    return in_arrow(rows, work, RECORD)


def query(spark, folder: str) -> DataFrame:
    index = write_archives(read(spark, folder, "pages").select("page_id", "url", "html"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


SQL = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY digest)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, url
FROM p LEFT JOIN f ON p.digest = f.digest AND size >= 100
"""
