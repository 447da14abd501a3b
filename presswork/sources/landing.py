"""Content-addressed landing tables and their layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.operators.ordering import first_per_key


def _hive(**parts: Column) -> Column:
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in parts.items()])


def feed_payload_uri(source_id: Column, feed_id: Column, day: Column, run: Column) -> Column:
    return F.concat_ws(
        "/", F.lit("landing/feeds"),
        _hive(source_id=source_id, ingest_date=day, feed_id=feed_id, run_id=run),
    )


def article_payload_uri(
    source_id: Column, day: Column, article: Column, document: Column
) -> Column:
    return F.concat_ws(
        "/", F.lit("landing/articles"),
        _hive(source_id=source_id, ingest_date=day, article_id=article,
              source_document_id=document),
    )


def extracted_payload_uri(
    source_id: Column, day: Column, article: Column, document: Column, payload_hash: Column
) -> Column:
    return F.concat_ws(
        "/", F.lit("landing/extracted"),
        _hive(source_id=source_id, ingest_date=day, article_id=article,
              source_document_id=document, extracted_payload_hash=payload_hash),
    )


def feed_checkpoint_uri(source_id: Column, feed_id: Column) -> Column:
    return F.concat_ws("/", F.lit("checkpoints/feeds"), _hive(source_id=source_id, feed_id=feed_id))


def fetch_checkpoint_uri(article: Column, revision: Column) -> Column:
    return F.concat_ws(
        "/", F.lit("checkpoints/fetches"), _hive(article_id=article, request_revision=revision)
    )


def absent_payloads(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """Incoming payloads whose address holds nothing yet, one row per address.

    What has landed goes first, so that only new payload bytes are sorted; both steps
    are keyed by the address and share one exchange.
    """
    new = incoming.join(landed.select("payload_uri"), "payload_uri", "left_anti")
    return first_per_key(new, ["payload_uri"], ["content_hash"])


def write_if_absent(incoming: DataFrame, folder: str, days: list[str] | None = None) -> None:
    """Appends absent payloads to the landing table, zstd-compressed and
    partitioned by source and day.

    Addresses carry their day. A caller that knows the days of its payloads
    names them, and only those partitions are read; of them, only the addresses.
    """
    spark = incoming.sparkSession
    try:
        landed = spark.read.schema(
            "payload_uri string, source_id string, ingest_date string"
        ).parquet(folder)
        if days is not None:
            landed = landed.filter(F.col("ingest_date").isin(days))
        fresh = absent_payloads(incoming, landed)
    except Exception as error:  # first write: the table does not exist yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        fresh = first_per_key(incoming, ["payload_uri"], ["content_hash"])
    (
        fresh.write.mode("append").partitionBy("source_id", "ingest_date")
        .option("compression", "zstd").parquet(folder)
    )


def read_verified(requests: DataFrame, landed: DataFrame) -> DataFrame:
    """Requests with their payload and the verdict of the hash check.

    requests: payload_uri, content_hash (what the event claims).
    landed: payload_uri, payload.
    """
    found = requests.join(landed.select("payload_uri", "payload"), "payload_uri", "left")
    return found.withColumn(
        "verdict",
        F.when(F.col("payload").isNull(), F.lit("missing_payload"))
        .when(F.sha2("payload", 256) != F.col("content_hash"), F.lit("hash_mismatch")),
    )
