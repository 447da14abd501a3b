"""Reads of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Session setting: partitions to deal heavy scans out to.
SPREAD = "spark.presswork.spread"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for work that is heavy per row.

    A session may ask for small tables to be dealt out (SPREAD), as local ones do,
    whose tables are one row group; elsewhere a scan is just a scan.
    """
    scan, parts = table(spark, folder, name), spark.conf.get(SPREAD, None)
    return scan.repartition(int(parts)) if parts else scan


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table, one file or a folder of part files, as a file stream."""
    # the pattern matches the table's own path only, whatever kind it is
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(
        f"{folder.rstrip('/')}/[{name[0]}]{name[1:]}.parquet"
    )


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    return stream_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """events with a zoned event time, which watermarks need."""
    return spread_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
