"""Operational metrics: counts, sums, source alarms and consumer lag.

All counters of a flush window come from one pass: every record becomes one
observation, and a single pre-aggregating groupBy reduces them. Points, alarms
and batches are built from that small result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions.binding import literal_map
from presswork.functions.dims import (
    clean_dimension,
    clean_dimensions,
    dimension_entries,
    entries_json,
    override,
)
from presswork.operators.ordering import number_rows

# Names under which observed metrics are published.
METRIC_NAMES = {
    "article_fetch_retry_count": "ArticleFetchRetryCount",
    "consumer_retry_count": "ConsumerRetryCount",
}
FETCH_SUCCESS = "ArticleFetchSuccessCount"
EXTRACTION_SUCCESS = "ArticleExtractionSuccessCount"
REJECTED = "ArticleRejectedCount"
DLQ_EVENTS = "DlqEventCount"
SOURCE_FAILURE = "SourceExtractionFailure"
GROUP_LAG = "ConsumerGroupLag"
GROUP_LAG_TOTAL = "ConsumerGroupLagTotal"

METRIC_BATCH = 50
MIN_REJECTIONS = 3

_COUNT_KEYS = ["window", "family", "name", "unit", "source_id", "stage", "entries"]


def flush_window(ts: Column, interval: str = "1 day") -> Column:
    return F.window(ts, interval)


def rename_metrics(observed: DataFrame) -> DataFrame:
    """Keeps the metrics that are published and gives them their public name."""
    names = literal_map(METRIC_NAMES.items())
    return observed.withColumn("metric_name", F.try_element_at(names, "metric_name")).filter(
        F.col("metric_name").isNotNull()
    )


def observations(records: DataFrame) -> DataFrame:
    """One row per record that counts, with the key it is counted under.

    ``records``: window struct, topic_key, source_id, stage, error_class,
    service, metric_name, metric_value, metric_unit, dimensions map. Columns
    that do not apply to a topic may be null.
    """
    topic = F.col("topic_key")
    names = literal_map(METRIC_NAMES.items())
    observed_name = F.try_element_at(names, "metric_name")
    is_dlq, is_metric = topic == "dlq", topic == "pipeline_metric"
    family = (
        F.when(topic == "article_fetched", 1)
        .when(topic == "article_extracted", 2)
        .when(is_dlq, 3)
        .when(is_metric & observed_name.isNotNull(), 5)
    )
    by_source = dimension_entries(sourceId=F.col("source_id"))
    by_failure = dimension_entries(
        sourceId=F.col("source_id"),
        stage=F.col("stage"),
        errorClass=clean_dimension(F.col("error_class")),
    )
    merged = override(
        F.create_map(F.lit("service"), F.col("service")),
        F.coalesce(F.col("dimensions"), F.create_map().cast("map<string,string>")),
    )
    return records.filter(family.isNotNull()).select(
        "window",
        family.alias("family"),
        F.when(topic == "article_fetched", FETCH_SUCCESS)
        .when(topic == "article_extracted", EXTRACTION_SUCCESS)
        .when(is_dlq, REJECTED)
        .otherwise(observed_name)
        .alias("name"),
        F.when(is_metric, F.col("metric_unit")).otherwise("count").alias("unit"),
        F.when(~is_metric, F.col("source_id")).otherwise("").alias("source_id"),
        F.when(is_dlq, F.col("stage")).otherwise("").alias("stage"),
        F.when(is_dlq, by_failure)
        .when(is_metric, clean_dimensions(merged))
        .otherwise(by_source)
        .alias("entries"),
        F.when(is_metric, F.col("metric_value").cast("double")).alias("amount"),
    )


#: Powers of two that one bin of an exact sum spans, and those the bins' mantissas carry.
BIN, MANTISSA = 6, 52


def _pow2(n: Column) -> Column:
    return F.pow(F.lit(2.0), n.cast("double"))


def _bin(amount: Column) -> Column:
    """The bin of a finite amount by its exponent; one below where that is in doubt."""
    return F.when(
        ~F.isnan(amount) & (F.abs(amount) > 0) & (F.abs(amount) < float("inf")),
        F.floor((F.floor(F.log2(F.abs(amount))) - 1) / BIN).cast("int"),
    )


def _mantissa(amount: Column, bin_: Column) -> Column:
    """A finite amount as a whole number of its bin's unit, 2 ** (BIN * bin - MANTISSA).

    Scaling by powers of two loses nothing; it is done in two steps, as the power of the
    smallest amounts is no double."""
    shift = F.lit(MANTISSA) - bin_ * BIN
    half = F.floor(shift / 2)
    return (amount * _pow2(half) * _pow2(shift - half)).cast("bigint")


@F.arrow_udf(T.DoubleType())
def _folded(bins: pa.Array, plain: pa.Array) -> pa.Array:
    """The sums of all bins and a count as one double, rounded once."""
    low = 1200  # below the unit of the lowest bin

    def fold(parts, count):
        total = sum((int(p["sum"]) << (BIN * p["bin"] - MANTISSA + low) for p in parts or []), count << low)
        try:
            return total / (1 << low)
        except OverflowError:
            return float("inf") if total > 0 else float("-inf")

    return pa.array([fold(*row) for row in zip(bins.to_pylist(), plain.to_pylist())], pa.float64())


def metric_counts(records: DataFrame) -> DataFrame:
    """Counters of every flush window (see _COUNT_KEYS) with their total.

    Records without an amount count as one. Amounts are added exactly, whatever their
    size and order: as whole numbers per bin of exponents, and the bins of a counter are
    folded and rounded once. Amounts that are no finite numbers are added as they are.
    Works on streams too: give the event time a watermark before its window is
    taken, and closed windows come out in append mode.
    """
    seen = observations(records).withColumn("bin", _bin(F.col("amount")))
    stray = F.isnan("amount") | (F.abs("amount") == float("inf"))
    binned = seen.groupBy(*_COUNT_KEYS, "bin").agg(
        F.count_if(F.col("amount").isNull()).alias("plain"),
        F.sum(F.when(F.col("bin").isNotNull(), _mantissa(F.col("amount"), F.col("bin"))).cast("decimal(20,0)")).alias("sum"),
        F.sum(F.when(stray, F.col("amount"))).alias("stray"),
    )
    filled = F.when(F.col("bin").isNotNull(), F.struct("bin", "sum"))
    whole = binned.groupBy(*_COUNT_KEYS).agg(
        F.sum("plain").alias("plain"), F.collect_list(filled).alias("bins"), F.sum("stray").alias("stray")
    )
    value = F.when(F.col("stray").isNotNull(), F.col("stray")).when(
        F.size("bins") == 0, F.col("plain").cast("double")
    ).otherwise(_folded(F.col("bins"), F.col("plain")))
    return whole.select(F.col("window.start").alias("window_start"), *_COUNT_KEYS[1:], value.alias("value"))


def _point(frame: DataFrame, family: Column, name: Column) -> DataFrame:
    return frame.select(
        "window_start", family.cast("int").alias("family"), name.alias("name"), "value", "unit",
        "entries", entries_json(F.col("entries")).alias("dimensions"),
    )


def count_points(counts: DataFrame, *families: int) -> DataFrame:
    """Points of the chosen families; rejects (3) show up again as DLQ events (4)."""
    both = F.array(
        F.struct(F.lit(3).alias("f"), F.lit(REJECTED).alias("n")),
        F.struct(F.lit(4).alias("f"), F.lit(DLQ_EVENTS).alias("n")),
    )
    own = F.array(F.struct(F.col("family").alias("f"), F.col("name").alias("n")))
    out = counts.filter(F.col("family").isin(*families)).withColumn(
        "as", F.explode(F.when(F.col("family") == 3, both).otherwise(own))
    )
    return _point(out, F.col("as.f"), F.col("as.n"))


def failing_sources(counts: DataFrame, min_rejections: int = MIN_REJECTIONS) -> DataFrame:
    """Sources with enough extraction rejects and no extraction at all.

    The conditions sit inside the sums, not in a filter before them: the counts
    then come from the same shuffle as the other points, not from a second scan.
    """
    rejects = F.sum(
        F.when(
            (F.col("family") == 3) & (F.col("source_id") != "unknown")
            & F.col("stage").startswith("article_extract"),
            F.col("value"),
        )
    )
    successes = F.sum(F.when(F.col("family") == 2, F.col("value")).otherwise(0))
    return (
        counts.groupBy("window_start", "source_id")
        .agg(rejects.alias("rejects"), successes.alias("successes"))
        .filter((F.col("rejects") >= min_rejections) & (F.col("successes") == 0))
        .select("window_start", "source_id", F.col("rejects").cast("bigint").alias("rejects"))
    )


def failure_points(counts: DataFrame, min_rejections: int = MIN_REJECTIONS) -> DataFrame:
    alarms = failing_sources(counts, min_rejections).select(
        "window_start", F.lit(1.0).alias("value"), F.lit("count").alias("unit"),
        dimension_entries(sourceId=F.col("source_id")).alias("entries"),
    )
    return _point(alarms, F.lit(6), F.lit(SOURCE_FAILURE))


def points_from_counts(counts: DataFrame, min_rejections: int = MIN_REJECTIONS) -> DataFrame:
    return count_points(counts, 1, 2, 3, 5).unionByName(failure_points(counts, min_rejections))


def consumer_lag(committed: DataFrame, latest: DataFrame) -> DataFrame:
    """Lag per (group, topic, partition); never-committed partitions and
    partitions without a known end are left out."""
    return (
        committed.filter(F.col("committed") >= 0)
        .join(latest, ["topic", "partition"])
        .select(
            "group_id", "topic", "partition",
            F.greatest(F.lit(0).cast("bigint"), F.col("latest") - F.col("committed")).alias("lag"),
        )
    )


def lag_totals(groups: DataFrame, lag: DataFrame) -> DataFrame:
    """Total lag per group, 0 for groups that follow nothing."""
    totals = lag.groupBy("group_id").agg(F.sum("lag").alias("total"))
    return (
        groups.select("group_id").distinct().join(totals, "group_id", "left")
        .select("group_id", F.coalesce("total", F.lit(0)).cast("bigint").alias("total_lag"))
    )


def lag_points(
    committed: DataFrame, latest: DataFrame, window_start: Column, groups: DataFrame | None = None
) -> DataFrame:
    """Lag and lag totals as metric points of the window they were read in.

    ``groups``: the configured groups (group_id); by default those that ever committed.
    """
    lag = consumer_lag(committed, latest)
    each = lag.select(
        window_start.alias("window_start"), F.col("lag").cast("double").alias("value"),
        F.lit("count").alias("unit"),
        dimension_entries(consumerGroup=F.col("group_id"), topic=F.col("topic"),
                          partition=F.col("partition")).alias("entries"),
    )
    total = lag_totals(committed if groups is None else groups, lag).select(
        window_start.alias("window_start"), F.col("total_lag").cast("double").alias("value"),
        F.lit("count").alias("unit"),
        dimension_entries(consumerGroup=F.col("group_id")).alias("entries"),
    )
    return _point(each, F.lit(7), F.lit(GROUP_LAG)).unionByName(
        _point(total, F.lit(8), F.lit(GROUP_LAG_TOTAL))
    )


def metric_points(
    records: DataFrame, lag: DataFrame | None = None, min_rejections: int = MIN_REJECTIONS
) -> DataFrame:
    """Every point of every flush window as one long table."""
    points = points_from_counts(metric_counts(records), min_rejections)
    return points if lag is None else points.unionByName(lag)


def sorted_points(points: DataFrame) -> DataFrame:
    """Publishing order: families in fixed order, keys inside."""
    return points.orderBy("window_start", "family", "name", "unit", "entries")


def batched_points(points: DataFrame, size: int = METRIC_BATCH) -> DataFrame:
    """Points with the number of the publishing batch they travel in."""
    numbered = number_rows(
        points, ["window_start"], ["family", "name", "unit"], ["entries"], "position"
    )
    return numbered.withColumn("batch", F.floor((F.col("position") - 1) / size))
