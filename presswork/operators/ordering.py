"""Row numbers and first-wins choices that stay parallel for hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    frame: DataFrame, group: list[str], bucket: list[str], order: list[Column | str], name: str
) -> DataFrame:
    """row_number over (group order by bucket, order), one bucket per window.

    ``bucket`` must be a leading part of the wanted order. Only bucket sizes
    are ranked per group, so a group with most of the rows is still numbered by
    as many tasks as it has buckets.
    """
    keys = group + bucket
    sizes = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        frame.join(starts, keys)
        .withColumn(name, F.col("_start") + F.row_number().over(inside))
        .drop("_start")
    )


def first_per_key(frame: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row of each key. The rank filter runs before the shuffle too, so a
    hot key sends one row per input partition."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
