"""Ranks within groups of any size, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft.sources import tables


def ranked_in_groups(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``df`` with ``rank``, from 1 within each ``group`` in the given order.

    Rows are sorted in ranges of (group, order) and stored with their places. A range has
    the rows of a group side by side; the counts by range and group, which are a few rows
    a range and one a group, shift the places to ranks.
    """
    place = F.monotonically_increasing_id()
    rows = tables.stored(
        df.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_place", place),
        "ranges",
    ).withColumn("_range", F.shiftright("_place", 33))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        rows.groupBy(group, "_range")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .select(
            F.col(group).alias("_group"),
            F.col("_range").alias("_in"),
            "_first",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_in"))
    return (
        rows.join(shifts, same)
        .withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .drop("_place", "_first", "_before", "_range", "_group", "_in")
    )
