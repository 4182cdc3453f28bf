"""Normalization of a text column, with change tracking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions.normalize import normalize


def with_changes(
    df: DataFrame, text_col: str = "cleaned_text", metrics: Observation | str = "normalize"
) -> DataFrame:
    """Normalize in place and add ``before`` and ``changed``.

    Row and change counts are observed under ``metrics``. The observation also
    keeps later filters above the normalization, which would otherwise be
    inlined into them and run once more for each use.
    """
    return (
        df.withColumn("before", F.col(text_col))
        .withColumn(text_col, normalize(F.col(text_col)))
        .withColumn("changed", ~F.col("before").eqNullSafe(F.col(text_col)))
        .observe(
            metrics,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("changed")).alias("changed_rows"),
        )
    )


def normalize_data(
    df: DataFrame, text_col: str = "cleaned_text", metrics: Observation | str = "normalize"
) -> DataFrame:
    """Normalize in place."""
    return with_changes(df, text_col, metrics).drop("before", "changed")


def change_samples(
    df: DataFrame,
    text_col: str = "cleaned_text",
    id_col: str = "review_id",
    n: int = fv.CHANGE_SAMPLE_ROWS,
) -> DataFrame:
    """The first ``n`` changed rows by id, before and after."""
    changed = with_changes(df, text_col).filter("changed")
    return (
        changed.select(id_col, "before", F.col(text_col).alias("after")).orderBy(id_col).limit(n)
    )
