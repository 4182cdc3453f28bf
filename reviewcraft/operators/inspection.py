"""Looking at a stage table: counts, random rows, one random place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv


def summarize_table(df: DataFrame) -> DataFrame:
    """Row count, and the number of translated rows if the table knows it."""
    parts = [F.count(F.lit(1)).alias("n_rows")]
    if "is_translated" in df.columns:
        parts.append(F.count_if(F.col("is_translated")).alias("n_translated"))
    return df.agg(*parts)


def metrics_table(spark: SparkSession, observed: dict[str, dict[str, int]]) -> DataFrame:
    """Observed metrics of a run as ``stage, metric, value``."""
    rows = [(stage, name, n) for stage, values in observed.items() for name, n in values.items()]
    return spark.createDataFrame(rows, "stage string, metric string, value bigint")


def seeded_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def random_rows(
    df: DataFrame,
    n: int = 10,
    columns: Sequence[str] = fv.SAMPLE_COLUMNS,
    seed: int | None = None,
    key_col: str | None = None,
) -> DataFrame:
    """``n`` random rows without replacement: a top-n, so no full sort.

    With ``key_col`` and ``seed`` the same rows come back every time; else the
    sample is a new one for each seed and physical layout.
    """
    order = F.rand(seed) if key_col is None else seeded_order(F.col(key_col), seed or 0)
    shown = [name for name in columns if name in df.columns]
    return df.orderBy(order).limit(n).select(*shown)


def random_place(
    contexts: DataFrame, seed: int | None = None, preview: int = fv.PREVIEW_CHARS
) -> DataFrame:
    """One random place with the start of its context."""
    order = F.rand() if seed is None else seeded_order(F.col("place_id"), seed)
    return (
        contexts.orderBy(order)
        .limit(1)
        .select(
            "place_id",
            "place_name",
            "avg_rating",
            "total_reviews_analyzed",
            F.substring("llm_input_context", 1, preview).alias("preview"),
        )
    )
