"""Quality filtering, reporting and projection of normalized reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions.quality import Measures, QualityRules, reject_reason
from reviewcraft.operators.normalization import normalize_data

_MEASURES = ("__words", "__letters", "__vowels")


def with_reject_reason(
    df: DataFrame,
    text_col: str = "cleaned_text",
    rules: QualityRules = QualityRules(),
    metrics: Observation | str = "quality",
) -> DataFrame:
    """Add ``reject_reason``: the first rule broken, null for rows to keep.

    Kept and removed rows are counted under ``metrics``. As a filter is not
    pushed below the observation, the rules run once per row.
    """
    text = F.col(text_col)
    measured = Measures.of(text)
    columns = Measures(*[F.col(name) for name in _MEASURES])
    return (
        df.withColumns(dict(zip(_MEASURES, (measured.words, measured.letters, measured.vowels))))
        .withColumn("reject_reason", reject_reason(text, columns, rules))
        .drop(*_MEASURES)
        .observe(
            metrics,
            F.count_if(F.col("reject_reason").isNull()).alias("kept_rows"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("removed_rows"),
        )
    )


def quality_filter(
    df: DataFrame,
    text_col: str = "cleaned_text",
    rules: QualityRules = QualityRules(),
    metrics: Observation | str = "quality",
) -> DataFrame:
    """Rows that break no rule."""
    judged = with_reject_reason(df, text_col, rules, metrics)
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(
    df: DataFrame, text_col: str = "cleaned_text", rules: QualityRules = QualityRules()
) -> DataFrame:
    """The rows the filter removes, each with its reason: a table, not a log."""
    return with_reject_reason(df, text_col, rules).filter(F.col("reject_reason").isNotNull())


def quality_report(
    df: DataFrame, text_col: str = "cleaned_text", rules: QualityRules = QualityRules()
) -> DataFrame:
    """Row count per outcome."""
    outcome = F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    return with_reject_reason(df, text_col, rules).groupBy(outcome).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def filter_columns(df: DataFrame, keep: Sequence[str] = fv.CURATED_COLUMNS) -> DataFrame:
    """Those of ``keep`` that exist, in that order."""
    return df.select(*[name for name in keep if name in df.columns])

