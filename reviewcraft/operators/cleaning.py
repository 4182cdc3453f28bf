"""Basic cleaning of raw reviews: blank rows out, tags and addresses out, spaces collapsed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewcraft.functions import text as tx


def remove_nulls(df: DataFrame, text_col: str) -> DataFrame:
    """Drop null and blank text; what stays is stripped."""
    stripped = tx.strip(F.col(text_col).cast("string"))
    # null <> '' is null, so the one filter drops both kinds
    return df.withColumn(text_col, stripped).filter(F.col(text_col) != "")


def clean_text_basic(df: DataFrame, text_col: str) -> DataFrame:
    """Clean ``text_col`` and keep what it was in ``raw_text``, if not kept already."""
    if "raw_text" not in df.columns:
        df = df.withColumn("raw_text", F.col(text_col))
    return df.withColumn(text_col, tx.clean_text(F.col(text_col)))
