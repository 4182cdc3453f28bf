"""The stages as DataFrame-to-DataFrame functions, free of input and output."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions.quality import QualityRules
from reviewcraft.operators.cleaning import clean_text_basic, remove_nulls
from reviewcraft.operators.finetune import render_chat, with_length_budget
from reviewcraft.operators.language import LanguageDetector, allowed_languages, keep_languages
from reviewcraft.operators.normalization import normalize_data
from reviewcraft.operators.quality import filter_columns, quality_filter
from reviewcraft.operators.translation import BackendFactory, BatchPolicy, translate_foreign


@dataclass(frozen=True)
class CleaningParams:
    text_col: str = "review_text"
    target_lang: str = fv.TARGET_LANGUAGE
    translatable: Iterable[str] = fv.TRANSLATABLE_LANGUAGES
    backend: BackendFactory | None = None
    batches: BatchPolicy = BatchPolicy()


def clean_reviews(
    df: DataFrame,
    detector: LanguageDetector,
    params: CleaningParams = CleaningParams(),
    metrics: Observation | str = "clean",
) -> DataFrame:
    """Raw to cleaned. Narrow throughout, so it runs on a batch and on a stream alike.

    The observation counts what language filtering removes. It also keeps the
    filter above the detection, so that a text is scored once.
    """
    languages = allowed_languages(params.target_lang, params.translatable)
    return (
        df.transform(remove_nulls, params.text_col)
        .transform(clean_text_basic, params.text_col)
        .transform(detector.detect, params.text_col)
        .observe(
            metrics,
            F.count(F.lit(1)).alias("non_blank_rows"),
            F.count_if(~F.col("detected_lang").isin(languages)).alias("other_language_rows"),
        )
        .transform(keep_languages, params.target_lang, params.translatable)
        .transform(
            translate_foreign,
            params.text_col,
            params.target_lang,
            params.backend,
            params.translatable,
            params.batches,
        )
    )


def curate_reviews(
    df: DataFrame,
    rules: QualityRules = QualityRules(),
    normalized: Observation | str = "normalize",
    judged: Observation | str = "quality",
) -> DataFrame:
    """Cleaned to curated, keeping the row id that decides ties later."""
    return (
        df.transform(normalize_data, "cleaned_text", normalized)
        .transform(quality_filter, "cleaned_text", rules, judged)
        .transform(filter_columns, ("review_id", *fv.CURATED_COLUMNS))
    )


def training_text(examples: DataFrame, max_tokens: int = fv.MAX_SEQ_LENGTH) -> DataFrame:
    """Chat examples with their template text and the length check."""
    rendered = examples.withColumn("text", render_chat(F.col("messages")))
    return with_length_budget(rendered, "text", max_tokens)
