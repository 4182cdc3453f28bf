"""Translation of foreign rows through a pluggable backend or a glossary table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft import fixed_values as fv
from reviewcraft.functions import text as tx
from reviewcraft.operators.ranking import ranked_in_groups
from reviewcraft.session import bound_batches
from reviewcraft.sources import tables

logger = logging.getLogger(__name__)

# (texts, source language, target language) -> translations, one per text
Backend = Callable[[list[str], str, str], list[str]]
# built once per Python worker and language, so that a model is loaded there and not shipped
BackendFactory = Callable[[], Backend]


@dataclass(frozen=True)
class BatchPolicy:
    """What one call of a backend gets. Tokens are words here: runs between white space."""

    texts: int = fv.TRANSLATION_BATCH
    # longer texts, and longer translations, are cut after so many tokens; None: never
    max_tokens: int | None = fv.TRANSLATION_MAX_TOKENS
    # tokens of a call, counting each text as long as the longest one beside it
    padded_tokens: int = fv.TRANSLATION_BATCH * fv.TRANSLATION_MAX_TOKENS


def cut_tokens(text: str, most: int | None) -> tuple[str, int]:
    """The text up to the end of its token number ``most``, and how many tokens it has then."""
    if most is None:
        return text, len(text.split())
    parts = text.split(None, most)
    if len(parts) <= most:
        return text, len(parts)
    return text[: len(text) - len(parts[most])].rstrip(), most


def call_sizes(lengths: list[int], policy: BatchPolicy) -> Iterator[tuple[int, int]]:
    """Runs ``(from, to)`` of texts in ascending order of their lengths, one for each call.

    Neighbours are of like length, so little of a call is padding. A text above the budget
    has a call of its own.
    """
    start = 0
    for at, longest in enumerate(lengths):
        n = at - start + 1
        if at > start and (n > policy.texts or n * max(longest, 1) > policy.padded_tokens):
            yield start, at
            start = at
    if lengths:
        yield start, len(lengths)


def _translator(
    factory: BackendFactory, target_lang: str, translatable: frozenset[str], policy: BatchPolicy
):
    def translated(backend: Backend, texts: list[str], lang: str) -> list[str]:
        cut = [cut_tokens(text, policy.max_tokens) for text in texts]
        order = sorted(range(len(cut)), key=lambda i: cut[i][1])
        result = [""] * len(texts)
        for start, end in call_sizes([cut[i][1] for i in order], policy):
            chosen = order[start:end]
            done = backend([cut[i][0] for i in chosen], lang, target_lang)
            if len(done) != len(chosen):
                raise ValueError("translation backend changed the number of texts")
            for i, text in zip(chosen, done, strict=True):
                result[i] = cut_tokens(text, policy.max_tokens)[0]
        return result

    @F.pandas_udf("string")
    def translate(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        backends: dict[str, Backend | None] = {}
        for texts, langs in parts:
            result = texts.copy()
            for lang in sorted(set(langs[texts.notna()].dropna()) & translatable):
                if lang not in backends:
                    # built when its language first occurs; without it, text passes through
                    try:
                        backends[lang] = factory()
                    except Exception as error:
                        logger.warning("no translation from %s: %s", lang, error)
                        backends[lang] = None
                backend = backends[lang]
                if backend is None:
                    continue
                rows = texts.index[(langs == lang) & texts.notna()]
                result.loc[rows] = translated(backend, texts.loc[rows].tolist(), lang)
            yield result

    return translate


def translate_foreign(
    df: DataFrame,
    text_col: str,
    target_lang: str = fv.TARGET_LANGUAGE,
    backend: BackendFactory | None = None,
    translatable: Iterable[str] = fv.TRANSLATABLE_LANGUAGES,
    policy: BatchPolicy = BatchPolicy(),
    lang_col: str = "detected_lang",
) -> DataFrame:
    """Add ``is_translated`` and ``cleaned_text``.

    Rows not in the target language are flagged translated whether or not the
    backend could change them. Without a backend, or without one for its language, text
    passes through whole; what a backend gets and gives is cut as ``policy`` says. Only the
    text and language columns of foreign rows reach the Python workers.
    """
    foreign = F.col(lang_col) != F.lit(target_lang)
    df = df.withColumn("is_translated", F.coalesce(foreign, F.lit(True)))
    if backend is None:
        return df.withColumn("cleaned_text", F.col(text_col))
    bound_batches(df.sparkSession)
    translate = _translator(
        backend, target_lang, frozenset(translatable) - {target_lang}, policy
    )
    translated = translate(F.when(F.col("is_translated"), F.col(text_col)), F.col(lang_col))
    return df.withColumn(
        "cleaned_text", F.when(F.col("is_translated"), translated).otherwise(F.col(text_col))
    )


def frequency_glossary(
    corpus: DataFrame, text_col: str, lang_col: str, target_lang: str
) -> DataFrame:
    """Pair the words of each language with the target's, rank by rank.

    A stand-in dictionary made from data alone: ``(lang, token, translation)``.
    Counts are combined before the shuffle; the distinct words of a language are ranked in
    sorted ranges, not in one task.
    """
    words = corpus.select(
        F.col(lang_col).alias("lang"), F.explode(tx.tokens(F.col(text_col))).alias("token")
    )
    counts = words.groupBy("lang", "token").count()
    ranked = ranked_in_groups(counts, "lang", [F.col("count").desc(), F.col("token")])
    target = ranked.filter(F.col("lang") == target_lang).select(
        "rank", F.col("token").alias("translation")
    )
    return (
        ranked.filter(F.col("lang") != target_lang)
        .join(target, "rank")
        .select("lang", "token", "translation")
    )


#: A glossary within these bounds goes to the Python workers whole.
GLOSSARY_WORDS = 500_000
GLOSSARY_BYTES = 32 << 20
#: A word in more runs of texts than this is dealt over so many groups of the join.
HOT_WORD_TEXTS = 1_000_000
HOT_WORD_GROUPS = 64
#: Neighbouring texts that look up their words together.
RUN_TEXTS = 1024


def glossary_translate(
    df: DataFrame,
    glossary: DataFrame,
    text_col: str,
    key_cols: list[str],
    lang_col: str = "detected_lang",
    output_col: str = "translation",
) -> DataFrame:
    """Word-by-word translation; returns ``key_cols`` and ``output_col``.

    ``key_cols`` must identify a row. ``glossary`` should be a table. If it is small (checked
    by count and bytes), the workers get it whole and texts are not shuffled. A larger one is
    joined with the distinct words of runs of texts, and hot words are dealt over many groups.
    """
    n_words, n_bytes = glossary.agg(
        F.count(F.lit(1)),
        F.sum(F.octet_length(F.concat(F.col("token"), F.col("translation")))),
    ).first()
    if n_words <= GLOSSARY_WORDS and (n_bytes or 0) <= GLOSSARY_BYTES:
        return _translate_in_workers(df, glossary, text_col, key_cols, lang_col, output_col)
    return _translate_by_join(df, glossary, text_col, key_cols, lang_col, output_col)


def _translate_in_workers(df, glossary, text_col, key_cols, lang_col, output_col) -> DataFrame:
    found = glossary.select("lang", "token", "translation").toArrow()
    words: dict[str, dict[str, str]] = {}
    for lang, token, translation in zip(*(c.to_pylist() for c in found.columns), strict=True):
        words.setdefault(lang, {})[token] = translation
    shared = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("string")
    def translate(texts: pd.Series, langs: pd.Series) -> pd.Series:
        out = []
        for text, lang in zip(texts, langs, strict=True):
            # the white space of Python's split is that of ``tx.tokens``
            tokens = None if text is None else text.split()
            known = shared.value.get(lang)
            if tokens and known:
                tokens = map(known.get, tokens, tokens)
            out.append(None if tokens is None else " ".join(tokens))
        return pd.Series(out, dtype=object)

    return df.select(*key_cols, translate(F.col(text_col), F.col(lang_col)).alias(output_col))


def _translate_by_join(df, glossary, text_col, key_cols, lang_col, output_col) -> DataFrame:
    """Runs of neighbouring texts look up their distinct words, and meet the translations again.

    A word that many texts of a run share is looked up once, so far fewer rows than words of
    texts reach the joins; a task holds the texts of one run and the translations it found.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    words = F.array_join(tx.tokens(F.col(text_col)), " ")
    # stored, as the numbers of runs are used twice
    runs = tables.stored(
        df.select(*key_cols, F.col(lang_col).alias("_lang"), words.alias("_words"))
        .withColumn("_run", F.floor(place / RUN_TEXTS).cast("long")),
        "glossary-runs",
    )
    bound_batches(spark)
    wanted = runs.select("_run", "_lang", "_words").mapInArrow(
        _distinct_words, "_run long, lang string, token string"
    )
    if runs.select("_run").distinct().count() > HOT_WORD_TEXTS:
        found = _hot_words_dealt(wanted, glossary)
    else:
        # a word is looked up once a run, so none is hot
        found = wanted.join(glossary, ["lang", "token"])
    found = found.filter(F.col("translation").isNotNull()).select("_run", "lang", "token", "translation")
    schema = T.StructType([*df.select(*key_cols).schema.fields, T.StructField(output_col, T.StringType())])

    def translate(texts: pa.Table, known: pa.Table) -> pa.Table:
        translations: dict[str, dict[str, str]] = {}
        for lang, token, translation in zip(*(c.to_pylist() for c in known.columns[1:]), strict=True):
            translations.setdefault(lang, {})[token] = translation
        out = []
        for lang, line in zip(texts["_lang"].to_pylist(), texts["_words"].to_pylist(), strict=True):
            if line and lang in translations:
                tokens = line.split(" ")
                line = " ".join(map(translations[lang].get, tokens, tokens))
            out.append(line)
        return texts.select(key_cols).append_column(output_col, pa.array(out, pa.string()))

    return runs.groupBy("_run").cogroup(found.groupBy("_run")).applyInArrow(translate, schema)


def _hot_words_dealt(wanted: DataFrame, glossary: DataFrame) -> DataFrame:
    # at most one word in a million looked-up ones is here
    hot = F.broadcast(
        wanted.groupBy("lang", "token")
        .count()
        .filter(F.col("count") > HOT_WORD_TEXTS)
        .select("lang", "token", F.lit(True).alias("hot"))
    )
    group = F.when(F.col("hot"), F.pmod(F.xxhash64("_run"), F.lit(HOT_WORD_GROUPS))).otherwise(0)
    groups = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(HOT_WORD_GROUPS - 1))).otherwise(
        F.array(F.lit(0))
    )
    dealt = wanted.join(hot, ["lang", "token"], "left").withColumn("group", group.cast("int"))
    copied = glossary.join(hot, ["lang", "token"], "left").select(
        "lang", "token", "translation", F.explode(groups).alias("group")
    )
    return dealt.drop("hot").join(copied, ["lang", "token", "group"])


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each run and language, once for each batch that has some of it."""
    for batch in batches:
        seen: dict[tuple[int, str], set[str]] = {}
        for run, lang, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if line and lang is not None:
                seen.setdefault((run, lang), set()).update(line.split(" "))
        for (run, lang), tokens in seen.items():
            n = len(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array([run] * n, pa.int64()), pa.array([lang] * n, pa.string()), pa.array(list(tokens), pa.string())],
                names=["_run", "lang", "token"],
            )
