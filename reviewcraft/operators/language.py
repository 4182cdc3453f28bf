"""Language detection: naive Bayes over character grams of words.

Training counts distinct words before it takes them apart, so its cost follows
the vocabulary rather than the text. The profile's size is checked before it travels
with the tasks: scoring is a projection in Arrow batches that looks up distinct words, and
no text is shuffled or joined back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions import text as tx
from reviewcraft.functions.grams import BITS, count_word_grams, framed_codes, letters_only, text_grams
from reviewcraft.sources import tables

# characters scored at a time by one task, unless a single text is longer
_SLICE_CHARS = 1 << 18
# characters of texts whose distinct words are scored together
_WORDS_CHARS = 1 << 23
# weights of a profile that is held in the driver and broadcast (8 bytes each)
MAX_WEIGHTS = 1 << 25


@dataclass(frozen=True)
class DetectorParams:
    smoothing: float = 0.5
    # weights are whole numbers, so a score does not depend on the order of a sum
    scale: float = 1e6


def train_profile(
    labelled: DataFrame, text_col: str, lang_col: str, params: DetectorParams = DetectorParams()
) -> DataFrame:
    """``gram, lang, weight``: scaled log probabilities of the grams of each language."""
    letters = F.trim(letters_only(F.col(text_col)))
    words = (
        labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.explode(F.split(letters, " ")).alias("word"))
        .filter("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # stored: totals, sizes and weights all need the counts, the texts are read once
    counts = tables.stored(
        words.mapInPandas(count_word_grams, "lang string, gram bigint, n bigint")
        .groupBy("gram", "lang")
        .agg(F.sum("n").alias("n")),
        "gram-counts",
    )
    # one row per gram, a map entry per language
    per_gram = counts.groupBy("gram").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")
    )
    # totals over all grams; a language is a row here
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    size = per_gram.agg(F.count(F.lit(1)).alias("size")).scalar()
    languages = totals.agg(F.collect_list(F.struct("lang", "total"))).scalar()
    spread = per_gram.select("gram", "by_lang", F.explode(languages).alias("l"))
    n = F.coalesce(F.try_element_at("by_lang", F.col("l.lang")), F.lit(0))
    log_share = F.log(n + F.lit(params.smoothing)) - F.log(
        F.col("l.total") + F.lit(params.smoothing) * size
    )
    return spread.select(
        "gram", "l.lang", F.rint(log_share * params.scale).cast("bigint").alias("weight")
    )


class LanguageDetector:
    """A trained profile. ``detect`` adds the label column to a batch or a stream."""

    def __init__(self, languages: list[str], grams: np.ndarray, weights: np.ndarray) -> None:
        self.languages = languages
        self.grams = grams  # ascending
        self.weights = weights  # one row per language, in the order of the grams

    @classmethod
    def train(
        cls,
        labelled: DataFrame,
        text_col: str,
        lang_col: str,
        params: DetectorParams = DetectorParams(),
    ) -> LanguageDetector:
        return cls.from_profile(train_profile(labelled, text_col, lang_col, params))

    @classmethod
    def from_profile(cls, profile: DataFrame) -> LanguageDetector:
        """Collect a profile, if it is small enough to travel with the tasks.

        Grams are up to three letters, so their number is that of an alphabet's
        letter sequences and levels off. A profile that is too large is an error
        rather than cut: every gram counts, and ``SlicedDetector`` takes it.
        """
        weights = profile.count()
        if weights > MAX_WEIGHTS:
            raise ValueError(f"profile of {weights} weights; at most {MAX_WEIGHTS} can be shared")
        table = profile.toPandas().pivot(index="gram", columns="lang", values="weight")
        table = table.sort_index()
        return cls(list(table.columns), table.index.to_numpy(), table.to_numpy().T.copy())

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LanguageDetector | SlicedDetector:
        """The stored profile, shared as a whole if its size allows, else slice by slice."""
        profile = spark.read.parquet(path)
        return cls.from_profile(profile) if profile.count() <= MAX_WEIGHTS else SlicedDetector(profile)

    def detect(
        self, df: DataFrame, text_col: str, output_col: str = "detected_lang"
    ) -> DataFrame:
        """Add the most likely language; texts without known grams are ``unknown``."""
        shared = df.sparkSession.sparkContext.broadcast(
            (self.languages, self.grams, self.weights)
        )

        @F.pandas_udf("string")
        def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            languages, grams, weights = shared.value
            names = np.array([*languages, fv.UNKNOWN_LANGUAGE], dtype=object)
            for texts in batches:
                yield pd.Series(names[_best_language(texts.tolist(), grams, weights)])

        return df.withColumn(output_col, label(_detectable_letters(text_col)))


class SlicedDetector:
    """A profile of any size, as a table of ``gram, lang, weight``.

    Its grams are dealt into slices small enough to share. Each slice scores all texts by itself
    and leaves a few sums for each; these are added up by row. Labels are those of
    ``LanguageDetector``. Texts are read once a slice and never shuffled. Batches only:
    the sums of a row meet in a shuffle that a stream does not have.
    """

    def __init__(self, profile: DataFrame, max_weights: int | None = None) -> None:
        self.profile = profile
        self.languages = sorted(r["lang"] for r in profile.select("lang").distinct().collect())
        weights = profile.count()
        self.slices = max(1, -(-weights // max(1, max_weights or MAX_WEIGHTS)))

    def _slice(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ascending grams and a row of weights for each language."""
        part = self.profile.filter(F.pmod(F.xxhash64("gram"), F.lit(self.slices)) == number)
        table = part.toPandas().pivot(index="gram", columns="lang", values="weight").sort_index()
        table = table.reindex(columns=self.languages, fill_value=0)
        return table.index.to_numpy(dtype=np.int64), table.to_numpy(dtype=np.int64).T.copy()

    def detect(
        self, df: DataFrame, text_col: str, output_col: str = "detected_lang"
    ) -> DataFrame:
        """Add the most likely language; texts without known grams are ``unknown``."""
        if df.isStreaming:
            raise ValueError(f"a profile above {MAX_WEIGHTS} weights needs a batch, not a stream")
        spark = df.sparkSession
        # letters are stored too: every slice reads them
        numbered = df.withColumns(
            {"_row": F.monotonically_increasing_id(), "_letters": _detectable_letters(text_col)}
        )
        rows = tables.stored(numbered, "detected-rows")
        letters = rows.select("_row", F.col("_letters").alias("letters"))
        rows = rows.drop("_letters")
        names = [f"score{i}" for i in range(len(self.languages))]
        schema = ", ".join(f"{n} long" for n in ("_row", "hits", *names))
        partial = None
        for number in range(self.slices):
            grams, weights = self._slice(number)
            if not len(grams):
                continue
            shared = spark.sparkContext.broadcast((grams, weights))

            def score(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    hits, scores = _sums(batch["letters"].tolist(), *shared.value)
                    columns = dict(zip(names, scores, strict=True))
                    yield pd.DataFrame({"_row": batch["_row"], "hits": hits, **columns})

            # stored before the next slice is shared, so that one is held at a time
            found = tables.stored(letters.mapInPandas(score, schema), "detected-sums")
            shared.destroy()
            partial = found if partial is None else partial.unionByName(found)
        if partial is None:
            return rows.drop("_row").withColumn(output_col, F.lit(fv.UNKNOWN_LANGUAGE))
        sums = partial.groupBy("_row").agg(*(F.sum(n).alias(n) for n in ("hits", *names)))
        best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
        label = F.coalesce(
            *(F.when(F.col(n) == best, F.lit(lang)) for n, lang in zip(names, self.languages, strict=True))
        )
        labels = sums.select(
            "_row",
            F.when(F.col("hits") > 0, label).otherwise(fv.UNKNOWN_LANGUAGE).alias(output_col),
        )
        kept = rows.drop(output_col) if output_col in df.columns else rows
        return kept.join(labels, "_row").drop("_row")


def _detectable_letters(text_col: str) -> Column:
    text = F.col(text_col).cast("string")
    detectable = F.length(tx.strip(text)) >= fv.MIN_DETECTABLE_CHARS
    return F.when(detectable, letters_only(text)).otherwise("")


def _best_language(texts: list[str], grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Row of ``weights`` with the highest score for each text, ``len(weights)`` if none."""
    hits, scores = _sums(texts, grams, weights)
    return np.where(hits > 0, scores.argmax(axis=0), len(weights))


def _sums(
    texts: list[str], grams: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Number of known grams of each text, and their weights summed for each language.

    No gram of a trained profile crosses a space, so a text has the sums of its words, and each
    distinct word of many texts is looked up once.
    """
    if not texts:
        return np.zeros(0, dtype=np.int64), np.zeros((len(weights), 0), dtype=np.int64)
    if _crosses_words(grams):
        return _in_slices(texts, _SLICE_CHARS, lambda part: _score_slice(part, grams, weights))
    return _in_slices(texts, _WORDS_CHARS, lambda part: _word_sums(part, grams, weights))


def _crosses_words(grams: np.ndarray) -> bool:
    """Whether a gram is a lone space, or has one that neither opens nor ends a word."""
    space, mask = ord(" "), (1 << BITS) - 1
    first, second, third = grams >> (2 * BITS), (grams >> BITS) & mask, grams & mask
    inside = (second == space) & ((third != 0) | (first == space))
    return bool(np.any(inside | ((first == space) & (second == 0))))


def _in_slices(texts: list[str], most: int, score) -> tuple[np.ndarray, np.ndarray]:
    """What ``score`` finds for runs of texts of about ``most`` characters, put together."""
    hits, scores, start = [], [], 0
    while start < len(texts):
        stop, size = start + 1, len(texts[start])
        while stop < len(texts) and size + len(texts[stop]) <= most:
            size += len(texts[stop])
            stop += 1
        found = score(texts[start:stop])
        hits.append(found[0])
        scores.append(found[1])
        start = stop
    return np.concatenate(hits), np.concatenate(scores, axis=1)


def _word_sums(
    texts: list[str], grams: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    # a text has one word at least, the empty one, so no run of words is empty
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    words = split.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False)
    framed = [f" {word} " if word else "" for word in words.dictionary.to_pylist()]
    hits, scores = _in_slices(framed, _SLICE_CHARS, lambda part: _score_slice(part, grams, weights))
    return (
        np.add.reduceat(hits[codes], starts),
        np.stack([np.add.reduceat(score[codes], starts) for score in scores]),
    )


def _score_slice(
    texts: list[str], grams: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    lengths = [len(text) + 2 for text in texts]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    scores = np.zeros((len(weights), len(texts)), dtype=np.int64)
    hits = np.zeros(len(texts), dtype=np.int64)
    for codes in text_grams(framed_codes(texts)):
        found = np.searchsorted(grams, codes)
        found[found == len(grams)] = 0
        known = grams[found] == codes
        hits += np.add.reduceat(known, starts, dtype=np.int64)
        for i, weight in enumerate(weights):
            scores[i] += np.add.reduceat(np.where(known, weight[found], 0), starts)
    return hits, scores


def allowed_languages(
    target_lang: str = fv.TARGET_LANGUAGE,
    translatable: Iterable[str] = fv.TRANSLATABLE_LANGUAGES,
) -> list[str]:
    return sorted({*translatable, target_lang})


def keep_languages(
    df: DataFrame,
    target_lang: str = fv.TARGET_LANGUAGE,
    translatable: Iterable[str] = fv.TRANSLATABLE_LANGUAGES,
    lang_col: str = "detected_lang",
) -> DataFrame:
    """Keep rows in the target language or one that can be translated into it."""
    return df.filter(F.col(lang_col).isin(allowed_languages(target_lang, translatable)))
