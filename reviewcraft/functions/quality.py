"""Quality rules as one expression that names the first broken rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions import text as tx


@dataclass(frozen=True)
class QualityRules:
    min_word_count: int = fv.MIN_WORD_COUNT
    max_consecutive_consonants: int = fv.MAX_CONSECUTIVE_CONSONANTS
    min_vowel_ratio: float = fv.MIN_VOWEL_RATIO
    max_bad_word_ratio: float = fv.MAX_BAD_WORD_RATIO


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]++", ""))


def vowel_count(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, fv.TURKISH_VOWELS, ""))


def distinct_word_share(words: Column) -> Column:
    return F.size(F.array_distinct(words)) / F.size(words)


def bad_word_share(words: Column, rules: QualityRules) -> Column:
    run = f"[{fv.TURKISH_CONSONANTS}]{{{rules.max_consecutive_consonants},}}"
    return F.size(F.filter(words, lambda w: w.rlike(run))) / F.size(words)


@dataclass(frozen=True)
class Measures:
    """What several rules need of a text, to be put into columns and worked out once."""

    words: Column
    letters: Column
    vowels: Column

    @classmethod
    def of(cls, text: Column) -> Measures:
        return cls(tx.tokens(text), letter_count(text), vowel_count(text))


def _low_entropy(text: Column, m: Measures) -> Column:
    """Whether the character entropy is below the limit.

    Putting characters into classes never raises the entropy. So if the entropy
    over vowels, other letters and the rest reaches the limit, the text does,
    and its characters need not be counted. Ordinary prose is settled this way.
    """
    classes = F.filter(
        F.array(m.vowels, m.letters - m.vowels, F.length(text) - m.letters), lambda n: n > 0
    )
    margin = 1e-9
    return (tx.entropy_bits(classes) < fv.MIN_ENTROPY_BITS + margin) & (
        tx.char_entropy(text) < fv.MIN_ENTROPY_BITS
    )


def reject_reason(text: Column, m: Measures, rules: QualityRules = QualityRules()) -> Column:
    """Name of the first rule ``text`` breaks, or null for a good review.

    Rules are tried cheapest first; ``when`` stops at the first hit.
    """
    n_words = F.size(m.words)
    vowel_floor = F.when(
        n_words >= fv.LONG_REVIEW_WORDS,
        F.lit(rules.min_vowel_ratio - fv.LONG_REVIEW_VOWEL_ALLOWANCE),
    ).otherwise(F.lit(rules.min_vowel_ratio))
    return (
        F.when(text.isNull() | (F.length(text) < fv.MIN_CHARS), "too_short")
        .when(n_words < rules.min_word_count, "too_few_words")
        .when(
            (n_words >= fv.REPETITION_MIN_WORDS)
            & (distinct_word_share(m.words) < fv.MIN_DISTINCT_WORD_SHARE),
            "repeated_words",
        )
        .when(
            (n_words > 0) & (bad_word_share(m.words, rules) > rules.max_bad_word_ratio),
            "consonant_runs",
        )
        .when(
            (m.letters >= fv.VOWEL_MIN_LETTERS) & (m.vowels / m.letters < vowel_floor),
            "few_vowels",
        )
        .when(
            (F.length(text) > fv.ENTROPY_MIN_CHARS) & _low_entropy(text, m),
            "low_entropy",
        )
    )
