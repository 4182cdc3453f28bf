"""Text normalization steps. Each takes and returns a string Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions import text as tx

# The patterns test the rarest thing first: most positions of a text then fail
# after one comparison. Runs are matched possessively and from their start only,
# so that a long run costs linear time. ``\b`` is avoided, as it treats combining
# marks as part of a word.
_NOT_AFTER_WORD = f"(?<![{fv.WORD_CLASS}])"
_NOT_BEFORE_WORD = f"(?![{fv.WORD_CLASS}])"


def dots_between_letters(text: Column) -> Column:
    """``word.word`` becomes two words."""
    return F.regexp_replace(text, rf"\.(?<=[{fv.LETTERS}]\.)(?=[{fv.LETTERS}])", " ")


def drop_keyboard_mash(text: Column) -> Column:
    """Delete whole words made of five or more consonants."""
    least = f"[{fv.MASH_CONSONANTS}]{{{fv.MASH_MIN_LENGTH}}}"
    word = f"[{fv.MASH_CONSONANTS}]++"
    return F.regexp_replace(text, f"(?={least}){_NOT_AFTER_WORD}{word}{_NOT_BEFORE_WORD}", "")


def collapse_letter_runs(text: Column) -> Column:
    """Three or more of one letter become one."""
    repeats = fv.LETTER_RUN_MIN_REPEATS
    return F.regexp_replace(
        text, rf"(?s)(.)(?=\1{{{repeats}}})(?<=[{fv.LETTERS}])\1++", "$1"
    )


def collapse_punctuation_runs(text: Column) -> Column:
    return F.regexp_replace(text, rf"([{fv.REPEATABLE_PUNCTUATION}])\1++", "$1")


def attach_plural_suffix(text: Column, space: str = tx.ANY_SPACE) -> Column:
    """Join a plural suffix that was typed as a word of its own.

    Few texts have one; a search for the bare suffix spares the others the test
    of each word.
    """
    word = f"[{fv.LETTERS}{fv.CASE_FOLDED_EXTRAS}]++"
    suffix = f"{space}++({fv.PLURAL_SUFFIX}){_NOT_BEFORE_WORD}"

    def attach(t: Column) -> Column:
        joined = F.regexp_replace(t, f"{_NOT_AFTER_WORD}({word}){suffix}", "$1$2")
        return F.when(t.rlike(suffix), joined).otherwise(t)

    return tx.let(text, attach)


def tighten_punctuation(text: Column, space: str = tx.ANY_SPACE) -> Column:
    """No space before punctuation."""
    # the first space of a run, the others, the mark
    return F.regexp_replace(
        text, f"{space}(?<!{space}{space}){space}*+([{fv.TIGHT_PUNCTUATION}])", "$1"
    )


def normalize(text: Column) -> Column:
    """All steps in order; null and blank text give the empty string.

    No step tells one kind of space from another and the last one makes them
    all plain, so they can be made plain first.
    """
    out = tx.plain_spaces(F.coalesce(text, F.lit("")))
    out = dots_between_letters(out)
    out = drop_keyboard_mash(out)
    out = collapse_letter_runs(out)
    out = collapse_punctuation_runs(out)
    out = attach_plural_suffix(out, " ")
    out = tighten_punctuation(out, " ")
    return F.array_join(F.array_remove(F.split(out, " "), ""), " ")
