"""Column functions with Unicode-aware text semantics, built from JVM expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv

# Classes are intersected with "neither printable ASCII nor a letter": nearly
# every character fails that, and only the rest are compared with the 29 spaces.
_UNUSUAL = r"[^!-~]&&[^\p{L}]"
ANY_SPACE = f"[{_UNUSUAL}&&[{fv.WHITESPACE_CLASS}]]"
ODD_SPACE = f"[{_UNUSUAL}&&[^ ]&&[{fv.WHITESPACE_CLASS}]]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Trim every Unicode space at both ends (``trim`` knows only U+0020)."""
    return F.btrim(text, F.lit(fv.WHITESPACE_CHARS))


def plain_spaces(text: Column) -> Column:
    """Every Unicode space as U+0020, one for one."""
    return F.regexp_replace(text, ODD_SPACE, " ")


def tokens(text: Column) -> Column:
    """Words between spaces, as ``array<string>``.

    Splitting at a plain space needs no regex; a class of 29 spaces would be
    tried on each character.
    """
    return F.array_remove(F.split(plain_spaces(text), " "), "")


def collapse_spaces(text: Column) -> Column:
    """Runs of spaces become one, none is left at the ends."""
    return F.array_join(tokens(text), " ")


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def strip_html(text: Column) -> Column:
    return F.regexp_replace(text, fv.HTML_TAG, " ")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, fv.URL, " ")


def clean_text(text: Column) -> Column:
    """Tags, then addresses, then runs of spaces."""
    return collapse_spaces(strip_urls(strip_html(text)))


def entropy_bits(counts: Column) -> Column:
    """Shannon entropy in bits of an array of positive counts; 0 for an empty array."""

    def of(array: Column) -> Column:
        total = F.aggregate(array, F.lit(0.0), lambda acc, c: acc + c)
        weighted = F.aggregate(array, F.lit(0.0), lambda acc, c: acc + c * F.log2(c))
        return F.when(F.size(array) == 0, F.lit(0.0)).otherwise(
            let(total, lambda n: F.log2(n) - weighted / n)
        )

    return let(F.transform(counts, lambda c: c.cast("double")), of)


def char_entropy(text: Column) -> Column:
    """Shannon entropy in bits over the code points of ``text``; 0 for empty text.

    Sorting brings equal characters together; their runs are the counts.
    """
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(r"(?s)((.)\2*+)"), F.lit(1))
    return entropy_bits(F.transform(runs, lambda run: F.length(run)))
