"""Character grams of words, up to three characters, as integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_GRAM = 3
NO_GRAM = -1
# bits for a code point: three of them fit a signed 64-bit integer
BITS = 21


def letters_only(text: Column) -> Column:
    """Lower-case words parted and framed by single spaces; one space if there is no letter."""
    framed = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return F.regexp_replace(framed, r"\P{L}+", " ")


def framed_codes(texts: list[str]) -> np.ndarray:
    """Code points of all texts, each followed by two zeros that no gram may cross."""
    return np.frombuffer("".join(t + "\0\0" for t in texts).encode("utf-32-le"), dtype=np.uint32)


def text_grams(chars: np.ndarray) -> list[np.ndarray]:
    """The grams that start at each code point, one array per size.

    A gram is one integer made of up to three code points; ``NO_GRAM`` stands
    where a text ends too early.
    """
    first = chars.astype(np.int64)
    second, third = np.zeros_like(first), np.zeros_like(first)
    second[:-1] = first[1:]
    third[:-2] = first[2:]
    single = first << (2 * BITS)
    pair = single | (second << BITS)
    return [
        np.where(first > 0, single, NO_GRAM),
        np.where((first > 0) & (second > 0), pair, NO_GRAM),
        np.where((first > 0) & (second > 0) & (third > 0), pair | third, NO_GRAM),
    ]


def count_word_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``lang, word, n`` to ``lang, gram, n``, combined within each batch.

    Words are framed by spaces, so that grams know where a word starts and
    ends; the lone frame is no gram.
    """
    lone_frame = ord(" ") << (2 * BITS)
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            words = [f" {word} " for word in rows["word"]]
            weight = np.repeat(rows["n"].to_numpy(), [len(word) + 2 for word in words])
            codes = np.concatenate(text_grams(framed_codes(words)))
            grams, where = np.unique(codes, return_inverse=True)
            # exact: a float holds whole numbers up to 2^53
            n = np.bincount(where, weights=np.tile(weight, MAX_GRAM)).astype(np.int64)
            real = (grams != NO_GRAM) & (grams != lone_frame)
            yield pd.DataFrame({"lang": lang, "gram": grams[real], "n": n[real]})
