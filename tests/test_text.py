"""Text functions against plain Python on random and hand-made strings."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions import normalize as nz
from reviewcraft.functions import text as tx

HAND_MADE = [
    "", "   ", " ", "\x1c", "Hizmetleri.cok.guzel", "a.b.c", "çok güzeeeeel!!!", "kitap lar",
    "mekan LARI ler", "a lar lar", "a lar lar lar", "a lar b lar lar", "şbcdfg bcdfgh",
    "érrrttt", "caféler lar", "a . .", "bcdfǵ x", "x_bcdfg bcdfg_", "5bcdfg bcdfg5 bcdfg",
    "😀😀😀 lar", "<b>kalın</b> www.x.com/y http://a.b c", "<>", "<a\nb>c", "wwww.a", "-----" * 50,
    "a" * 100 + "b" * 2, "!!??..,,;;::", "a  lar", "x 　 , y", "İi ler", "ſ lar K ler",
]
ALPHABET = (
    list("aabcdefghiklmnrstxyzAEIRLlarlerçğıöşüÇĞIÖŞÜİ")
    + list(fv.WHITESPACE_CHARS)
    + list("   ..!!??,,;:'_-5<>")
    + ["é", "\u0301", "😀", " lar ", " ler", "http://x.y", "www.", "bcdfg", "<b>"]
)


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(7)
    drawn = ["".join(rng.choices(ALPHABET, k=rng.randrange(1, 40))) for _ in range(4000)]
    return HAND_MADE + drawn


L = fv.LETTERS
C = fv.MASH_CONSONANTS
PYTHON = {
    "strip": (tx.strip, str.strip),
    "tokens": (tx.tokens, str.split),
    "word_count": (tx.word_count, lambda t: len(t.split())),
    "collapse": (tx.collapse_spaces, lambda t: re.sub(r"\s+", " ", t).strip()),
    "html": (tx.strip_html, lambda t: re.sub(r"<[^>]+>", " ", t)),
    "urls": (tx.strip_urls, lambda t: re.sub(r"http\S+|www\.\S+", " ", t)),
    "dots": (nz.dots_between_letters, lambda t: re.sub(rf"(?<=[{L}])\.(?=[{L}])", " ", t)),
    "mash": (nz.drop_keyboard_mash, lambda t: re.sub(rf"\b[{C}]{{5,}}\b", "", t)),
    "letter_runs": (nz.collapse_letter_runs, lambda t: re.sub(rf"([{L}])\1{{2,}}", r"\1", t)),
    "punct_runs": (nz.collapse_punctuation_runs, lambda t: re.sub(r"([!?.,])\1+", r"\1", t)),
    "plural": (
        nz.attach_plural_suffix,
        lambda t: re.sub(rf"\b([{L}]+)\s+(lar|ler)\b", r"\1\2", t, flags=re.IGNORECASE),
    ),
    "tighten": (nz.tighten_punctuation, lambda t: re.sub(r"\s+([!?.,;:])", r"\1", t)),
}
STEPS = ["dots", "mash", "letter_runs", "punct_runs", "plural", "tighten", "collapse"]


def both(spark, strings, column, python):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r["i"]: r["out"] for r in df.select("i", column(F.col("s")).alias("out")).collect()}
    return [(s, got[i], python(s)) for i, s in enumerate(strings) if got[i] != python(s)]


@pytest.mark.parametrize("name", PYTHON)
def test_step_equals_python(spark, strings, name):
    assert both(spark, strings, *PYTHON[name]) == []


def test_normalize_equals_steps_in_order(spark, strings):
    def in_python(text):
        for name in STEPS:
            text = PYTHON[name][1](text)
        return text

    assert both(spark, strings, nz.normalize, in_python) == []


def test_clean_text_order(spark, strings):
    def in_python(text):
        for name in ("html", "urls", "collapse"):
            text = PYTHON[name][1](text)
        return text

    assert both(spark, strings, tx.clean_text, in_python) == []


def test_null_normalizes_to_empty(spark):
    df = spark.createDataFrame([(None,)], "s string").select(nz.normalize(F.col("s")).alias("t"))
    assert df.first()["t"] == ""


def test_entropy(spark, strings):
    def bits(text):
        n = len(text)
        return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0

    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for s, got in df.select("s", tx.char_entropy(F.col("s"))).collect():
        assert got == pytest.approx(bits(s), abs=1e-9), s


def test_no_letter_triple_right_after_its_step(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    left = df.select(nz.collapse_letter_runs(F.col("s")).alias("t"))
    assert left.filter(F.col("t").rlike(rf"([{L}])\1\1")).count() == 0
