"""Each quality rule at its limits, and the whole against a plain count in Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from reviewcraft.plans.stages import curate_reviews
from reviewcraft import fixed_values as fv
from reviewcraft.operators import normalization, quality

CASES = [
    (None, "too_short"),
    ("abcd", "too_short"),
    ("abcde", "too_few_words"),
    ("ab cd", None),
    ("çok çok çok çok çok", None),  # five words: repetition is not looked at
    ("çok " * 9 + "iyi", "repeated_words"),  # 2 of 10
    ("çok iyi " * 4, None),  # 2 of 8 is not below a quarter
    ("bcdfghj ali", "consonant_runs"),  # one of two
    ("bcdfghj ali veli aaa", None),  # one of four is not above a quarter
    ("xxxxxqqqqq wwwwwww", "few_vowels"),
    ("مطعم ممتاز جدا", "few_vowels"),
    ("éé éé éé é", "few_vowels"),
    ("11111111111111111111 1", "low_entropy"),
    ("111111111111111111 1", None),  # twenty characters
    ("Lezzetli yemek, güler yüzlü servis.", None),
]


def test_cases(spark):
    df = spark.createDataFrame([(t, r) for t, r in CASES], "cleaned_text string, expected string")
    wrong = quality.with_reject_reason(df).filter(~F.col("expected").eqNullSafe(F.col("reject_reason")))
    assert wrong.collect() == []


def expected_reason(text):
    words, n = text.split(), len(text)
    letters = [c for c in text if c.isalpha()]
    counts = Counter(text)
    longest = [max(map(len, _runs(w)), default=0) for w in words]
    floor = 0.15 - 0.03 if len(words) >= 12 else 0.15
    checks = [
        ("too_short", lambda: n < 5),
        ("too_few_words", lambda: len(words) < 2),
        ("repeated_words", lambda: len(words) >= 6 and len(set(words)) / len(words) < 0.25),
        ("consonant_runs", lambda: sum(r >= 7 for r in longest) / len(words) > 0.25),
        (
            "few_vowels",
            lambda: len(letters) >= 6
            and sum(c in fv.TURKISH_VOWELS for c in letters) / len(letters) < floor,
        ),
        (
            "low_entropy",
            lambda: n > 20 and sum(c / n * math.log2(n / c) for c in counts.values()) < 1.3,
        ),
    ]
    return next((name for name, broken in checks if broken()), None)


def _runs(word):
    return "".join(c if c in fv.TURKISH_CONSONANTS else " " for c in word).split()


def test_random_texts(spark):
    rng = random.Random(11)
    pieces = ["çok", "iyi", "bcdfghjk", "aaa", "x", "güzel", "1", "é", "مطعم", "qqqq", "lezzet", "!!"]
    texts = []
    for _ in range(3000):
        some = rng.sample(pieces, rng.randrange(1, 5))
        texts.append(" ".join(rng.choices(some, k=rng.randrange(1, 25))))
    df = spark.createDataFrame([(t, expected_reason(t)) for t in texts], "cleaned_text string, expected string")
    judged = quality.with_reject_reason(df)
    assert judged.filter(~F.col("expected").eqNullSafe(F.col("reject_reason"))).collect() == []
    assert judged.select("reject_reason").distinct().count() >= 5


def test_observed_counts(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "cleaned_text string")
    seen = Observation()
    kept = quality.quality_filter(df, metrics=seen).count()
    assert seen.get == {"kept_rows": kept, "removed_rows": len(CASES) - kept}
    assert quality.rejected_rows(df).count() == len(CASES) - kept


def test_projection_keeps_order_of_list(spark):
    df = spark.createDataFrame([("t", 1.0, "p", 5)], "cleaned_text string, rating double, place_id string, other int")
    assert quality.filter_columns(df).columns == ["place_id", "rating", "cleaned_text"]


def test_change_tracking(spark):
    df = spark.createDataFrame([(1, "çok güzeeel"), (2, "iyi"), (3, None)], "review_id int, cleaned_text string")
    seen = Observation()
    assert normalization.normalize_data(df, metrics=seen).count() == 3
    assert seen.get == {"rows": 3, "changed_rows": 2}
    assert [tuple(r) for r in normalization.change_samples(df, n=1).collect()] == [
        (1, "çok güzeeel", "çok güzel")
    ]


@pytest.mark.parametrize("step", ["quality", "curate"])
def test_plan_is_narrow_and_runs_patterns_once(spark, step):
    df = spark.createDataFrame([(1, "p", "metin")], "review_id int, place_id string, cleaned_text string")
    result = curate_reviews(df) if step == "curate" else quality.quality_filter(df)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_replace(regexp_replace") <= plan.count("CollectMetrics normalize") * 5
    assert plan.count("array_distinct") == 1
