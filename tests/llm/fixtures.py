"""Small tables with everything that real ones may hold."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    syllables = ["an", "the", "ba", "ri", "ko", "lu", "nde", "sto", "ver", "mi"]
    return " ".join(
        "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n)
    )


def odd_rows(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, near copies, ties, repeated rows."""
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(1, 120)), "en", f"s{i % 3}", 1) for i in range(40)]
    passage = words(rng, 120)
    rows += [
        (100 + i, f"{words(rng, 60)} {passage} {words(rng, 60)}", "en", None, None)
        for i in range(6)
    ]
    base = words(rng, 300).split()
    for i in range(6):
        near = list(base)
        near[(i * 37) % 300] = f"edit{i}"
        rows.append((200 + i, " ".join(near), None, "s0", 5))
    rows += [(300 + i, passage, "en", "s1", 7) for i in range(3)]
    rows += [(400, words(rng, 6000), "en", "s2", 1), (401, "ab" * 2000, "en", "s2", 1)]
    rows += [(500, None, "en", "s1", None), (501, "", None, None, 0), (502, " \t\n", "en", "s1", 3)]
    rows += [(503, "one two", "en", "s1", 7), (504, "Ünïcödé ﬁn 漢字 text here", "en", "s1", 7)]
    rows += [(None, words(rng, 30), "en", "s1", 1), (None, None, None, None, None)]
    rows += [(7, "same id, other text", "en", "s1", 1), rows[3], rows[3]]
    return rows


def odd_docs(spark: SparkSession, seed: int = 1) -> DataFrame:
    return spark.createDataFrame(odd_rows(seed), DOCS).repartition(3, "source")


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def saved(df: DataFrame, path) -> DataFrame:
    """``df`` as a table, so that its rows keep their order."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))
