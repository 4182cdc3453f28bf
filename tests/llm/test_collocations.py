import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reviewcraft.llm import cells, collocations
from reviewcraft.llm.collocations import CollocationParams
from reviewcraft.llm.split_words import split_words
from tests.llm.fixtures import DOCS, empty_docs

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_force(rows, longest=5, least=100, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        phrases = {p for p, a in count.items() if len(p) > 1 and a >= least}
        dropped = {
            q[i : i + k]
            for q in phrases
            for k in range(2, len(q))
            for i in range(len(q) - k + 1)
            if count[q] >= count[q[i : i + k]]
        }
        rows_of = []
        for p in phrases - dropped:
            a = count[p]
            score, _, left, right = min(
                (1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                for k in range(1, len(p))
            )
            rows_of.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(df, **params):
    got = collocations.collocations(df, CollocationParams(**params)).drop("words")
    return sorted(tuple(r) for r in got.collect())


def corpus(seed=3, docs=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = []
    for i in range(docs):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 200))
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(["New York City", "as  well\tas", "a b a b a b", "é ü", "x y z v u t"]).split(" ")
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", "und", None]), "s", 1))
    rows += [(900, None, "en", None, None), (901, "", "en", "s", 0), (902, "Ä\x0b. ;", None, "s", 1)]
    rows += [(903, "la " * 3000, "en", "s", 1), (None, "New York City", "fr", "s", 1), rows[3], rows[3]]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit(1)).withColumn("h", F.lit("x"))
    got = found(df.repartition(3), least_count=6)
    assert got == brute_force([(r[2], r[1]) for r in rows], least=6)
    assert len({r[0] for r in got}) == 3


def test_rounds_settle_the_last_rank(spark):
    """Few ranks and a small first share: most first words are never expanded."""
    rows = corpus(seed=5, docs=150)
    got = found(spark.createDataFrame(rows, DOCS), least_count=4, top=7, first_share=0.02)
    assert got == brute_force([(r[2], r[1]) for r in rows], least=4, top=7)


def test_large_filters_and_joins_give_the_same(spark, monkeypatch):
    """As with too many keys for the driver, and tables too large to be broadcast."""
    monkeypatch.setattr(cells, "_DRIVER_KEYS", 0)
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", 0)
    rows = corpus(seed=6)
    got = found(spark.createDataFrame(rows, DOCS), least_count=6)
    assert got == brute_force([(r[2], r[1]) for r in rows], least=6)


def test_products_beyond_64_bits():
    n = 2**62
    import pandas as pd

    score = collocations._score.func
    column = lambda x: pd.Series([x])
    assert score(column(n), column(n), column(n), column(n)).tolist() == [1000]
    assert score(column(3), column(n - 1), column(7000), column(5)).tolist() == [3000 * (n - 1) // 35000]


def test_empty_and_rare(spark):
    assert found(empty_docs(spark)) == []
    assert found(spark.createDataFrame(corpus(docs=2)[:2], DOCS)) == []


def test_split_words_at_every_kind_of_byte():
    kinds = collocations.KINDS
    words = split_words([b"", b"A,b c", b"  x\ty.", b"z"], kinds)
    got = [words.distinct[c] for c in words.codes]
    assert got == [b"a", b"b", b"c", b"x", b"y", b"z"]
    assert words.text.tolist() == [1, 1, 1, 2, 2, 3]
    assert np.flatnonzero(np.diff(words.piece, prepend=-1)).tolist() == [0, 1, 3, 5]
    assert split_words([], kinds).distinct == []


def test_texts_are_taken_apart_in_bounded_runs():
    """A batch of one language does not become one row of coded texts."""
    texts = [b"a bc " * 40_000] * 40 + [b"", b"x" * (collocations.RUN_BYTES + 1), b"y"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["de", *["en"] * (len(texts) - 1)]), pa.array(texts, pa.binary())], names=["lang", "utf8"]
    )
    runs = list(collocations._lang_runs(batch))
    assert sorted(t for _, run in runs for t in run) == sorted(texts)
    assert all(len(run) == 1 or sum(map(len, run)) <= collocations.RUN_BYTES for _, run in runs)
    assert len(runs) <= 8 and {lang for lang, _ in runs} == {"de", "en"}
