import random

import pytest

from reviewcraft.llm import decontaminate as dc
from tests.llm.fixtures import DOCS, empty_docs, odd_docs, saved

PARAMS = dc.DecontaminationParams()
ITEMS = "item_id long, text string"
VOCABULARY = [f"w{i}" for i in range(400)]
WEIGHTS = [1 / (i + 1) for i in range(400)]


def random_words(rng, n):
    return rng.choices(VOCABULARY, WEIGHTS, k=n)


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        i, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[i] = rng.choice([*VOCABULARY, "unknown"])
        elif kind < 0.7:
            words.insert(i, rng.choice([*VOCABULARY, "unknown"]))
        else:
            del words[i]
    return words


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_recall_and_exact_distance(share):
    rng = random.Random(int(share * 10))
    items = [(i, " ".join(random_words(rng, rng.randint(10, 60))).encode()) for i in range(60)]
    index = dc.ItemIndex(items, PARAMS)
    texts = []
    for _, text in items:
        words = text.decode().split()
        leak = edited(rng, words, int(share * len(words)))
        texts.append(" ".join(random_words(rng, 40) + leak + random_words(rng, 40)).encode())
    found = {}
    for t, item, distance, first, end in index.leaks(texts):
        found[t, item] = distance
        stretch = texts[t].split()[first:end]
        assert distance == plain_distance(items[item][1].split(), stretch)
        assert distance <= 0.2 * len(items[item][1].split())
    recall = sum((i, i) in found for i in range(60)) / 60
    assert recall >= (1.0 if share == 0.0 else 0.95)
    clean = [" ".join(random_words(rng, 100)).encode() for _ in range(30)]
    assert not list(index.leaks(clean))


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_query_table(spark, tmp_path):
    rng = random.Random(8)
    item = random_words(rng, 30)
    rows = [
        (1, " ".join(random_words(rng, 50) + item), "", "", 0),
        (2, " ".join(random_words(rng, 50)), "", "", 0),
        (3, "A b, " + ", ".join(item).upper() + "!", "", "", 0),
        (3, "A b, " + ", ".join(item).upper() + "!", "", "", 0),
        (None, " ".join(item), None, None, None),
        (4, None, "", "", 0),
        (5, " ".join(random_words(rng, 30000) + item), "", "", 0),
    ]
    benchmark = spark.createDataFrame(
        [(10, " ".join(item)), (11, None), (12, "  "), (13, " ".join(item)), (None, "zzz")], ITEMS
    )
    docs = saved(spark.createDataFrame(rows, DOCS), tmp_path / "docs")
    found = dc.find_leaks(docs, benchmark).collect()
    pairs = sorted(str((r["doc_id"], r["item_id"], r["distance"])) for r in found)
    expected = [(d, i, 0) for d in (1, 3, 3, None, 5) for i in (10, 13)]
    assert pairs == sorted(map(str, expected))
    kept = dc.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 4]


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc, "ITEM_BLOCK_BYTES", 10)
    benchmark = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta epsilon zeta")], ITEMS)
    docs = spark.createDataFrame([(1, "x delta epsilon zeta alpha beta gamma", "", "", 0)], DOCS)
    assert sorted(r["item_id"] for r in dc.find_leaks(docs, benchmark).collect()) == [1, 2]


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], ITEMS)
    assert dc.find_leaks(odd_docs(spark), nothing).count() == 0
    some = spark.createDataFrame([(1, "alpha beta")], ITEMS)
    assert dc.find_leaks(empty_docs(spark), some).count() == 0
    clash = odd_docs(spark).withColumnRenamed("source", "item_id").withColumnRenamed("lang", "_row")
    assert dc.find_leaks(clash, some).count() == 0
