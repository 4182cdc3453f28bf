from collections import defaultdict
from itertools import combinations

import xxhash

from reviewcraft.llm import simhash
from tests.llm.fixtures import DOCS, empty_docs, odd_docs, odd_rows, saved


def plain_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4 and label[i] != label[j]:
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for row, x in zip(rows, label, strict=True):
        if row[0] is not None:
            ids[x].append(row[0])
    return [(p, min(ids[x], default=None)) for p, x in zip(prints, label, strict=True)], len(set(label))


def test_every_four_positions_hold_a_triple():
    assert all(
        any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4)
    )


def test_against_all_pairs(spark):
    rows = odd_rows()
    found = simhash.near_duplicates(odd_docs(spark)).collect()
    expected = [
        (r[0], f"{p:016x}", c) for r, (p, c) in zip(rows, plain_components(rows)[0], strict=True)
    ]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found)


def test_hot_lists_are_dealt_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LIST_ROWS", 3)
    rows = [(i, "a b c d " + " ".join("xyz"[(i >> k) & 1] for k in range(3)), "", "", 0) for i in range(8)]
    rows += odd_rows()
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    expected = [(r[0], f"{p:016x}", c) for r, (p, c) in zip(rows, plain_components(rows)[0], strict=True)]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found)


def test_dense_group_is_one_component():
    import numpy as np

    near = np.array([1 << i for i in range(40)] + [0], dtype=np.uint64)
    edges = [e for a, b in simhash.stars(near, None) for e in zip(a.tolist(), b.tolist(), strict=True)]
    assert len(edges) == 40


def test_one_of_each_group(spark, tmp_path):
    docs = saved(odd_docs(spark), tmp_path / "docs")
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == plain_components(odd_rows())[1]
    ids = [r["doc_id"] for r in kept.collect()]
    assert 200 in ids and 201 not in ids and 300 in ids and 301 not in ids


def test_empty_and_clashing_columns(spark, tmp_path):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    clash = odd_docs(spark).withColumnRenamed("lang", "print").withColumnRenamed("source", "root")
    assert simhash.near_duplicates(clash).count() == len(odd_rows())
    kept = simhash.one_of_each_group(saved(clash, tmp_path / "clash"))
    assert "print" in kept.columns and kept.count() > 0
