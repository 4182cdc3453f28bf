import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewcraft.llm import suffix_dedup
from reviewcraft.llm.gsaca import suffix_array
from tests.llm.fixtures import DOCS, empty_docs, odd_docs, odd_rows, saved, words


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def plain(texts, n=400):
    """Covered bytes of each text, from every window."""
    seen = {}
    for text in texts:
        for s in range(len(text) - n + 1):
            seen[text[s : s + n]] = seen.get(text[s : s + n], 0) + 1
    out = []
    for text in texts:
        covered = bytearray(len(text))
        for s in range(len(text) - n + 1):
            if seen[text[s : s + n]] > 1:
                covered[s : s + n] = b"\x01" * n
        out.append(bytes(b for b, c in zip(text, covered, strict=True) if not c))
    return out


def check(docs, rows, length=400):
    expected = plain([(r[1] or "").encode() for r in rows], length)
    want = sorted(
        str((r[0], len((r[1] or "").encode()), hashlib.sha256(k).hexdigest()))
        for r, k in zip(rows, expected, strict=True)
    )
    windows = suffix_dedup.Windows(length)
    found = suffix_dedup.remove_repeats(docs, windows=windows).collect()
    got = sorted(str((r["doc_id"], r["n_bytes"], hashlib.sha256(r["kept"]).hexdigest())) for r in found)
    assert got == want
    for r in found:
        runs = [(s["from"], s["to"]) for s in r["removed_spans"]]
        assert sum(b - a for a, b in runs) == r["n_removed"]
        assert all(x[1] < y[0] for x, y in zip(runs[:-1], runs[1:], strict=True))


def edge_rows():
    """Passages of just under, exactly and just over the length, cut at many places."""
    rng = random.Random(4)
    passage = words(rng, 200)
    rows = []
    for i, n in enumerate((398, 399, 400, 401, 430, 431, 500, 700)):
        for k in range(3):
            start = (17 * i + 31 * k) % 200
            rows.append((len(rows), f"{words(rng, 50 + k)}|{passage[start : start + n]}|{words(rng, 50)}", "", "", 0))
    rows.append((900, "x" * 1500, "", "", 0))
    rows.append((901, "abcdefg" * 200, "", "", 0))
    rows.append((902, "é" * 700, "", "", 0))
    return rows


def test_against_all_windows(spark, tmp_path):
    check(saved(odd_docs(spark), tmp_path / "odd"), odd_rows())


def test_edges_of_passages(spark, tmp_path):
    rows = edge_rows()
    check(saved(spark.createDataFrame(rows, DOCS), tmp_path / "edges"), rows)


@pytest.mark.parametrize("length", [64, 100, 240])
def test_other_lengths(spark, tmp_path, length):
    rng = random.Random(length)
    passage = words(rng, 150)
    rows = [
        (i, f"{words(rng, 30)}|{passage[7 * i : 7 * i + length + i - 5]}|{words(rng, 30)}", "", "", 0)
        for i in range(20)
    ]
    rows += odd_rows()
    check(saved(spark.createDataFrame(rows, DOCS), tmp_path / "docs"), rows, length)


def test_hot_buckets_are_dealt_and_lose_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CELL_MEMBERS", 2)
    rows = edge_rows()
    check(saved(spark.createDataFrame(rows, DOCS), tmp_path / "hot"), rows)


def test_long_texts_are_searched_in_chunks(monkeypatch):
    rng = random.Random(9)
    text = words(rng, 3000).encode()
    whole = [x.tolist() for x in suffix_dedup.anchors(text)]
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 1000)
    at, first, last = suffix_dedup.anchors(text)
    assert set(at.tolist()) >= set(whole[0])
    assert first[0] == 0 and last[-1] == len(text) - 400
    assert ((at - first) < suffix_dedup.SPREAD).all() and (at >= last).all()


def test_text_form_and_clashing_columns(spark, tmp_path):
    rows = odd_rows()
    docs = saved(odd_docs(spark).withColumnRenamed("source", "kept"), tmp_path / "clash")
    assert suffix_dedup.remove_repeats(docs).count() == len(rows)
    docs = saved(odd_docs(spark), tmp_path / "docs")
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns
    found = {r["doc_id"]: r for r in cut.collect()}
    assert found[500]["text"] is None and found[300]["text"] == ""
    assert found[300]["n_chars"] == 0 and found[0]["n_chars"] == 1


def test_empty(spark, tmp_path):
    docs = saved(empty_docs(spark), tmp_path / "none")
    assert suffix_dedup.remove_repeats(docs).count() == 0
