import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewcraft.llm import imatch
from tests.llm.fixtures import DOCS, empty_docs, odd_rows, saved, words


def plain_hashes(text):
    """Sorted hashes of the distinct words of a text, each character looked at by itself."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return sorted({xxhash.xxh3_64_intdigest(w.encode()) for w in found})


def plain_results(rows, lexicon):
    ordered = sorted(
        ((i is not None, i or 0, t or "") for i, t in rows), key=lambda r: (r[0], r[1])
    )
    marks = {}

    def mark(text):
        if text not in marks:
            hashes = np.array(plain_hashes(text), dtype=np.uint64)
            known = imatch.is_set(lexicon, imatch._cell(hashes, 8 * len(lexicon)))
            marks[text] = imatch.fingerprint(hashes, known)
        return marks[text]

    out = []
    for (_, i, text), (_, _, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        out.append(
            (
                i, len(text), hashlib.sha256(changed.encode()).hexdigest(), mark(text), mark(changed),
                imatch.likeness(mark(text), mark(changed)), imatch.likeness(mark(text), mark(following)),
            )
        )
    return sorted(out)


def test_lexicon_is_the_band(spark, tmp_path):
    rows = odd_rows()
    docs = saved(spark.createDataFrame(rows, DOCS), tmp_path / "docs")
    lexicon = imatch.learn_lexicon(docs)
    df = Counter()
    for row in rows:
        df.update(plain_hashes(row[1]))
    hashes = np.array(list(df), dtype=np.uint64)
    cells = imatch._cell(hashes, imatch.LexiconParams.cells)
    assert len(set(cells.tolist())) == len(df)
    wanted = [2 <= n <= len(rows) // 8 for n in df.values()]
    assert imatch.is_set(lexicon, cells).tolist() == wanted
    assert np.unpackbits(lexicon).sum() == sum(wanted)


def test_equals_plain_version(spark, tmp_path):
    """Odd rows with unique ids, so that the order is defined."""
    rows = [r for r in odd_rows() if r[0] is not None and r[1] != "same id, other text"]
    rows = list({r[0]: r for r in rows}.values())
    docs = saved(
        spark.createDataFrame(rows, DOCS).withColumn("utf8", F.lit("x")).withColumn("row", F.lit(1)),
        tmp_path / "docs",
    )
    lexicon = imatch.learn_lexicon(docs)
    got = sorted(tuple(r) for r in imatch.compare_with_edits(docs, lexicon).collect())
    assert got == plain_results([r[:2] for r in rows], lexicon)


def test_null_and_repeated_ids(spark, tmp_path):
    rows = odd_rows()
    docs = saved(spark.createDataFrame(rows, DOCS), tmp_path / "docs")
    got = imatch.compare_with_edits(docs, imatch.learn_lexicon(docs)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(None not in tuple(r)[1:] for r in got)


def test_likeness_tells_edits_from_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = imatch.compare_with_edits(docs, imatch.learn_lexicon(docs)).toPandas()
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    texts = got[got.n_chars >= 100]
    assert (texts.near_edited > texts.near_next).mean() > 0.95


def test_equal_texts_have_equal_fingerprints(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, words(rng, 50), "en", "s", 1) for i in range(40)]
    rows += [(100 + i, "copy of a text", "en", "s", 1) for i in range(30)]
    docs = saved(spark.createDataFrame(rows, DOCS), tmp_path / "docs")
    got = imatch.compare_with_edits(docs, imatch.learn_lexicon(docs)).toPandas()
    copies = got[got.doc_id >= 100].sort_values("doc_id")
    assert copies.fingerprint.nunique() == 1 and (copies.near_next[:-1] == 1.0).all()


def test_ranges_meet_at_their_ends(spark, tmp_path):
    """One document a range, and ranges without any."""
    rows = [(i, f"text number {i} " * (i + 1), "en", "s", 1) for i in range(12)]
    docs = saved(spark.createDataFrame(rows, DOCS), tmp_path / "docs")
    lexicon = imatch.learn_lexicon(docs)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = [spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")]
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        got = sorted(tuple(r) for r in imatch.compare_with_edits(docs, lexicon).collect())
    finally:
        spark.conf.set(key, before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert got == plain_results([r[:2] for r in rows], lexicon)


@pytest.mark.parametrize("text", ["one text", "", None])
def test_single_document_follows_itself(spark, tmp_path, text):
    docs = saved(spark.createDataFrame([(1, text, "en", "s", 1)], DOCS), tmp_path / "docs")
    (row,) = imatch.compare_with_edits(docs, imatch.learn_lexicon(docs)).collect()
    assert row["near_next"] == 1.0 and row["n_chars"] == len(text or "")


def test_empty_documents(spark):
    docs = empty_docs(spark)
    assert imatch.compare_with_edits(docs, imatch.learn_lexicon(docs)).count() == 0
    assert imatch.with_fingerprints(docs, imatch.learn_lexicon(docs)).count() == 0


def test_fingerprints_as_a_column(spark, tmp_path):
    docs = saved(spark.createDataFrame(odd_rows(), DOCS), tmp_path / "docs")
    lexicon = imatch.learn_lexicon(docs)
    got = imatch.with_fingerprints(docs.withColumn("fingerprint", F.lit(0)), lexicon).collect()
    for row in got:
        hashes = np.array(plain_hashes(row["text"]), dtype=np.uint64)
        known = imatch.is_set(lexicon, imatch._cell(hashes, 8 * len(lexicon)))
        assert row["fingerprint"] == imatch.fingerprint(hashes, known)
