import zlib

import pytest

from reviewcraft.llm import language_centroids as lc
from tests.llm.fixtures import DOCS, empty_docs, odd_docs, odd_rows

SMALL = lc.CentroidParams(slots=1 << 10, texts_per_language=50, centroids=2)


def two_languages(n=120):
    # Word lists of two invented languages.
    words = {"aa": ["lorem", "ipsum", "dolor", "sit"], "bb": ["kzyx", "wqvu", "zzor", "yxwk"]}
    return [
        (i, " ".join(words[lang][(i * k) % 4] for k in range(1, 12)), lang, "s", i)
        for i in range(n)
        for lang in (("aa", "bb")[i % 2],)
    ]


def test_held_out_accuracy_and_split(spark):
    docs = spark.createDataFrame(two_languages(), DOCS)
    found = lc.language_of_documents(docs, SMALL).collect()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 and not r["rejected"]


def test_held_out_labels_teach_nothing(spark):
    rows = two_languages()
    wrong = [
        (i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s, n)
        for i, t, lang, s, n in rows
    ]
    a = lc.language_of_documents(spark.createDataFrame(rows, DOCS), SMALL)
    b = lc.language_of_documents(spark.createDataFrame(wrong, DOCS), SMALL)
    columns = ["doc_id", "lang_pred", "score"]
    assert a.select(columns).exceptAll(b.select(columns)).isEmpty()


def test_rejection(spark):
    model = lc.train_centroids(spark.createDataFrame(two_languages(), DOCS), SMALL)
    assert model.predict(("漢字" * 30).encode())[2]
    assert model.predict(None) == ("und", 0.0, True)
    assert model.predict("123 -- !".encode()) == ("und", 0.0, True)
    assert not model.predict("lorem ipsum".encode())[2]


def test_odd_rows(spark):
    found = lc.language_of_documents(odd_docs(spark), SMALL).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)


def test_sample_has_a_bound_for_each_language(spark):
    bounded = lc.CentroidParams(slots=1 << 10, texts_per_language=5, centroids=3)
    model = lc.train_centroids(spark.createDataFrame(two_languages(), DOCS), bounded)
    assert model.languages == ["aa", "bb"] and len(model.owner) == 6


def test_empty_and_clashing_columns(spark):
    assert lc.language_of_documents(empty_docs(spark), SMALL).count() == 0
    clash = odd_docs(spark).withColumnRenamed("source", "score").withColumnRenamed("n_chars", "_n")
    found = lc.language_of_documents(clash, SMALL)
    assert found.columns.count("score") == 1 and found.count() == len(odd_rows())
    nothing = lc.train_centroids(empty_docs(spark), SMALL)
    assert nothing.predict(b"some text") == ("und", 0.0, True)


@pytest.mark.parametrize("text", ["", "a", "Éa é", "x y  z", "ab" * 500])
def test_grams_against_plain_counts(text):
    used, counts, n = lc.gram_counts(text.encode(), 1 << 13)
    plain = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    plain = " " + " ".join(plain.split()) + " " if plain.split() else ""
    assert n == sum(c.isalpha() for c in text.lower())
    grams = [plain[i : i + k] for k in (1, 2, 3) for i in range(len(plain) - k + 1)]
    assert counts.sum() == len(grams)
    assert len(used) <= len(set(grams))


def test_single_labelled_texts_do_not_loosen_the_rejection(spark):
    one = lc.CentroidParams(slots=1 << 10, texts_per_language=200, centroids=1)
    junk = [(900, "漢字" * 30, "aa", "s", 1), (901, "ж", "bb", "s", 1)]
    clean = lc.train_centroids(spark.createDataFrame(two_languages(), DOCS), one)
    model = lc.train_centroids(spark.createDataFrame(two_languages() + junk, DOCS), one)
    assert (model.radius > 0.8 * clean.radius).all() and (model.radius > 0.2).all()
    assert model.predict(("дом" * 30).encode())[2]
    assert not model.predict(b"kzyx wqvu zzor yxwk kzyx wqvu")[2]
