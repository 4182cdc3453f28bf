"""Detection by accuracy on rows kept out of training; translation backends; allow list."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewcraft.functions.grams import count_word_grams, text_grams
from reviewcraft.operators import language as lg
from reviewcraft.operators import translation as tr
from reviewcraft.operators.ranking import ranked_in_groups
from reviewcraft.plans.stages import CleaningParams, clean_reviews

DATA = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(DATA).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(5)))


@pytest.fixture(scope="module")
def detector(documents):
    return lg.LanguageDetector.train(documents.filter("part <> 0"), "text", "lang")


def test_accuracy_on_unseen_rows(documents, detector):
    unseen = detector.detect(documents.filter("part = 0"), "text")
    right, n = unseen.agg(F.count_if(F.col("lang") == F.col("detected_lang")), F.count("*")).first()
    assert n >= 20 and right / n >= 0.95


def test_unusable_texts_are_unknown(spark, detector):
    texts = [None, "", "  ", "ab", " a ", "123 !!! 456", "مطعم ممتاز"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["detected_lang"] for r in detector.detect(df, "text").collect()} == {"unknown"}


def test_slices_do_not_change_scores(documents, detector, monkeypatch):
    texts = [f" {r['text'].lower()} " for r in documents.select("text").limit(50).collect()] + ["", "x"]
    whole = lg._best_language(texts, detector.grams, detector.weights)
    monkeypatch.setattr(lg, "_SLICE_CHARS", 10)
    assert np.array_equal(whole, lg._best_language(texts, detector.grams, detector.weights))


def test_saved_profile_is_the_same(spark, documents, detector, tmp_path):
    profile = lg.train_profile(documents.filter("part <> 0"), "text", "lang")
    profile.write.parquet(str(tmp_path / "profile"))
    loaded = lg.LanguageDetector.load(spark, str(tmp_path / "profile"))
    assert loaded.languages == detector.languages == ["de", "en", "es", "fr"]
    assert np.array_equal(loaded.grams, detector.grams)
    assert np.array_equal(loaded.weights, detector.weights)


def test_every_gram_counts(spark):
    rng = np.random.default_rng(5)
    letters = [chr(0x4E00 + i) for i in range(20_000)]
    words = ["".join(letters[i] for i in rng.integers(0, 20_000, 10)) for _ in range(16_000)]
    plain = {w[i : i + n] for w in (f" {w} " for w in words) for n in (1, 2, 3) for i in range(13 - n)}
    plain.discard(" ")
    rows = [(" ".join(words[i : i + 100]), "zz") for i in range(0, len(words), 100)]
    trained = lg.LanguageDetector.train(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert len(plain) > 1 << 18 and trained.grams.shape == (len(plain),)


def test_a_profile_that_is_too_large_is_an_error(documents, monkeypatch):
    monkeypatch.setattr(lg, "MAX_WEIGHTS", 100)
    with pytest.raises(ValueError, match="weights"):
        lg.LanguageDetector.train(documents, "text", "lang")


def test_scoring_needs_no_shuffle(documents, detector):
    plan = detector.detect(documents, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_allowed_languages():
    assert lg.allowed_languages() == ["ar", "en", "tr"]


# --- translation -------------------------------------------------------------

ROWS = [(1, "tr", "iyi"), (2, "en", "good"), (3, "ar", "جيد"), (4, "de", "gut")]


def table(spark, copies=1):
    rows = [(i + 10 * c, lang, text) for c in range(copies) for i, lang, text in ROWS]
    return spark.createDataFrame(rows, "review_id int, detected_lang string, review_text string")


def results(df):
    return {r["review_id"]: (r["is_translated"], r["cleaned_text"]) for r in df.collect()}


def test_without_backend_text_passes_but_is_flagged(spark):
    assert results(tr.translate_foreign(table(spark), "review_text")) == {
        1: (False, "iyi"), 2: (True, "good"), 3: (True, "جيد"), 4: (True, "gut"),
    }


def make_backend():
    def backend(texts, source, target):
        assert 0 < len(texts) <= 64
        return [f"{source}-{target}:{t}" for t in texts]

    return backend


def test_backend_gets_batches_of_supported_languages(spark):
    got = results(tr.translate_foreign(table(spark, 200).coalesce(1), "review_text", backend=make_backend))
    assert got[1] == (False, "iyi") and got[2] == (True, "en-tr:good")
    assert got[3] == (True, "ar-tr:جيد") and got[4] == (True, "gut")
    assert len(got) == 800


def test_backend_must_keep_the_number_of_texts(spark):
    broken = tr.translate_foreign(table(spark), "review_text", backend=lambda: lambda t, s, g: t[1:])
    with pytest.raises(Exception, match="changed the number of texts"):
        broken.collect()


def test_glossary(spark):
    glossary = spark.createDataFrame([("en", "good", "iyi")], "lang string, token string, translation string")
    df = spark.createDataFrame(
        [(1, "en", "good  food good"), (2, "de", "good"), (3, "en", "")],
        "review_id int, detected_lang string, review_text string",
    )
    got = tr.glossary_translate(df, glossary, "review_text", ["review_id"])
    assert {tuple(r) for r in got.collect()} == {(1, "iyi food iyi"), (2, "good"), (3, "")}


def test_cleaning_stage(spark, documents, detector):
    raw = documents.filter("part = 0").select(
        "doc_id", F.concat(F.lit("<p>"), "text", F.lit("</p> http://x.y/z")).alias("review_text"), "lang"
    )
    blanks = spark.createDataFrame([(-1, None, "en"), (-2, "  ", "en"), (-3, "<b>", "en")], raw.schema)
    params = CleaningParams(target_lang="en", translatable=("de",), backend=make_backend)
    rows = clean_reviews(raw.unionByName(blanks), detector, params).collect()
    assert {r["detected_lang"] for r in rows} == {"en", "de"}
    for r in rows:
        assert r["is_translated"] == (r["detected_lang"] == "de")
        assert r["cleaned_text"].startswith("de-en:") == r["is_translated"]
        assert "<p>" in r["raw_text"] and "<p>" not in r["review_text"] and "http" not in r["review_text"]


def test_texts_and_translations_are_cut():
    assert tr.cut_tokens("a  b\tc d ", 2) == ("a  b", 2)
    assert tr.cut_tokens(" a b ", 2) == (" a b ", 2)
    assert tr.cut_tokens("", 2) == ("", 0)
    assert tr.cut_tokens("a b c", None) == ("a b c", 3)


def test_calls_hold_texts_of_like_length_within_a_budget():
    policy = tr.BatchPolicy(texts=4, padded_tokens=20)
    lengths = [0, 1, 1, 2, 2, 6, 6, 6, 30]
    runs = list(tr.call_sizes(lengths, policy))
    assert runs == [(0, 4), (4, 7), (7, 8), (8, 9)]
    assert list(tr.call_sizes([], policy)) == []


def test_order_of_texts_survives_sorted_calls(spark):
    seen = []

    def backend(texts, source, target):
        sizes = [len(t.split()) for t in texts]
        assert sizes == sorted(sizes) and len(texts) <= 3 and max(sizes) <= 5
        return [t.upper() + " x y z" for t in texts]

    rows = [(i, "w " * (i * 7 % 11) + f"t{i}", "en") for i in range(40)] + [(99, None, "en")]
    df = spark.createDataFrame(rows, "id long, text string, detected_lang string").coalesce(1)
    policy = tr.BatchPolicy(texts=3, max_tokens=5)
    done = tr.translate_foreign(df, "text", "tr", lambda: backend, ["en"], policy)
    for row in done.collect():
        if row["text"] is not None:
            words = " ".join(row["text"].split()[:5]).upper().split() + ["x", "y", "z"]
            assert row["cleaned_text"].split() == words[:5]


@pytest.mark.parametrize("hot", [1_000_000, 2])
def test_large_glossaries_are_joined(spark, monkeypatch, hot):
    """Both ways give the same, with hot words dealt over groups or not."""
    rows = [(i, f"der hund {i} der  x{i % 7}\u00a0der", "de" if i % 5 else "fr") for i in range(60)]
    rows += [(70, "", "de"), (71, None, "de"), (72, "der", None)]
    df = spark.createDataFrame(rows, "id long, text string, detected_lang string")
    words = [("de", "der", "the"), ("de", "hund", "dog"), ("fr", "x1", "un"), ("de", "x2", "zwei")]
    glossary = spark.createDataFrame(words, "lang string, token string, translation string")
    key = lambda d: sorted(map(tuple, d.collect()))
    whole = key(tr.glossary_translate(df, glossary, "text", ["id"]))
    monkeypatch.setattr(tr, "GLOSSARY_WORDS", 1)
    monkeypatch.setattr(tr, "HOT_WORD_TEXTS", hot)
    joined = tr.glossary_translate(df, glossary, "text", ["id"])
    assert key(joined) == whole
    assert whole[1] == (1, "the dog 1 the x1 the")


def test_ranks_in_groups(spark):
    rows = [("a" if i % 3 else "b", i * 37 % 101) for i in range(101)] + [(None, 5), (None, 5)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(6)
    found = ranked_in_groups(df, "g", [F.col("v").desc()])
    assert found.columns == ["g", "v", "rank"]
    got = [tuple(r) for r in found.orderBy("g", "rank").collect()]
    wanted = []
    for g in (None, "a", "b"):
        values = sorted((v for x, v in rows if x == g), reverse=True)
        wanted += [(g, v, i) for i, v in enumerate(values, 1)]
    assert got == wanted


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_sliced_profiles_give_the_same_labels(spark, documents, detector, slices):
    taught = documents.filter("part <> 0")
    profile = lg.train_profile(taught, "text", "lang").cache()
    sliced = lg.SlicedDetector(profile, max_weights=-(-profile.count() // slices))
    assert sliced.slices >= slices - 1
    odd = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "12 34"), (-4, "ab"), (-5, "漢字漢字"), (-5, "漢字漢字")], "doc_id long, text string"
    )
    rows = documents.select("doc_id", "text").unionByName(odd).withColumn("detected_lang", F.lit("old"))
    wanted = sorted(map(tuple, detector.detect(rows, "text").select("doc_id", "detected_lang").collect()))
    found = sliced.detect(rows, "text")
    assert found.columns == rows.columns
    assert sorted(map(tuple, found.select("doc_id", "detected_lang").collect())) == wanted


def test_large_profiles_are_loaded_as_slices(spark, documents, tmp_path, monkeypatch):
    lg.train_profile(documents, "text", "lang").write.parquet(str(tmp_path / "model"))
    assert isinstance(lg.LanguageDetector.load(spark, str(tmp_path / "model")), lg.LanguageDetector)
    monkeypatch.setattr(lg, "MAX_WEIGHTS", 5000)
    large = lg.LanguageDetector.load(spark, str(tmp_path / "model"))
    assert isinstance(large, lg.SlicedDetector) and large.slices > 1
    with pytest.raises(ValueError, match="needs a batch"):
        stream = spark.readStream.schema("text string").parquet(str(tmp_path / "model"))
        large.detect(stream, "text")


def test_words_of_texts_are_looked_up_once(monkeypatch):
    """Sums over distinct words are those over all grams, and equal words cost no second look."""
    words = ["a", "bc", "été", "漢字", "word", "longer"]
    counted = next(count_word_grams(iter([pd.DataFrame({"lang": "x", "word": words, "n": 1})])))
    grams = np.sort(counted["gram"].to_numpy())
    weights = np.array([np.arange(len(grams)), -7 * np.arange(len(grams))], dtype=np.int64)
    texts = ["", " ", *(" " + " ".join(words[: i % 7]) + " zz été " for i in range(500))]
    wanted = lg._score_slice(texts, grams, weights)
    looked_up = []
    score = lg._score_slice
    monkeypatch.setattr(lg, "_score_slice", lambda t, *rest: looked_up.extend(t) or score(t, *rest))
    found = lg._sums(texts, grams, weights)
    assert all(np.array_equal(a, b) for a, b in zip(found, wanted, strict=True))
    assert len(looked_up) <= len(words) + 2
    # a foreign profile may have grams across words: then all grams are looked up
    across = text_grams(np.array([ord("a"), ord(" "), ord("b")], dtype=np.uint32))[2][:1]
    grams, weights = np.append(grams, across), np.hstack([weights, weights[:, :1]])
    order = np.argsort(grams)
    grams, weights = grams[order], weights[:, order]
    wanted = score([" a bc "], grams, weights)
    found = lg._sums([" a bc "], grams, weights)
    assert all(np.array_equal(a, b) for a, b in zip(found, wanted, strict=True))


def test_batches_for_a_backend_are_bounded_by_bytes(spark):
    seen = spark.sparkContext.accumulator(0)

    def backend():
        def call(texts, source, target):
            seen.add(len(texts))
            return [str(len(texts))] * len(texts)

        return call

    rows = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('long text ', 100000) AS text", "'en' AS detected_lang")
    policy = tr.BatchPolicy(texts=1000, max_tokens=None, padded_tokens=1 << 40)
    done = tr.translate_foreign(rows, "text", "tr", backend, ["en"], policy)
    sizes = [int(r["cleaned_text"]) for r in done.select("cleaned_text").collect()]
    # texts of 1 MB
    assert max(sizes) <= 10 and seen.value == 40


def test_large_glossaries_meet_runs_of_texts(spark, monkeypatch):
    """A word of many texts is looked up once a run, and rows with equal keys stay."""
    monkeypatch.setattr(tr, "GLOSSARY_WORDS", 0)
    rows = [(i // 2, "der hund  der", "de") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, detected_lang string").coalesce(1)
    words = [("de", "der", "the"), ("de", "hund", None)]
    glossary = spark.createDataFrame(words, "lang string, token string, translation string")
    distinct = tr._distinct_words
    counted = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in distinct(batches):
            counted.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(tr, "_distinct_words", watched)
    found = tr.glossary_translate(df, glossary, "text", ["id"]).collect()
    assert sorted(map(tuple, found)) == [(i // 2, "the hund the") for i in range(200)]
    assert counted.value == 2
