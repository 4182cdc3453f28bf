"""Registered queries: every operator run over the whole given tables.

The given tables hold no reviews, so ``documents`` stands in for them: a
document is a review, and a place holds runs of neighbouring documents whose
length grows with the place's number, so that small, ordinary and large places
all occur. ``pages`` stands in for raw text with markup, ``conversations`` for
finished question-and-answer pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft import schemas
from reviewcraft.functions import normalize as nz
from reviewcraft.functions import text as tx
from reviewcraft.operators import cleaning, context, enrichment, finetune, inspection
from reviewcraft.operators import normalization, quality, translation
from reviewcraft.operators.language import (
    LanguageDetector,
    SlicedDetector,
    keep_languages,
    train_profile,
)
from reviewcraft.plans import jobs
from reviewcraft.plans.stages import CleaningParams, clean_reviews, curate_reviews, training_text
from reviewcraft.session import file_size, plain_path, shared_folder
from reviewcraft.sources import jsonl, tables
from reviewcraft.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

# the given texts are German, English, Spanish and French
TARGET = "en"
TRANSLATABLE = ("de", "fr")
DAILY_SHARE = 10

# --- tables ------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts are going to be worked on."""
    return tables.spread(table(spark, sf_dir, name))


def reviews(spark: SparkSession, sf_dir: str, read=texts) -> DataFrame:
    place = "cast(floor(sqrt(doc_id)) AS bigint)"
    return read(spark, sf_dir, "documents").selectExpr(
        "doc_id AS review_id",
        f"concat('place_', {place}) AS place_id",
        f"concat('Place ', {place}) AS place_name",
        "CASE doc_id % 3 WHEN 0 THEN 'cafe' WHEN 1 THEN 'restaurant' ELSE 'bakery' END AS category",
        "cast(n_chars % 5 + 1 AS double) AS rating",
        "lang AS detected_lang",
        "text AS cleaned_text",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).drop("detected_lang").withColumnRenamed(
        "cleaned_text", "review_text"
    )


def marked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address and page source as one text."""
    return texts(spark, sf_dir, "pages").select(
        "page_id", F.concat_ws(" ", "url", "html").alias("review_text")
    )


def patchy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label; text is null without one, blank if toxic, else padded."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    text = (
        F.when(F.col("toxic").isNull(), F.lit(None).cast("string"))
        .when(F.col("toxic") == 1, F.lit(fv.WHITESPACE_CHARS))
        .otherwise(F.concat(F.lit("  \x1c"), F.col("text"), F.lit("\n ")))
    )
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .select("doc_id", text.alias("review_text"))
    )


def answered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn with the assistant's next one, as a summary record."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    answers = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answers, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("place_id"),
        F.col("asked").alias("input_context"),
        F.col("answer").alias("target_summary"),
    )


def detector(spark: SparkSession, sf_dir: str) -> LanguageDetector:
    """Trained on four fifths of the documents; the others are held out."""
    taught = texts(spark, sf_dir, "documents").filter(F.col("doc_id") % 5 != 0)
    return LanguageDetector.train(taught, "text", "lang")


# --- cleaning ----------------------------------------------------------------


def remove_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.remove_nulls(patchy_texts(spark, sf_dir), "review_text")


def _on_pages(change: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return marked_up(spark, sf_dir).select(
            "page_id", change(F.col("review_text")).alias("review_text")
        )

    return query


def clean_text_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_text_basic(marked_up(spark, sf_dir), "review_text")


def detect_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return detector(spark, sf_dir).detect(documents, "text").select(
        "doc_id", "lang", "detected_lang"
    )


def detector_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out documents by language, and how many are recognized."""
    held_out = texts(spark, sf_dir, "documents").filter(F.col("doc_id") % 5 == 0)
    found = detector(spark, sf_dir).detect(held_out.select("doc_id", "text", "lang"), "text")
    return found.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("detected_lang") == F.col("lang")).alias("n_right"),
    )


def detect_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = texts(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return detector(spark, sf_dir).detect(turns, "text").select(
        "conv_id", "turn", "detected_lang"
    )


def language_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_languages(reviews(spark, sf_dir), TARGET, TRANSLATABLE).select(
        "review_id", "detected_lang"
    )


def translation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir).withColumnRenamed("cleaned_text", "review_text")
    return translation.translate_foreign(
        raw, "review_text", TARGET, translatable=TRANSLATABLE
    ).select("review_id", "is_translated", "cleaned_text")


def _tagging_backend() -> translation.Backend:
    return lambda texts, source, target: [f"[{source}>{target}] {text}" for text in texts]


def translate_with_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir).withColumnRenamed("cleaned_text", "review_text")
    return translation.translate_foreign(
        raw,
        "review_text",
        TARGET,
        _tagging_backend,
        TRANSLATABLE,
        translation.BatchPolicy(max_tokens=None),
    ).select("review_id", "is_translated", "cleaned_text")


def translate_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with texts and translations cut as a model of limited length does."""
    raw = reviews(spark, sf_dir).withColumnRenamed("cleaned_text", "review_text")
    return translation.translate_foreign(
        raw, "review_text", TARGET, _tagging_backend, TRANSLATABLE
    ).select("review_id", "is_translated", "cleaned_text")


def translate_with_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = shared_folder(spark, "glossary") + "/glossary"
    tables.write_parquet(
        translation.frequency_glossary(documents, "text", "lang", TARGET), path
    )
    # as a table, its size is known: Spark broadcasts it if it is small
    glossary = tables.read_parquet(spark, path)
    foreign = documents.filter(F.col("lang") != TARGET)
    return translation.glossary_translate(
        foreign, glossary, "text", ["doc_id"], "lang", "cleaned_text"
    )


def cleaned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = CleaningParams(target_lang=TARGET, translatable=TRANSLATABLE)
    return clean_reviews(marked_up(spark, sf_dir), detector(spark, sf_dir), params)


def resumable_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files, cleaned in increments over two runs; the second finds nothing to do."""
    work = shared_folder(spark, "resumable")
    raw = f"{work}/raw"
    tables.write_parquet(raw_reviews(spark, sf_dir), raw)
    params = CleaningParams(target_lang=TARGET, translatable=TRANSLATABLE)
    model = detector(spark, sf_dir)
    for _ in range(2):
        incremental.run_available(
            spark,
            raw,
            spark.read.parquet(raw).schema,
            lambda df: clean_reviews(df, model, params),
            f"{work}/staging",
            f"{work}/progress",
            max_files_per_batch=4,
        )
    incremental.combine(spark, f"{work}/staging", f"{work}/cleaned")
    return tables.read_parquet(spark, f"{work}/cleaned").select(
        "review_id", "place_id", "rating", "raw_text", "detected_lang", "is_translated",
        "cleaned_text",
    )


def clean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the cleaning job over two runs, as its batches observed them."""
    work = shared_folder(spark, "clean-metrics")
    tables.write_parquet(raw_reviews(spark, sf_dir), f"{work}/raw")
    documents = texts(spark, sf_dir, "documents").filter(F.col("doc_id") % 5 != 0)
    tables.write_parquet(documents, f"{work}/labelled")
    jobs.train_detector(spark, f"{work}/labelled", f"{work}/model", "text", "lang")
    params = CleaningParams(target_lang=TARGET, translatable=TRANSLATABLE)
    found = [
        jobs.clean(
            spark, f"{work}/raw", f"{work}/cleaned", f"{work}/model", f"{work}/work", params, 3
        )
        for _ in range(2)
    ]
    names = ("rows_in", "rows_out", "removed_blank", "removed_language")
    rows = [(run, name, metrics[name]) for run, metrics in enumerate(found, 1) for name in names]
    return spark.createDataFrame(rows, "run int, metric string, value long")


# --- normalization and quality -----------------------------------------------


def _on_documents(change: Callable[[Column], Column], name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir, "documents").select(
            "doc_id", change(F.col("text")).alias(name)
        )

    return query


def normalize_change_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalization.with_changes(reviews(spark, sf_dir)).groupBy("detected_lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("changed")).alias("n_changed")
    )


def normalize_change_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalization.change_samples(reviews(spark, sf_dir))


def char_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents").select(
        "doc_id", F.round(tx.char_entropy(F.col("text")), 6).alias("entropy")
    )


def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_reject_reason(reviews(spark, sf_dir)).select("review_id", "reject_reason")


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(reviews(spark, sf_dir)).select("review_id", "cleaned_text")


def quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected_rows(reviews(spark, sf_dir)).select(
        "review_id", "cleaned_text", "reject_reason"
    )


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(reviews(spark, sf_dir))


def curated_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.filter_columns(reviews(spark, sf_dir))


def curated_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_reviews(reviews(spark, sf_dir))


# --- contexts ----------------------------------------------------------------


def place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.place_counts(reviews(spark, sf_dir))


def approx_place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct places by category and of all, exact, and whether merged sketches come close."""
    rows = reviews(spark, sf_dir, table).select("place_id", "category", "review_id")
    work = shared_folder(spark, "sketches")
    # stored as each of several runs would, one table of sketches
    for run in range(3):
        part = rows.filter(F.pmod("review_id", F.lit(3)) == run)
        context.place_sketches(part, "category").write.mode("append").parquet(work)
    sketches = tables.read_parquet(spark, work)
    estimated = context.approx_places(sketches, "category").unionByName(
        context.approx_places(sketches).withColumn("category", F.lit("all"))
    )
    exact = rows.groupBy("category").agg(F.countDistinct("place_id").alias("n_places")).unionByName(
        rows.agg(F.countDistinct("place_id").alias("n_places")).withColumn("category", F.lit("all"))
    )
    # five standard errors, and one for the rounding
    bound = 5 * 1.04 / 2 ** (context.SKETCH_BITS / 2) * F.col("n_places") + 1
    return exact.join(estimated, "category").select(
        "category", "n_places", (F.abs(F.col("approx_places") - F.col("n_places")) <= bound).alias("close")
    )


def min_reviews_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.filter_min_reviews(
        reviews(spark, sf_dir).select("review_id", "place_id", "rating")
    )


def info_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.with_info_score(reviews(spark, sf_dir)).select(
        "review_id", "word_count", "info_score"
    )


def rating_alloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.rating_allocations(reviews(spark, sf_dir))


def stratified_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.sample_reviews(reviews(spark, sf_dir, table))


def place_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.place_metadata(reviews(spark, sf_dir))


def build_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    # not spread first: the plan reads the table more than once, and each branch would be
    return context.build_context(reviews(spark, sf_dir, table))


def build_context_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same contexts, ranked in groups of input tasks first, as for very many tasks."""
    return context.build_context(reviews(spark, sf_dir), context.ContextParams(salts=3))


def build_context_forty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated reviews, written as a table, with the job's larger sample."""
    path = shared_folder(spark, "curated") + "/reviews"
    tables.write_parquet(curated_reviews(spark, sf_dir), path)
    params = context.ContextParams(max_reviews=fv.JOB_MAX_REVIEWS_PER_PLACE)
    return context.build_context(tables.read_parquet(spark, path), params)


# --- enrichment --------------------------------------------------------------


def _completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places rated below 3 on average count as summarized earlier."""
    return place_metadata(spark, sf_dir).filter(F.col("avg_rating") < 3).select("place_id")


def pending_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.pending_contexts(build_context(spark, sf_dir), _completed(spark, sf_dir))


def daily_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.daily_share(pending_places(spark, sf_dir), DAILY_SHARE)


def enrich_extractive(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrichment.summarize_extractively(build_context(spark, sf_dir))
    return enrichment.summary_records(enriched)


def _fingerprint_backend() -> enrichment.Summarizer:
    return lambda prompt, text: hashlib.md5((prompt + text).encode()).hexdigest()


def enrich_with_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = spark.sparkContext.defaultParallelism
    policy = enrichment.CallPolicy(pause_seconds=0, concurrency=slots)
    enriched = enrichment.summarize_with_backend(
        build_context(spark, sf_dir), _fingerprint_backend, policy
    )
    return enrichment.summary_records(enriched)


def enrich_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of three runs: a day's share, all the rest, and a day with nothing to do."""
    work = shared_folder(spark, "progress")
    tables.write_parquet(build_context(spark, sf_dir), f"{work}/contexts")
    rows = []
    for run, limit in enumerate((DAILY_SHARE, 1 << 30, 1 << 30), 1):
        found = jobs.enrich(spark, f"{work}/contexts", f"{work}/summaries", limit=limit)
        rows.append((run, found["tried"], found["succeeded"]))
    return spark.createDataFrame(rows, "run int, tried bigint, succeeded bigint")


def enrich_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily runs over written tables until nothing is pending; each goes on after the last."""
    work = shared_folder(spark, "resumed")
    tables.write_parquet(build_context(spark, sf_dir), f"{work}/contexts")
    limit = DAILY_SHARE
    while jobs.enrich(spark, f"{work}/contexts", f"{work}/summaries", limit=limit)["tried"]:
        limit = fv.DAILY_LIMIT
    return jsonl.read_tolerant(spark, f"{work}/summaries", schemas.SUMMARIES, "place_id")


def _fails_once(mark: str) -> enrichment.SummarizerFactory:
    """A backend that refuses the contexts of one place."""

    def factory() -> enrichment.Summarizer:
        summarize = _fingerprint_backend()

        def call(prompt: str, text: str) -> str:
            if mark in hashlib.md5(text.encode()).hexdigest():
                raise ValueError(f"refused {mark}")
            return summarize(prompt, text)

        return call

    return factory


def enrich_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share of many parts through a backend: its summaries, and the number of parts."""
    work = shared_folder(spark, "parts")
    tables.write_parquet(build_context(spark, sf_dir), f"{work}/contexts")
    policy = enrichment.CallPolicy(pause_seconds=0, concurrency=2, calls_per_task=2)
    found = jobs.enrich(
        spark, f"{work}/contexts", f"{work}/summaries", _fingerprint_backend, policy=policy
    )
    records = jsonl.read_strict(spark, f"{work}/summaries", schemas.SUMMARIES)
    return records.withColumn("parts", F.lit(found["parts"]))


def enrich_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that a refusal stops, and one that finishes; with the first run's error."""
    work = shared_folder(spark, "failure")
    tables.write_parquet(build_context(spark, sf_dir), f"{work}/contexts")
    slots = min(4, spark.sparkContext.defaultParallelism)
    policy = enrichment.CallPolicy(
        pause_seconds=0, wait_seconds=0, concurrency=slots, calls_per_task=5
    )
    # the digest of one context that exists at every size
    worst = (
        tables.read_parquet(spark, f"{work}/contexts")
        .agg(F.max(F.md5("llm_input_context")))
        .first()[0]
    )
    paths = f"{work}/contexts", f"{work}/summaries"
    first = jobs.enrich(spark, *paths, _fails_once(worst), policy=policy)
    second = jobs.enrich(spark, *paths, _fingerprint_backend, policy=policy)
    everything = first["succeeded"] + second["succeeded"]
    return jsonl.read_strict(spark, paths[1], schemas.SUMMARIES).select(
        "place_id",
        "target_summary",
        F.lit(first["first_error"]).alias("first_error"),
        F.lit(everything).cast("long").alias("n_summaries"),
    )


def completed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from a JSON lines file in which every document's text is a broken line."""
    path = shared_folder(spark, "broken") + "/lines"
    records = reviews(spark, sf_dir).select(
        F.to_json(
            F.struct(
                "place_id",
                "place_name",
                F.col("cleaned_text").alias("input_context"),
                F.lit(None).cast("string").alias("target_summary"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )
    broken = table(spark, sf_dir, "documents").select(
        F.regexp_replace("text", "[\r\n]+", " ").alias("value")
    )
    records.unionByName(broken).write.text(path)
    return enrichment.completed_places(
        jsonl.read_tolerant(spark, path, schemas.SUMMARIES, "place_id")
    )


# --- fine-tuning data --------------------------------------------------------


def chat_messages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = finetune.to_chat_examples(answered_turns(spark, sf_dir), "place_id")
    return examples.select("place_id", F.to_json("messages").alias("messages"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat examples written as JSON lines, read back strictly, rendered."""
    path = shared_folder(spark, "chat") + "/examples"
    jsonl.overwrite(finetune.to_chat_examples(answered_turns(spark, sf_dir)), path)
    examples = jsonl.read_strict(spark, path, schemas.CHAT_EXAMPLES)
    return examples.select(finetune.render_chat(F.col("messages")).alias("text"))


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finetune.mark_test_rows(
        table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id"
    )


def train_test_split_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finetune.mark_test_rows(
        table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", exact=False
    )


def chat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries to the two chat files, read back with the side each is on."""
    work = shared_folder(spark, "chatfiles")
    jsonl.overwrite(
        answered_turns(spark, sf_dir).withColumn("place_name", F.col("place_id")),
        f"{work}/summaries",
    )
    jobs.prepare_chat(spark, f"{work}/summaries", f"{work}/train", f"{work}/test")

    def side(name: str) -> DataFrame:
        return jsonl.read_strict(spark, f"{work}/{name}", schemas.CHAT_EXAMPLES).select(
            F.lit(name).alias("side"), F.to_json("messages").alias("messages")
        )

    return side("train").unionByName(side("test"))


def chat_template_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = finetune.to_chat_examples(answered_turns(spark, sf_dir), "place_id")
    return examples.select("place_id", finetune.render_chat(F.col("messages")).alias("text"))


def chat_template_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations as training texts: a conversation is one record."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))
        ).alias("messages")
    )
    return turns.select("conv_id", finetune.render_chat(F.col("messages")).alias("text"))


def train_test_split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on both sides of a split in which every seventh row has no key."""
    documents = table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("key"), "doc_id", "lang"
    )
    train, test = finetune.train_test_split(documents, "key")
    return train.unionByName(test).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("key").isNull()).alias("n_null_keys")
    )


def chat_files_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one key, and records without, all come through to the chat files."""
    work = shared_folder(spark, "chatkeys")
    records = answered_turns(spark, sf_dir).withColumns(
        {
            "place_id": F.when(~F.col("place_id").endswith("-0"), F.lit("one")),
            "place_name": F.lit("any"),
        }
    )
    jsonl.overwrite(records, f"{work}/summaries")
    jobs.prepare_chat(spark, f"{work}/summaries", f"{work}/train", f"{work}/test", 0.5)
    both = [
        jsonl.read_strict(spark, f"{work}/{side}", schemas.CHAT_EXAMPLES)
        for side in ("train", "test")
    ]
    return both[0].unionByName(both[1]).select(F.to_json("messages").alias("messages"))


def length_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = finetune.to_chat_examples(answered_turns(spark, sf_dir), "place_id")
    return training_text(examples, 256).select("place_id", "approx_tokens", "fits")


def length_budget_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat texts made to fit 256 tokens by cutting their longest turns."""
    examples = finetune.to_chat_examples(answered_turns(spark, sf_dir), "place_id")
    fitted = examples.withColumn("messages", finetune.fit_messages(F.col("messages"), 256))
    return training_text(fitted, 256).select("place_id", "text", "approx_tokens", "fits")


def conversations_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations made to fit 200 tokens: lengths of their turns, in order."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))
        ).alias("turns")
    )
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    fitted = turns.withColumn("messages", finetune.fit_messages(messages, 200))
    lengths = F.transform("messages", lambda m: F.length(m["content"]).cast("string"))
    return fitted.select("conv_id", F.array_join(lengths, ",").alias("lengths"))


def detect_by_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled by a profile that is shared a slice at a time."""
    documents = texts(spark, sf_dir, "documents")
    taught = documents.filter(F.col("doc_id") % 5 != 0)
    path = shared_folder(spark, "profile")
    tables.write_parquet(train_profile(taught, "text", "lang"), path)
    profile = tables.read_parquet(spark, path)
    sliced = SlicedDetector(profile, max_weights=profile.count() // 3 + 1)
    rows = documents.select("doc_id", "text", "lang")
    return sliced.detect(rows, "text").select("doc_id", "lang", "detected_lang")


def compacted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of very unequal files made one table: its rows, and how many files were moved."""
    work = shared_folder(spark, "compacted")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    # one large file and many small ones
    large = rows.filter("l_linenumber <= 4").coalesce(1)
    large.write.mode("append").parquet(f"{work}/staging")
    rows.filter("l_linenumber > 4").repartition(12).write.mode("append").parquet(f"{work}/staging")
    files = spark.read.parquet(f"{work}/staging").inputFiles()
    sizes = [file_size(spark, plain_path(spark, f)) for f in files]
    found = incremental.combine(
        spark, f"{work}/staging", f"{work}/final", target_bytes=2 * max(sizes)
    )
    final = tables.read_parquet(spark, f"{work}/final")
    return final.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").cast("long").alias("quantity")
    ).withColumn("moved_files", F.lit(found["moved_files"]))


# --- inspection --------------------------------------------------------------


def source_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.count_rows(table(spark, sf_dir, "documents"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "parquet") + "/reviews"
    tables.write_parquet(reviews(spark, sf_dir), path, max_records_per_file=10_000)
    return tables.read_parquet(spark, path)


def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.summarize_table(translation_flags(spark, sf_dir))


def stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What curation observes while its result is written."""
    normalized, judged = Observation(), Observation()
    curated = curate_reviews(reviews(spark, sf_dir), normalized=normalized, judged=judged)
    tables.write_parquet(curated, shared_folder(spark, "metrics") + "/curated")
    return inspection.metrics_table(spark, {"normalize": normalized.get, "quality": judged.get})


def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.random_rows(
        translation_flags(spark, sf_dir), 10, seed=fv.SEED, key_col="review_id"
    )


def random_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.random_place(build_context(spark, sf_dir), fv.SEED)


QUERIES: dict[str, Query] = {
    "build_context": build_context,
    "build_context_hot": build_context_hot,
    "build_context_forty": build_context_forty,
    "place_counts": place_counts,
    "approx_place_counts": approx_place_counts,
    "min_reviews_filter": min_reviews_filter,
    "info_score": info_score,
    "rating_alloc": rating_alloc,
    "stratified_topk": stratified_topk,
    "place_metadata": place_metadata,
    "remove_nulls": remove_nulls,
    "strip_html": _on_pages(tx.strip_html),
    "strip_urls": _on_pages(tx.strip_urls),
    "collapse_whitespace": _on_pages(tx.collapse_spaces),
    "clean_text_basic": clean_text_basic,
    "detect_documents": detect_documents,
    "detector_accuracy": detector_accuracy,
    "detect_by_slices": detect_by_slices,
    "detect_conversations": detect_conversations,
    "language_allow_list": language_allow_list,
    "translation_flags": translation_flags,
    "translate_with_backend": translate_with_backend,
    "translate_truncated": translate_truncated,
    "translate_with_glossary": translate_with_glossary,
    "cleaned_pages": cleaned_pages,
    "resumable_clean": resumable_clean,
    "clean_metrics": clean_metrics,
    "compacted_batches": compacted_batches,
    "norm_dot": _on_documents(nz.dots_between_letters, "text"),
    "norm_mash": _on_documents(nz.drop_keyboard_mash, "text"),
    "norm_letter_runs": _on_documents(nz.collapse_letter_runs, "text"),
    "norm_punct_runs": _on_documents(nz.collapse_punctuation_runs, "text"),
    "norm_plural": _on_documents(nz.attach_plural_suffix, "text"),
    "norm_space_punct": _on_documents(nz.tighten_punctuation, "text"),
    "normalize_full": _on_documents(nz.normalize, "text"),
    "normalize_change_stats": normalize_change_stats,
    "normalize_change_samples": normalize_change_samples,
    "char_entropy": char_entropy,
    "quality_reasons": quality_reasons,
    "quality_filter": quality_filter,
    "quality_rejects": quality_rejects,
    "quality_report": quality_report,
    "curated_projection": curated_projection,
    "curated_reviews": curated_reviews,
    "pending_places": pending_places,
    "daily_budget": daily_budget,
    "enrich_extractive": enrich_extractive,
    "enrich_with_backend": enrich_with_backend,
    "enrich_progress": enrich_progress,
    "enrich_resumed": enrich_resumed,
    "enrich_parts": enrich_parts,
    "enrich_after_failure": enrich_after_failure,
    "completed_keys": completed_keys,
    "chat_messages_json": chat_messages_json,
    "jsonl_roundtrip": jsonl_roundtrip,
    "train_test_split": train_test_split,
    "train_test_split_stable": train_test_split_stable,
    "chat_files": chat_files,
    "chat_template_render": chat_template_render,
    "length_budget": length_budget,
    "length_budget_cut": length_budget_cut,
    "conversations_cut": conversations_cut,
    "chat_template_conversations": chat_template_conversations,
    "train_test_split_null_keys": train_test_split_null_keys,
    "chat_files_repeated_keys": chat_files_repeated_keys,
    "source_row_count": source_row_count,
    "parquet_roundtrip": parquet_roundtrip,
    "stage_summary": stage_summary,
    "stage_metrics": stage_metrics,
    "random_sample": random_sample,
    "random_place": random_place,
}
