"""Jobs: one per stage, each reading and writing tables.

    spark-submit run_job.py curate cleaned/ curated/
    python -m reviewcraft.plans.jobs curate cleaned/ curated/
"""

from __future__ import annotations

import argparse
import json
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft import fixed_values as fv
from reviewcraft import schemas
from reviewcraft.operators import completed
from reviewcraft.operators import enrichment as en
from reviewcraft.operators import finetune as ft
from reviewcraft.operators import inspection
from reviewcraft.operators.context import ContextParams, build_context, place_counts, with_review_id
from reviewcraft.operators.language import DetectorParams, LanguageDetector, train_profile
from reviewcraft.plans.stages import CleaningParams, clean_reviews, curate_reviews, training_text
from reviewcraft.session import delete_path, get_session, list_names, path_exists, shared_folder
from reviewcraft.sources import jsonl, tables
from reviewcraft.streaming import incremental

Metrics = dict[str, Any]

#: Contexts that the built-in summarizer gets in one task.
BUILT_IN_ROWS = 10_000
#: Calls at once in one task of a part. Above it, tasks have to agree before each round.
CALLS_PER_TASK = 16


def train_detector(
    spark: SparkSession,
    labelled: str,
    model: str,
    text_col: str,
    lang_col: str,
    params: DetectorParams = DetectorParams(),
) -> Metrics:
    examples = tables.read_parquet(spark, labelled)
    tables.write_parquet(train_profile(examples, text_col, lang_col, params), model)
    return {"languages": LanguageDetector.load(spark, model).languages}


def clean(
    spark: SparkSession,
    raw: str,
    cleaned: str,
    model: str,
    work: str,
    params: CleaningParams = CleaningParams(),
    max_files_per_batch: int = 1000,
    compact: bool = False,
) -> Metrics:
    """Raw files to the cleaned table; run again after a crash, it goes on where it was.

    ``work`` holds the progress and must stay the same between the runs. The
    unit of progress is an input file, see ``tables.write_parquet``. The
    batches are the cleaned table; with ``compact`` they are staged, made one
    table (only small files are written again), and the work folder is deleted.
    Counts are those that the batches observed, of this run and the earlier ones;
    raw files are not read for them.
    """
    schema = spark.read.parquet(raw).schema
    detector = LanguageDetector.load(spark, model)
    staging = f"{work}/staging" if compact else cleaned
    batches = incremental.run_available(
        spark,
        raw,
        schema,
        lambda df: clean_reviews(df, detector, params),
        staging,
        f"{work}/progress",
        max_files_per_batch,
        f"{work}/metrics",
    )
    found = incremental.batch_metrics(spark, f"{work}/metrics")
    if compact:
        incremental.combine(spark, staging, cleaned)
        incremental.drop_work(spark, work)
    total, filled, foreign = (
        sum(row[name] for row in found)
        for name in ("rows_in", "non_blank_rows", "other_language_rows")
    )
    return {
        "batches": batches,
        "measured_batches": len(found),
        "rows_in": total,
        "rows_out": filled - foreign,
        "removed": total - filled + foreign,
        "removed_blank": total - filled,
        "removed_language": foreign,
    }


def curate(spark: SparkSession, cleaned: str, curated: str) -> Metrics:
    normalized, judged = Observation("normalize"), Observation("quality")
    reviews = with_review_id(tables.read_parquet(spark, cleaned))
    tables.write_parquet(curate_reviews(reviews, normalized=normalized, judged=judged), curated)
    return {**normalized.get, **judged.get}


def contexts(
    spark: SparkSession,
    curated: str,
    output: str,
    params: ContextParams = ContextParams(max_reviews=fv.JOB_MAX_REVIEWS_PER_PLACE),
) -> Metrics:
    reviews = with_review_id(tables.read_parquet(spark, curated), params.id_col)
    tables.write_parquet(build_context(reviews, params), output)
    return place_counts(reviews, params.min_reviews).first().asDict()


def enrich(
    spark: SparkSession,
    contexts_path: str,
    summaries_path: str,
    summarizer: en.SummarizerFactory | None = None,
    limit: int = fv.DAILY_LIMIT,
    policy: en.CallPolicy = en.CallPolicy(),
) -> Metrics:
    """Summarize a day's share of the pending contexts and append the results.

    Finished places come from a key table beside the summaries, which learns of new files
    only. The contexts of the share are fetched once and stored by part; each part is read
    alone. The summaries of a part are counted and appended by one job before the next part
    begins: a run that dies loses one part, and later runs never ask for a finished summary
    again. The run ends early if there is nothing to do, and after a part
    with a failure. The built-in summarizer has no service to be careful with and does
    all in one part.
    """
    metrics: Metrics = {"tried": 0, "succeeded": 0, "first_error": None, "parts": 0}
    if not path_exists(spark, contexts_path):
        return metrics
    all_contexts = spark.read.schema(schemas.CONTEXTS).parquet(contexts_path)
    completed.refresh(spark, summaries_path)
    done = completed.completed_keys(spark, summaries_path)
    staged = shared_folder(spark, "enriched")

    def store(df: DataFrame) -> DataFrame:
        df.write.parquet(f"{staged}/ranges")
        return spark.read.schema(df.schema).parquet(f"{staged}/ranges")

    keys = en.numbered(en.pending_keys(all_contexts, done), store)
    if summarizer is None:
        share = en.share_of(keys, limit, max(1, -(-limit // BUILT_IN_ROWS)), BUILT_IN_ROWS)
    else:
        share = en.share_of(keys, limit, policy.concurrency, policy.calls_per_task)
    # the one scan of the contexts' texts in a run
    dealt = all_contexts.join(share, "place_id").repartition("part", "slot")
    dealt.sortWithinPartitions("part", "slot", "place_id").write.partitionBy(
        "part"
    ).parquet(f"{staged}/share")
    for part in _parts(spark, f"{staged}/share"):
        rows = spark.read.schema(schemas.CONTEXTS).parquet(f"{staged}/share/part={part}")
        if summarizer is None:
            enriched = en.summarize_extractively(rows)
        else:
            enriched = en.summarize_with_backend(rows, summarizer, policy, CALLS_PER_TASK)
        # the calls, the counts and the append are one Spark job
        counts = Observation()
        watched = enriched.observe(
            counts,
            F.count(F.lit(1)).alias("tried"),
            F.count_if(F.col("status") == "ok").alias("succeeded"),
            F.first("error", ignorenulls=True).alias("first_error"),
        )
        jsonl.append(en.summary_records(watched), summaries_path)
        found = counts.get
        metrics["parts"] += 1
        metrics["tried"] += found["tried"]
        metrics["succeeded"] += found["succeeded"]
        metrics["first_error"] = metrics["first_error"] or found["first_error"]
        if found["succeeded"] < found["tried"]:
            break
    completed.refresh(spark, summaries_path)
    delete_path(spark, staged)
    return metrics


def _parts(spark: SparkSession, path: str) -> list[int]:
    names = (name.partition("=") for name in list_names(spark, path))
    return sorted(int(number) for key, _, number in names if key == "part")


def prepare_chat(
    spark: SparkSession,
    summaries_path: str,
    train_path: str,
    test_path: str,
    test_size: float = fv.TEST_SIZE,
    exact: bool = True,
) -> Metrics:
    """Summaries to train and test files of chat messages, split on the place.

    Every record becomes an example, equal ones too; those of one place are on the same side.
    Records are read, split and stored once; both files are written from there.
    """
    records = jsonl.read_strict(spark, summaries_path, schemas.SUMMARIES)
    examples = ft.to_chat_examples(records, "place_id")
    marked = ft.mark_test_rows(examples, "place_id", test_size, exact=exact)
    staged = shared_folder(spark, "chat-sides")
    counts = Observation()
    marked.select("messages", "is_test").observe(
        counts,
        F.count_if(~F.col("is_test")).alias("train"),
        F.count_if("is_test").alias("test"),
    ).write.partitionBy("is_test").parquet(staged)
    metrics = {"train": counts.get["train"], "test": counts.get["test"]}
    if not metrics["train"]:
        delete_path(spark, staged)
        raise ValueError(f"test_size {test_size} leaves no training examples")
    schema = T.StructType([*schemas.CHAT_EXAMPLES.fields, T.StructField("is_test", T.BooleanType())])
    sides = spark.read.schema(schema).parquet(staged)
    for is_test, path in ((False, train_path), (True, test_path)):
        jsonl.overwrite(sides.filter(F.col("is_test") == is_test).select("messages"), path)
    delete_path(spark, staged)
    return metrics


def render(spark: SparkSession, chat_path: str, output: str) -> Metrics:
    """Chat files to the trainer's text column."""
    examples = jsonl.read_strict(spark, chat_path, schemas.CHAT_EXAMPLES)
    lengths = Observation("lengths")
    tables.write_parquet(
        training_text(examples).observe(
            lengths,
            F.count(F.lit(1)).alias("examples"),
            F.count_if(~F.col("fits")).alias("too_long"),
        ),
        output,
    )
    return lengths.get


def inspect(spark: SparkSession, path: str, sample_size: int = 100) -> Metrics:
    """Counts and random rows of a stage table, on the console."""
    if not path_exists(spark, path):
        return {"error": f"no table at {path}"}
    table = tables.read_parquet(spark, path)
    inspection.random_rows(table, sample_size).show(sample_size, truncate=False)
    return inspection.summarize_table(table).first().asDict()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="reviewcraft")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        for path in paths:
            sub.add_argument(path)
        sub.set_defaults(run=run)
        return sub

    command("train-detector", train_detector, "labelled", "model", "text_col", "lang_col")
    sub = command("clean", clean, "raw", "cleaned", "model", "work")
    sub.add_argument("--text-col", default="review_text")
    sub.add_argument("--target-lang", default=fv.TARGET_LANGUAGE)
    sub.add_argument("--compact", action="store_true")
    sub.add_argument("--translatable", nargs="*", default=list(fv.TRANSLATABLE_LANGUAGES))
    command("curate", curate, "cleaned", "curated")
    sub = command("contexts", contexts, "curated", "output")
    sub.add_argument("--max-reviews", type=int, default=fv.JOB_MAX_REVIEWS_PER_PLACE)
    sub.add_argument("--min-reviews", type=int, default=fv.MIN_REVIEWS_PER_PLACE)
    command("enrich", enrich, "contexts_path", "summaries_path").add_argument(
        "--limit", type=int, default=fv.DAILY_LIMIT
    )
    command("prepare-chat", prepare_chat, "summaries_path", "train_path", "test_path").add_argument(
        "--test-size", dest="test_size", type=float, default=fv.TEST_SIZE
    )
    command("render", render, "chat_path", "output")
    command("inspect", inspect, "path").add_argument(
        "--sample-size", dest="sample_size", type=int, default=100
    )
    options = vars(parser.parse_args(argv))
    run, name = options.pop("run"), options.pop("command")
    if run is clean:
        names = ("text_col", "target_lang", "translatable")
        options["params"] = CleaningParams(**{n: options.pop(n) for n in names})
    elif run is contexts:
        names = ("max_reviews", "min_reviews")
        options["params"] = ContextParams(**{n: options.pop(n) for n in names})
    metrics = run(get_session(f"reviewcraft {name}"), **options)
    print(json.dumps(metrics, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
