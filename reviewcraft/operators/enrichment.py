"""Incremental summaries: find what is pending, take a day's share, summarize, project."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft.functions import text as tx

# (system prompt, context) -> summary
Summarizer = Callable[[str, str], str]
# built once per Python worker, so that a client is opened there and not shipped
SummarizerFactory = Callable[[], Summarizer]


@dataclass(frozen=True)
class CallPolicy:
    prompt: str = fv.SUMMARY_PROMPT
    attempts: int = fv.MAX_ATTEMPTS
    wait_seconds: float = fv.RATE_LIMIT_WAIT_SECONDS
    pause_seconds: float = fv.PAUSE_SECONDS
    # how many calls may run at once
    concurrency: int = 1
    # calls that each of them makes, one after the other, before their part is stored
    calls_per_task: int = 8
    sleep: Callable[[float], None] = time.sleep


# --- what to do --------------------------------------------------------------


def completed_places(summaries: DataFrame) -> DataFrame:
    """Distinct places that have a summary."""
    return summaries.filter(F.col("place_id").isNotNull()).select("place_id").distinct()


def pending_contexts(contexts: DataFrame, completed: DataFrame) -> DataFrame:
    """Contexts without a summary. A context without a place id counts as pending."""
    return contexts.join(completed, "place_id", "left_anti")


#: Bits of the filter for each finished place, and its largest size (64 MB).
_FILTER_BITS_PER_KEY = 16
_FILTER_MAX_BITS = 1 << 29


def pending_keys(contexts: DataFrame, completed: DataFrame) -> DataFrame:
    """Distinct ids of pending contexts; those without an id are left out.

    A filter of finished ids stands in front of the anti join: one bit for each hashed id, of a
    bounded size. Ids whose bit is not set are pending for sure and need no join; the
    others, finished ones and a few percent of the rest, are looked up exactly.
    """
    keys = contexts.filter(F.col("place_id").isNotNull()).select("place_id").distinct()
    n_done = completed.count()
    if not n_done:
        return keys
    wanted = max(n_done * _FILTER_BITS_PER_KEY, 1 << 15)
    bits = min(1 << (wanted - 1).bit_length(), _FILTER_MAX_BITS)
    place = F.pmod(F.xxhash64("place_id"), F.lit(bits))
    hashed = completed.withColumn("_bit", place)
    bitmaps = hashed.groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bitmap")
    )
    marked = keys.withColumn("_bit", place).withColumn(
        "_bucket", F.bitmap_bucket_number("_bit")
    )
    # 4 KB for each 32768 bits, 64 MB at most
    looked_up = marked.join(F.broadcast(bitmaps), "_bucket", "left").withColumn(
        "_byte",
        F.conv(
            F.hex(
                F.substring(
                    "_bitmap", (F.floor(F.bitmap_bit_position("_bit") / 8) + 1).cast("int"), F.lit(1)
                )
            ),
            16,
            10,
        ).cast("int"),
    )
    is_set = F.getbit("_byte", (F.bitmap_bit_position("_bit") % 8).cast("int")) == 1
    flagged = looked_up.select("place_id", F.coalesce(is_set, F.lit(False)).alias("_maybe"))
    unsure = flagged.filter("_maybe").join(completed, "place_id", "left_anti")
    return flagged.filter("NOT _maybe").select("place_id").unionByName(unsure.select("place_id"))


def numbered(keys: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keys`` (``place_id``) with ``number``, their rank from 0, without bringing them together.

    Ranges of keys are sorted and ``store``d with their places in them; the sizes of the ranges,
    one number a task, give each its offset.
    """
    place = F.monotonically_increasing_id()
    ranges = store(
        keys.repartitionByRange("place_id")
        .sortWithinPartitions("place_id")
        .select("place_id", place.alias("_id"))
    ).select(
        "place_id",
        F.shiftright("_id", 33).cast("int").alias("_range"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
    )
    sizes = sorted(ranges.groupBy("_range").count().collect())
    offsets, before = [], 0
    for found, size in sizes:
        offsets.append((found, before))
        before += size
    table = keys.sparkSession.createDataFrame(offsets, "_range int, _before long")
    return ranges.join(F.broadcast(table), "_range").select(
        "place_id", (F.col("_before") + F.col("_at")).alias("number")
    )


def share_of(
    numbered_keys: DataFrame, limit: int, slots: int, calls_per_slot: int
) -> DataFrame:
    """The first ``limit`` keys, dealt: ``place_id``, ``part``, ``slot``.

    A part has ``slots`` slots of ``calls_per_slot`` neighbouring keys.
    """
    slot = F.floor(F.col("number") / calls_per_slot)
    return numbered_keys.filter(F.col("number") < limit).select(
        "place_id",
        F.floor(slot / slots).cast("int").alias("part"),
        (slot % slots).cast("int").alias("slot"),
    )


def daily_share(pending: DataFrame, limit: int = fv.DAILY_LIMIT) -> DataFrame:
    """The first ``limit`` pending contexts by place id; only ids are put in order.

    Ids are unique among contexts; contexts without one come first.
    """
    first = pending.select("place_id").orderBy("place_id").limit(limit)
    chosen = first.select(F.col("place_id").alias("_chosen"))
    return pending.join(chosen, F.col("place_id").eqNullSafe(F.col("_chosen")), "left_semi")


# --- summarizing -------------------------------------------------------------


def _is_rate_limit(error: Exception) -> bool:
    message = str(error).lower()
    return any(mark in message for mark in fv.RATE_LIMIT_MARKS)


def call_with_retries(summarize: Summarizer, context: str, policy: CallPolicy) -> str:
    """Only rate limits are worth another attempt; each waits longer than the last."""
    for attempt in range(1, policy.attempts + 1):
        try:
            return summarize(policy.prompt, context).strip()
        except Exception as error:
            if not _is_rate_limit(error):
                raise
            policy.sleep(policy.wait_seconds * attempt)
    raise RuntimeError(f"rate limited in all {policy.attempts} attempts")


class _Together:
    """What the tasks of a barrier stage tell each other before each call."""

    def __init__(self):
        self.context = BarrierTaskContext.get()

    def ask(self, state: str) -> list[str]:
        return self.context.allGather(state)


class _Alone:
    def ask(self, state: str) -> list[str]:
        return [state]


def can_stop_together(spark: SparkSession, policy: CallPolicy, tasks: int | None = None) -> bool:
    """Whether all calling tasks can run at once, as a barrier stage needs."""
    dynamic = spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true"
    return not dynamic and (tasks or policy.concurrency) <= spark.sparkContext.defaultParallelism


def summarize_with_backend(
    contexts: DataFrame,
    factory: SummarizerFactory,
    policy: CallPolicy = CallPolicy(),
    threads: int = 1,
) -> DataFrame:
    """Add ``target_summary, status, error`` by calling a backend for each context.

    At most ``policy.concurrency`` calls run at once, ``threads`` of them in one task, each with
    a client of its own. Tasks run as one barrier stage and agree before each round of calls:
    after a failure in any of them no task starts another one, a service that refuses once is
    left alone. Rows that are not ``ok`` stay pending. Agreeing takes a second or so; a single
    task need not ask, which suits contexts few enough for one task, as those of a part.
    Where a barrier stage cannot run (dynamic allocation, or more tasks at once than slots),
    a failure stops its own task only.
    """
    tasks = -(-policy.concurrency // threads)
    at_once = min(threads, policy.concurrency)
    together = tasks > 1 and can_stop_together(contexts.sparkSession, policy, tasks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summarizers = [factory() for _ in range(at_once)]
        others = _Together() if together else _Alone()
        stopped = failed = False

        def call(summarize: Summarizer, context: str) -> tuple[str | None, str, str | None]:
            try:
                summary = call_with_retries(summarize, context, policy)
                policy.sleep(policy.pause_seconds)
                return summary, "ok", None
            except Exception as failure:
                return None, "failed", str(failure)

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                found: list[tuple[str | None, str, str | None]] = []
                texts = batch["llm_input_context"].tolist()
                for start in range(0, len(texts), at_once):
                    part = texts[start : start + at_once]
                    stopped = stopped or "failed" in others.ask("failed" if failed else "calling")
                    if stopped:
                        found += [(None, "skipped", None)] * len(part)
                        continue
                    found += pool.map(call, summarizers[: len(part)], part)
                    failed = failed or any(status == "failed" for _, status, _ in found[start:])
                summaries, statuses, errors = (list(c) for c in zip(*found)) if found else ([], [], [])
                yield batch.assign(target_summary=summaries, status=statuses, error=errors)
        # tasks with fewer rows keep answering until all have none left, or one has failed
        while not stopped:
            states = others.ask("failed" if failed else "done")
            stopped = "failed" in states or "calling" not in states

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in contexts.schema.fields]
    schema = ", ".join([*fields, "target_summary string", "status string", "error string"])
    dealt = contexts.coalesce(1) if tasks == 1 else contexts.repartition(tasks)
    return dealt.mapInPandas(run, schema, barrier=together)


def extractive_summary(context: Column, sentences: int = 3) -> Column:
    """The most informative lines of a context, best first, as one paragraph.

    A line's score is its number of words up to ``IDEAL_MAX_WORDS``; short lines
    count half, as for reviews. Works inside one row.
    """
    def scored(line: Column, position: Column) -> Column:
        words = tx.word_count(line)
        score = (
            F.when(words < fv.IDEAL_MIN_WORDS, words * F.lit(fv.SHORT_REVIEW_FACTOR))
            .when(words > fv.IDEAL_MAX_WORDS, F.lit(float(fv.IDEAL_MAX_WORDS)))
            .otherwise(words.cast("double"))
        )
        return F.struct((-score).alias("rank"), position.alias("pos"), line.alias("line"))

    lines = F.filter(F.split(context, "\n"), lambda line: F.length(line) > 0)
    best = F.slice(F.array_sort(F.transform(lines, scored)), 1, sentences)
    return F.array_join(best.getField("line"), " ")


def summarize_extractively(contexts: DataFrame, sentences: int = 3) -> DataFrame:
    """The built-in backend: no service, no Python workers; every row is ``ok``."""
    return contexts.withColumns(
        {
            "target_summary": extractive_summary(F.col("llm_input_context"), sentences),
            "status": F.lit("ok"),
            "error": F.lit(None).cast("string"),
        }
    )


def summary_records(enriched: DataFrame) -> DataFrame:
    """The finished rows in the layout of the summaries file."""
    return enriched.filter(F.col("status") == "ok").select(
        "place_id",
        "place_name",
        F.col("llm_input_context").alias("input_context"),
        "target_summary",
    )
