"""Resumable cleaning: each input file is processed once, over any number of runs.

The transformations are narrow, so a plain append stream with a file sink does.
The sink's log makes a replayed batch replace its own files: a run that died
half-way leaves neither gaps nor doubles.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reviewcraft.session import (
    delete_path,
    file_size,
    list_names,
    move_file,
    path_exists,
    plain_path,
    read_text,
    rename_path,
    write_text,
)


def run_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    staging: str,
    checkpoint: str,
    max_files_per_batch: int = 1000,
    metrics: str | None = None,
) -> int:
    """Process all input files that no earlier run has finished; returns the batches run.

    With ``metrics`` (a folder), what each batch reports of itself is stored there under the
    number of the batch: the rows it read and what its observations counted. A batch that
    is run again after a crash replaces its own numbers.
    """
    before = _last_batch(spark, checkpoint)
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(source)
    )
    cores = spark.sparkContext.defaultParallelism
    if max_files_per_batch < cores:
        # a batch of few files has few tasks: its rows are dealt over all cores
        stream = stream.repartition(cores)
    kept = spark.conf.get(_REPORTS_KEY)
    if metrics is not None:
        spark.conf.set(_REPORTS_KEY, str(PROGRESS_REPORTS))
    query = (
        stream.transform(transform)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", staging)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if metrics is None:
        query.awaitTermination()
    else:
        spark.conf.set(_REPORTS_KEY, kept)
        stored: set[int] = set()
        try:
            while not query.awaitTermination(PROGRESS_SECONDS):
                _store_progress(spark, query, metrics, stored)
        finally:
            _store_progress(spark, query, metrics, stored)
    # batch ids count on from run to run; the progress kept in memory is cut by Spark
    return _last_batch(spark, checkpoint) - before


#: How often the progress of a running stream is taken down, in seconds, and how many reports
#: Spark keeps in between.
PROGRESS_SECONDS = 1
PROGRESS_REPORTS = 10_000
_REPORTS_KEY = "spark.sql.streaming.numRecentProgressUpdates"


def _store_progress(spark: SparkSession, query, metrics: str, stored: set[int]) -> None:
    for report in query.recentProgress:
        found = json.loads(report.json)
        # a report without observations is that of a trigger that had nothing to do
        observed = found.get("observedMetrics") or {}
        if not observed or found["batchId"] in stored:
            continue
        row = {"batch": found["batchId"], "rows_in": found["numInputRows"]}
        for values in observed.values():
            row |= values
        write_text(spark, f"{metrics}/batch-{row['batch']}.json", json.dumps(row))
        stored.add(row["batch"])


def batch_metrics(spark: SparkSession, metrics: str) -> list[dict]:
    """What ``run_available`` stored, in the order of the batches."""
    names = [n for n in list_names(spark, metrics) if n.startswith("batch-")]
    found = [json.loads(read_text(spark, f"{metrics}/{name}")) for name in names]
    return sorted(found, key=lambda row: row["batch"])


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last committed batch, -1 if there is none."""
    commits = list_names(spark, f"{checkpoint}/commits")
    return max((int(name) for name in commits if name.isdigit()), default=-1)


#: Files of a combined table are about so large.
TARGET_BYTES = 128 << 20


def combine(
    spark: SparkSession,
    staging: str,
    final: str,
    files: int | None = None,
    target_bytes: int = TARGET_BYTES,
) -> dict[str, int]:
    """Make the staged batches one table; returns how many files and bytes went which way.

    Files of at least half of ``target_bytes`` are moved as they are. The others are written anew,
    as many together as make up the target. The table is built beside ``final`` and takes
    its place when it is whole. What is to be moved is noted first, so a run that dies
    on the way is done again from the note. With ``files`` all is written anew.
    """
    building, note = f"{final.rstrip('/')}.building", f"{final.rstrip('/')}.moving"
    if files is not None:
        spark.read.parquet(staging).coalesce(files).write.mode("overwrite").parquet(final)
        return {"moved_files": 0, "moved_bytes": 0, "rewritten_bytes": -1}
    staged = spark.read.parquet(staging) if not path_exists(spark, f"{note}/_SUCCESS") else None
    if staged is not None:
        delete_path(spark, building)
        found = [plain_path(spark, f) for f in staged.inputFiles()]
        sizes = [(f, file_size(spark, f)) for f in found]
        small = [(f, n) for f, n in sizes if 2 * n < target_bytes]
        large = [(f, n) for f, n in sizes if 2 * n >= target_bytes]
        written = sum(n for _, n in small)
        schema = staged.schema
        rest = spark.read.schema(schema).parquet(*(f for f, _ in small)) if small else staged.limit(0)
        if small or not large:
            rest.coalesce(max(1, -(-written // target_bytes))).write.parquet(building)
        rows = [(f, n, written) for f, n in large] or [(None, 0, written)]
        spark.createDataFrame(rows, "file string, size long, rewritten long").coalesce(1).write.mode(
            "overwrite"
        ).json(note)
    found = spark.read.schema("file string, size long, rewritten long").json(note).collect()
    moved = [(r["file"], r["size"]) for r in found if r["file"] is not None]
    for at, (source, _) in enumerate(moved):
        move_file(spark, source, f"{building}/part-moved-{at:06d}.parquet")
    if path_exists(spark, building):
        delete_path(spark, final)
        rename_path(spark, building, final)
    delete_path(spark, note)
    return {
        "moved_files": len(moved),
        "moved_bytes": sum(n for _, n in moved),
        "rewritten_bytes": found[0]["rewritten"],
    }


def drop_work(spark: SparkSession, work: str) -> None:
    """Delete staging and progress of a finished run, to be called after ``combine``."""
    delete_path(spark, work)
