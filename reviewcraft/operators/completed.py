"""Finished places, kept as a table beside the summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft import schemas
from reviewcraft.session import list_files, path_exists
from reviewcraft.sources import jsonl

SCHEMA = "place_id string, file string"


def keys_path(summaries_path: str) -> str:
    return f"{summaries_path.rstrip('/')}.keys"


def refresh(spark: SparkSession, summaries_path: str) -> int:
    """Read the summary files that the key table does not know; returns their number.

    The table has the places of each file and one row without a place for the file itself, so
    that a file without a record is known too. A file that has changed is another file. A run
    that dies between an append and its refresh is made up for by the next refresh.
    """
    table = keys_path(summaries_path)
    files = list_files(spark, summaries_path)
    known: set[str] = set()
    if path_exists(spark, table):
        rows = spark.read.schema(SCHEMA).parquet(table).filter(F.col("place_id").isNull())
        # one short row a file; the files themselves are listed here as well
        known = {r["file"] for r in rows.select("file").distinct().toLocalIterator()}
    new = [found for found in files if found[2] not in known]
    if not new:
        return 0
    marks = spark.createDataFrame([found[1:] for found in new], "name string, file string")
    places = (
        jsonl.read_tolerant(spark, [p for p, _, _ in new], schemas.SUMMARIES, required="place_id")
        .select("place_id", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"))
        .distinct()
        .join(F.broadcast(marks), "name")
        .select("place_id", "file")
    )
    # a file counts as known only when its places are stored
    places.write.mode("append").parquet(table)
    itself = marks.select(F.lit(None).cast("string").alias("place_id"), "file")
    itself.coalesce(1).write.mode("append").parquet(table)
    return len(new)


def completed_keys(spark: SparkSession, summaries_path: str) -> DataFrame:
    """Distinct places that have a summary in a file that is still there."""
    table = keys_path(summaries_path)
    files = [(mark,) for _, _, mark in list_files(spark, summaries_path)]
    if not files or not path_exists(spark, table):
        return spark.createDataFrame([], "place_id string")
    there = spark.createDataFrame(files, "file string")
    return (
        spark.read.schema(SCHEMA)
        .parquet(table)
        .filter(F.col("place_id").isNotNull())
        .join(F.broadcast(there), "file", "left_semi")
        .select("place_id")
        .distinct()
    )
