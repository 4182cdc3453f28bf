"""Metrics of streamed batches and compaction by size."""

import os

import pytest
from pyspark.sql import functions as F

from reviewcraft.session import delete_path, list_names
from reviewcraft.streaming import incremental


def observed(df):
    return df.observe(
        "seen", F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % 2 == 0).alias("even")
    )


def test_every_batch_leaves_its_counts(spark, tmp_path):
    raw, staging, progress, metrics = (str(tmp_path / n) for n in ("raw", "s", "p", "m"))
    spark.range(60).repartition(6).write.parquet(raw)
    schema = spark.read.parquet(raw).schema
    run = lambda: incremental.run_available(spark, raw, schema, observed, staging, progress, 1, metrics)
    assert run() == 6
    found = incremental.batch_metrics(spark, metrics)
    assert [m["batch"] for m in found] == list(range(6))
    assert sum(m["rows_in"] for m in found) == sum(m["n"] for m in found) == 60
    assert sum(m["even"] for m in found) == 30
    # a later run adds its own, and one with nothing to do adds none
    assert run() == 0
    assert incremental.batch_metrics(spark, metrics) == found
    spark.range(60, 70).coalesce(1).write.mode("append").parquet(raw)
    assert run() == 1
    assert sum(m["rows_in"] for m in incremental.batch_metrics(spark, metrics)) == 70


def test_counts_survive_a_crash(spark, tmp_path):
    raw, staging, progress, metrics = (str(tmp_path / n) for n in ("raw", "s", "p", "m"))
    spark.range(50).repartition(5).write.parquet(raw)
    schema, arm = spark.read.parquet(raw).schema, {"on": True}

    def change(df):
        bad = F.when(F.col("id") == 25, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
        return observed(df.withColumn("id", bad.cast("long")) if arm["on"] else df)

    def run():
        return incremental.run_available(spark, raw, schema, change, staging, progress, 1, metrics)

    with pytest.raises(Exception, match="lost"):
        run()
    arm["on"] = False
    run()
    found = incremental.batch_metrics(spark, metrics)
    assert [m["batch"] for m in found] == list(range(5))
    assert sum(m["rows_in"] for m in found) == 50 and sum(m["even"] for m in found) == 25


def files_of(path):
    return sorted(
        (os.path.getsize(os.path.join(path, n)), n) for n in os.listdir(path) if n.endswith(".parquet")
    )


def staged(spark, path):
    spark.range(200_000).coalesce(1).write.mode("append").parquet(path)
    spark.range(200_000, 400_000).coalesce(1).write.mode("append").parquet(path)
    spark.range(400_000, 400_400).repartition(8).write.mode("append").parquet(path)


def test_only_small_files_are_written_again(spark, tmp_path):
    staging, final = str(tmp_path / "staging"), str(tmp_path / "final")
    staged(spark, staging)
    before = files_of(staging)
    small, large = before[:8], before[8:]
    found = incremental.combine(spark, staging, final, target_bytes=large[0][0])
    assert found == {
        "moved_files": 2,
        "moved_bytes": sum(n for n, _ in large),
        "rewritten_bytes": sum(n for n, _ in small),
    }
    assert found["rewritten_bytes"] < found["moved_bytes"] / 10
    after = files_of(final)
    assert len(after) == 3 and {n for n, _ in large} < {n for n, _ in after}
    rows = spark.read.parquet(final)
    assert rows.count() == 400_400 and rows.distinct().count() == 400_400
    assert not list_names(spark, f"{final}.building") and not list_names(spark, f"{final}.moving")


def test_a_broken_move_goes_on(spark, tmp_path, monkeypatch):
    staging, final = str(tmp_path / "staging"), str(tmp_path / "final")
    staged(spark, staging)
    target = files_of(staging)[8][0]
    move, calls = incremental.move_file, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        move(*args)

    monkeypatch.setattr(incremental, "move_file", dies)
    with pytest.raises(OSError):
        incremental.combine(spark, staging, final, target_bytes=target)
    monkeypatch.setattr(incremental, "move_file", move)
    found = incremental.combine(spark, staging, final, target_bytes=target)
    assert found["moved_files"] == 2
    assert spark.read.parquet(final).distinct().count() == 400_400
    # again, after staging is gone: a new staging replaces the table
    delete_path(spark, staging)
    spark.range(5).write.parquet(staging)
    incremental.combine(spark, staging, final, target_bytes=target)
    assert spark.read.parquet(final).count() == 5


@pytest.mark.parametrize("rows", [0, 10])
def test_small_tables(spark, tmp_path, rows):
    staging, final = str(tmp_path / "st aging"), str(tmp_path / "fi nal")
    spark.range(rows).repartition(4).write.parquet(staging)
    incremental.combine(spark, staging, final)
    assert spark.read.parquet(final).count() == rows
    assert len(files_of(final)) <= 1


def test_a_batch_of_few_files_is_dealt_over_all_cores(spark, tmp_path):
    raw, staging, progress = (str(tmp_path / n) for n in ("raw", "s", "p"))
    spark.range(1000).repartition(2).write.parquet(raw)
    schema = spark.read.parquet(raw).schema
    by_task = lambda df: df.withColumn("task", F.spark_partition_id())
    assert incremental.run_available(spark, raw, schema, by_task, staging, progress, 1) == 2
    rows = spark.read.parquet(staging)
    assert rows.select("task").distinct().count() == spark.sparkContext.defaultParallelism
    assert rows.select("id").distinct().count() == rows.count() == 1000
