"""Sources, sinks, incremental runs, inspection and the jobs end to end."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewcraft import schemas
from reviewcraft.operators import inspection
from reviewcraft.plans import jobs
from reviewcraft.plans.queries import raw_reviews
from reviewcraft.plans.stages import CleaningParams
from reviewcraft.session import delete_path, path_exists
from reviewcraft.sources import jsonl, tables
from reviewcraft.streaming import incremental

DATA = "/root/testdata/sf0.001"


def write_lines(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_tolerant_reading(spark, tmp_path):
    assert jsonl.read_tolerant(spark, str(tmp_path / "absent"), schemas.SUMMARIES).count() == 0
    good, broken = '{"place_id":"a","target_summary":"x"}', '{"place_id":"b'
    path = write_lines(spark, str(tmp_path / "lines"), good, broken)
    rows = jsonl.read_tolerant(spark, path, schemas.SUMMARIES, "place_id").collect()
    assert [r["place_id"] for r in rows] == ["a"]
    with pytest.raises(Exception):
        jsonl.read_strict(spark, path, schemas.SUMMARIES).collect()


def test_record_without_key_is_an_error(spark, tmp_path):
    path = write_lines(spark, str(tmp_path / "lines"), '{"place_name":"x"}')
    with pytest.raises(Exception, match="record without place_id"):
        jsonl.read_tolerant(spark, path, schemas.SUMMARIES, "place_id").collect()


def test_nulls_are_written(spark, tmp_path):
    df = spark.createDataFrame([("ş", None)], "a string, b string")
    jsonl.overwrite(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()["value"] == '{"a":"ş","b":null}'


def test_nan_rating_is_null(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (4.0,)], "rating double").write.parquet(str(tmp_path / "t"))
    ratings = tables.read_parquet(spark, str(tmp_path / "t")).collect()
    assert sorted(str(r["rating"]) for r in ratings) == ["4.0", "None"]


def test_spread_leaves_wide_scans_alone(spark):
    wide, narrow = spark.range(100).repartition(20), spark.range(100).coalesce(1)
    assert tables.spread(wide) is wide
    assert tables.spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_interrupted_run_goes_on_without_gaps_or_doubles(spark, tmp_path):
    raw, staging, progress = (str(tmp_path / n) for n in ("raw", "staging", "progress"))
    spark.range(100).repartition(5).write.parquet(raw)
    arm = {"on": True}

    def change(df):
        if not arm["on"]:
            return df.withColumn("x", F.col("id") * 2)
        bad = F.when(F.col("id") == 50, F.raise_error(F.lit("lost"))).otherwise(F.lit(2)).cast("long")
        return df.withColumn("x", F.col("id") * bad)

    def run():
        return incremental.run_available(
            spark, raw, spark.read.parquet(raw).schema, change, staging, progress, 1
        )

    with pytest.raises(Exception, match="lost"):
        run()
    arm["on"] = False
    assert 1 <= run() <= 5
    assert run() == 0
    incremental.combine(spark, staging, str(tmp_path / "final"), files=1)
    final = spark.read.parquet(str(tmp_path / "final"))
    assert sorted(tuple(r) for r in final.collect()) == [(i, 2 * i) for i in range(100)]


def test_inspection(spark):
    df = spark.range(50).select(
        "id", (F.col("id") % 2 == 0).alias("is_translated"), F.lit("t").alias("cleaned_text")
    )
    assert inspection.summarize_table(df).first().asDict() == {"n_rows": 50, "n_translated": 25}
    assert inspection.summarize_table(df.select("id")).columns == ["n_rows"]
    sample = inspection.random_rows(df, 7, seed=1, key_col="id")
    assert sample.columns == ["is_translated", "cleaned_text"] and sample.count() == 7
    assert inspection.random_rows(df, 99).count() == 50


def test_jobs_from_raw_to_training_text(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in
          "labelled raw model work cleaned curated contexts summaries train test text".split()}
    spark.read.parquet(f"{DATA}/documents.parquet").write.parquet(at["labelled"])
    tables.write_parquet(raw_reviews(spark, DATA), at["raw"], max_records_per_file=20)
    model = jobs.train_detector(spark, at["labelled"], at["model"], "text", "lang")
    assert model == {"languages": ["de", "en", "es", "fr"]}
    params = CleaningParams(target_lang="en", translatable=("de", "fr", "es"))
    cleaned = jobs.clean(spark, at["raw"], at["cleaned"], at["model"], at["work"], params)
    assert cleaned["rows_in"] == 200 and cleaned["rows_out"] + cleaned["removed"] == 200
    assert cleaned["removed"] == cleaned["removed_blank"] + cleaned["removed_language"]
    again = jobs.clean(spark, at["raw"], at["cleaned"], at["model"], at["work"], params)
    assert again == cleaned | {"batches": 0}
    compact = [at[n] for n in ("raw", "summaries", "model", "train")]
    assert jobs.clean(spark, *compact, params, compact=True) == cleaned
    assert not path_exists(spark, at["train"])
    delete_path(spark, at["summaries"])
    curated = jobs.curate(spark, at["cleaned"], at["curated"])
    assert curated["kept_rows"] + curated["removed_rows"] == curated["rows"] == cleaned["rows_out"]
    places = jobs.contexts(spark, at["curated"], at["contexts"])
    assert jobs.enrich(spark, at["contexts"], at["summaries"])["succeeded"] == places["kept_places"]
    chats = jobs.prepare_chat(spark, at["summaries"], at["train"], at["test"])
    assert chats["train"] + chats["test"] == places["kept_places"]
    assert jobs.render(spark, at["train"], at["text"])["examples"] == chats["train"]
    assert jobs.inspect(spark, at["cleaned"], 3)["n_rows"] == cleaned["rows_out"]
    assert "error" in jobs.inspect(spark, str(tmp_path / "nothing"))


def test_batches_are_counted_by_their_ids(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    spark.range(60).repartition(6).write.parquet(raw)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        schema = spark.read.parquet(raw).schema
        folders = (str(tmp_path / "staging"), str(tmp_path / "progress"), 1)
        assert incremental.run_available(spark, raw, schema, lambda df: df, *folders) == 6
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_job_runs_from_anywhere(spark, tmp_path):
    """As a process of its own, in another folder, without PYTHONPATH."""
    spark.createDataFrame([("bir metin",), ("another",)], "review_text string").write.parquet(
        str(tmp_path / "raw")
    )
    rows = [("güzel yemek", "tr"), ("good food", "en")]
    spark.createDataFrame(rows, "text string, lang string").write.parquet(str(tmp_path / "labelled"))
    script = Path(__file__).resolve().parent.parent / "run_job.py"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for arguments in (["train-detector", "labelled", "model", "text", "lang"],
                      ["clean", "raw", "cleaned", "model", "work"]):
        ran = subprocess.run(
            [sys.executable, str(script), *arguments], cwd=tmp_path, env=env,
            capture_output=True, text=True, timeout=300,
        )
        assert ran.returncode == 0, ran.stderr[-2000:]
    assert '"rows_in": 2' in ran.stdout


def test_command_line(spark, tmp_path, capsys):
    spark.createDataFrame(
        [(i, "p", "P", 5.0, "en", "güzel yemek") for i in range(12)],
        "review_id long, place_id string, place_name string, rating double, detected_lang string, "
        "cleaned_text string",
    ).write.parquet(str(tmp_path / "cleaned"))
    jobs.main(["curate", str(tmp_path / "cleaned"), str(tmp_path / "curated")])
    jobs.main(["contexts", str(tmp_path / "curated"), str(tmp_path / "contexts"), "--max-reviews", "3"])
    assert '"kept_places": 1' in capsys.readouterr().out
    text = spark.read.parquet(str(tmp_path / "contexts")).first()["llm_input_context"]
    assert text == "\n".join(["- [Puan: 5/5]: güzel yemek"] * 3)
