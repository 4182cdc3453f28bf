"""Pending work, retries, stopping, resuming."""

import pytest
from pyspark.sql import functions as F

from reviewcraft import schemas
from reviewcraft.operators import completed
from reviewcraft.operators import enrichment as en
from reviewcraft.plans import jobs
from reviewcraft.sources import jsonl, tables


def contexts(spark, n=6):
    rows = [(f"p{i}", f"- [Puan: 5/5]: yorum {i}", f"Place {i}", 10, 4.5) for i in range(n)]
    return spark.createDataFrame(rows, schemas.CONTEXTS)


def quiet(**kwargs):
    return en.CallPolicy(pause_seconds=0, wait_seconds=0, **kwargs)


def test_pending_keeps_rows_without_key(spark):
    everything = contexts(spark).unionByName(
        spark.createDataFrame([(None, "x", None, 1, 1.0)], schemas.CONTEXTS)
    )
    done = spark.createDataFrame([("p0",), ("p0",), (None,)], "place_id string")
    pending = en.pending_contexts(everything, en.completed_places(done))
    assert sorted(str(r["place_id"]) for r in pending.collect()) == ["None", "p1", "p2", "p3", "p4", "p5"]
    assert [r["place_id"] for r in en.daily_share(pending.filter("place_id is not null"), 2).collect()] == ["p1", "p2"]


def test_only_rate_limits_are_tried_again():
    waits, calls = [], []

    def limited(prompt, context):
        calls.append(context)
        raise RuntimeError("HTTP 429")

    policy = en.CallPolicy(sleep=waits.append)
    with pytest.raises(RuntimeError, match="all 3 attempts"):
        en.call_with_retries(limited, "c", policy)
    assert len(calls) == 3 and waits == [10, 20, 30]

    def broken(prompt, context):
        calls.append(context)
        raise ValueError("bad key")

    with pytest.raises(ValueError):
        en.call_with_retries(broken, "c", policy)
    assert len(calls) == 4

    answers = iter([RuntimeError("RATE_LIMIT"), "  özet \n"])

    def second_time(prompt, context):
        answer = next(answers)
        if isinstance(answer, Exception):
            raise answer
        return answer

    assert en.call_with_retries(second_time, "c", policy) == "özet"


def test_failure_stops_the_task_and_leaves_rows_pending(spark):
    def factory():
        def summarize(prompt, context):
            if "yorum 3" in context:
                raise ValueError("refused")
            return "özet"

        return summarize

    rows = en.summarize_with_backend(contexts(spark).coalesce(1), factory, quiet()).collect()
    states = [r["status"] for r in rows]
    assert states.count("failed") == 1
    at = states.index("failed")
    assert set(states[:at]) <= {"ok"} and set(states[at + 1 :]) <= {"skipped"}
    assert [r["error"] for r in rows if r["status"] == "failed"] == ["refused"]


def test_daily_runs_resume_and_add_nothing_twice(spark, tmp_path):
    source, target = str(tmp_path / "contexts"), str(tmp_path / "summaries")
    tables.write_parquet(contexts(spark), source)
    tried = [jobs.enrich(spark, source, target, limit=4)["tried"] for _ in range(3)]
    assert tried == [4, 2, 0]
    summaries = jsonl.read_strict(spark, target, schemas.SUMMARIES).collect()
    assert sorted(r["place_id"] for r in summaries) == [f"p{i}" for i in range(6)]
    assert {r["target_summary"] for r in summaries} == {f"- [Puan: 5/5]: yorum {i}" for i in range(6)}


def test_failed_places_are_tried_again_the_next_day(spark, tmp_path):
    source, target = str(tmp_path / "contexts"), str(tmp_path / "summaries")
    tables.write_parquet(contexts(spark), source)
    first = jobs.enrich(spark, source, target, lambda: lambda p, c: (_ for _ in ()).throw(ValueError("no")), policy=quiet())
    assert first["succeeded"] == 0 and first["first_error"] == "no"
    second = jobs.enrich(spark, source, target, lambda: lambda p, c: c.upper(), policy=quiet(concurrency=3))
    assert second["succeeded"] == 6


def test_a_stopped_run_keeps_its_finished_parts(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("contexts", "summaries", "log"))
    tables.write_parquet(contexts(spark), source)

    def factory(dies):
        def summarize(prompt, context):
            with open(log, "a") as calls:
                calls.write(context[-1])
            if dies and "yorum 3" in context:
                raise ValueError("refused")
            return "özet"

        return summarize

    policy = quiet(concurrency=1, calls_per_task=2)
    first = jobs.enrich(spark, source, target, lambda: factory(True), policy=policy)
    assert (first["tried"], first["succeeded"]) == (4, 3)
    second = jobs.enrich(spark, source, target, lambda: factory(False), policy=policy)
    assert second["succeeded"] == 3
    calls = open(log).read()
    assert sorted(calls) == sorted("01233" + "45")
    assert jobs.enrich(spark, source, target, lambda: factory(True), policy=policy)["tried"] == 0


def test_contexts_without_a_place_stay_out_of_the_file(spark, tmp_path):
    source, target = str(tmp_path / "contexts"), str(tmp_path / "summaries")
    odd = spark.createDataFrame([(None, "- [Puan: 5/5]: x", "P", 4, 1.0)], schemas.CONTEXTS)
    tables.write_parquet(contexts(spark).unionByName(odd), source)
    assert jobs.enrich(spark, source, target)["tried"] == 6
    assert jobs.enrich(spark, source, target)["tried"] == 0
    assert jobs.enrich(spark, str(tmp_path / "absent"), target)["tried"] == 0


def test_extractive_summary_prefers_informative_lines(spark):
    lines = ["kısa", "on bir kelime " * 4, "uzun " * 90, "orta " * 30]
    df = spark.createDataFrame([("p", "\n".join(lines), "P", 4, 1.0)], schemas.CONTEXTS)
    summary = en.summarize_extractively(df, sentences=2).first()["target_summary"]
    assert summary == "uzun " * 90 + " " + "orta " * 30


def keys_of(spark, n):
    ids = [(f"p{i:05d}",) for i in range(n)]
    return spark.createDataFrame(ids, "place_id string").repartition(7)


def test_numbers_follow_the_keys_without_one_task(spark, tmp_path):
    def store(df):
        df.write.parquet(str(tmp_path / "ranges"))
        return spark.read.parquet(str(tmp_path / "ranges"))

    found = en.numbered(keys_of(spark, 1000), store)
    assert [r["number"] for r in found.orderBy("place_id").collect()] == list(range(1000))
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    share = en.share_of(found, limit=100, slots=3, calls_per_slot=4)
    rows = share.orderBy("place_id").collect()
    assert [(r["part"], r["slot"]) for r in rows] == [(i // 12, i // 4 % 3) for i in range(100)]


def test_numbers_of_nothing(spark, tmp_path):
    def store(df):
        df.write.parquet(str(tmp_path / "ranges"))
        return spark.read.schema(df.schema).parquet(str(tmp_path / "ranges"))

    assert en.numbered(keys_of(spark, 0), store).count() == 0


@pytest.mark.parametrize("most_bits", [1 << 29, 1 << 15])
def test_pending_keys_equal_the_anti_join(spark, monkeypatch, most_bits):
    """Also with a filter far too small, in which every bit is set."""
    monkeypatch.setattr(en, "_FILTER_MAX_BITS", most_bits)
    everything = keys_of(spark, 60_000).withColumn("llm_input_context", F.lit("x")).unionByName(
        spark.createDataFrame([(None, "y"), ("p00001", "again")], "place_id string, llm_input_context string")
    )
    done = keys_of(spark, 60_000).filter("place_id < 'p45000'")
    found = en.pending_keys(everything, done)
    assert found.count() == 15_000 and found.agg(F.min("place_id")).first()[0] == "p45000"
    assert en.pending_keys(everything, done.limit(0)).count() == 60_000


def test_only_new_summary_files_are_read(spark, tmp_path):
    target = str(tmp_path / "with space")
    record = lambda i: (f"p{i}", f"Place {i}", "in", "out")
    assert completed.refresh(spark, target) == 0
    assert completed.completed_keys(spark, target).count() == 0
    for i in range(3):
        jsonl.append(spark.createDataFrame([record(i)], schemas.SUMMARIES).coalesce(1), target)
        assert completed.refresh(spark, target) == 1
    assert completed.refresh(spark, target) == 0
    (tmp_path / "with space" / "by hand.json").write_text('{"place_id": "p7"}\nnot json\n')
    (tmp_path / "with space" / "empty.json").write_text("broken\n")
    assert completed.refresh(spark, target) == 2
    assert completed.refresh(spark, target) == 0
    keys = lambda: {r["place_id"] for r in completed.completed_keys(spark, target).collect()}
    assert keys() == {"p0", "p1", "p2", "p7"}
    (tmp_path / "with space" / "by hand.json").unlink()
    assert keys() == {"p0", "p1", "p2"}


def test_a_record_without_a_place_is_an_error(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "x.json").write_text('{"target_summary": "lost"}\n')
    with pytest.raises(Exception, match="record without place_id"):
        completed.refresh(spark, str(tmp_path / "s"))


def test_one_failure_stops_all_tasks(spark, tmp_path):
    """Four tasks of five rows each: one refusal, then no further call starts."""
    log = str(tmp_path / "log")

    def factory():
        def summarize(prompt, context):
            with open(log, "a") as calls:
                calls.write("x")
            if context == "3":
                raise ValueError("refused")
            return "özet"

        return summarize

    rows = [(f"p{i}", str(i), "P", 1, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, schemas.CONTEXTS)
    policy = quiet(concurrency=4)
    assert en.can_stop_together(spark, policy)
    states = [r["status"] for r in en.summarize_with_backend(df, factory, policy).collect()]
    assert states.count("failed") == 1 and len(states) == 20
    calls = len(open(log).read())
    assert calls == states.count("ok") + 1
    # all four tasks were asked equally often before they stopped
    assert calls <= 20 and (calls % 4 == 0 or states.count("skipped") == 0)
    again = en.summarize_with_backend(df, lambda: lambda p, c: "ok", policy).collect()
    assert [r["status"] for r in again] == ["ok"] * 20


def test_more_calls_at_once_than_slots_need_no_barrier(spark):
    policy = quiet(concurrency=spark.sparkContext.defaultParallelism + 1)
    assert not en.can_stop_together(spark, policy)
    df = contexts(spark)
    rows = en.summarize_with_backend(df, lambda: lambda p, c: c, policy).collect()
    assert [r["status"] for r in rows] == ["ok"] * 6


def test_texts_of_a_share_are_read_once(spark, tmp_path, monkeypatch):
    """Every part reads its own folder; the contexts' texts are scanned by one write."""
    source, target = str(tmp_path / "contexts"), str(tmp_path / "summaries")
    tables.write_parquet(contexts(spark, 20), source)
    seen = []
    backend = en.summarize_with_backend

    def looked_at(rows, *args):
        seen.append(rows.inputFiles())
        return backend(rows, *args)

    monkeypatch.setattr(en, "summarize_with_backend", looked_at)
    found = jobs.enrich(
        spark, source, target, lambda: lambda p, c: c, policy=quiet(concurrency=2, calls_per_task=3)
    )
    assert found["succeeded"] == 20 and found["parts"] == len(seen) == 4
    for part, files in enumerate(seen):
        assert files and all(f"/share/part={part}/" in name for name in files)


def test_calls_of_a_part_need_no_barrier(spark, tmp_path):
    """Calls of one task run at once in rounds; a failure ends them, and no tasks have to agree."""
    log = str(tmp_path / "log")

    def factory(bad):
        def summarize(prompt, context):
            with open(log, "a") as calls:
                calls.write("x")
            if context == bad:
                raise ValueError("refused")
            return "özet"

        return summarize

    rows = [(f"p{i:02d}", str(i), "P", 1, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, schemas.CONTEXTS)
    called = en.summarize_with_backend(df, lambda: factory("5"), quiet(concurrency=4), 16)
    states = [r["status"] for r in called.collect()]
    assert states == ["ok"] * 5 + ["failed"] + ["ok"] * 2 + ["skipped"] * 12
    assert len(open(log).read()) == 8
    plan = called._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    states = [r["status"] for r in en.summarize_with_backend(df, lambda: factory(""), quiet(concurrency=20), 16).collect()]
    assert states == ["ok"] * 20


def test_a_part_is_one_job(spark, tmp_path):
    source, target = str(tmp_path / "contexts"), str(tmp_path / "summaries")
    tables.write_parquet(contexts(spark, 12), source)
    tracker, jobs_of = spark.sparkContext.statusTracker(), []
    for calls in (6, 1):
        spark.sparkContext.setJobGroup(f"parts-{calls}", "")
        policy = quiet(concurrency=2, calls_per_task=calls)
        found = jobs.enrich(spark, source, f"{target}{calls}", lambda: lambda p, c: c, policy=policy)
        assert found["succeeded"] == 12 and found["parts"] == 6 // calls
        jobs_of.append(len(tracker.getJobIdsForGroup(f"parts-{calls}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_of[1] - jobs_of[0] <= 6
