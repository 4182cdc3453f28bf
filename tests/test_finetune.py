"""Messages, split, template."""

import math

import pytest
from pyspark.sql import functions as F

from reviewcraft import fixed_values as fv
from reviewcraft import schemas
from reviewcraft.operators import finetune as ft
from reviewcraft.plans import jobs
from reviewcraft.sources import jsonl


def summaries(spark, n):
    rows = [(f"p{i}", None, f"bağlam {i}", f'özet "{i}"\nsatır') for i in range(n)]
    return spark.createDataFrame(rows, schemas.SUMMARIES)


def test_messages_and_template(spark):
    example = ft.to_chat_examples(summaries(spark, 1))
    messages = [tuple(m) for m in example.first()["messages"]]
    assert messages == [
        ("system", fv.CHAT_SYSTEM_PROMPT),
        ("user", "Müşteri Yorumları:\nbağlam 0"),
        ("assistant", 'özet "0"\nsatır'),
    ]
    text = example.select(ft.render_chat(F.col("messages")).alias("text")).first()["text"]
    assert text == "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in messages)


@pytest.mark.parametrize("n, test_size", [(2, 0.03), (100, 0.03), (1000, 0.03), (1000, 0.5), (999, 0.999)])
def test_exact_split(spark, n, test_size):
    train, test = ft.train_test_split(spark.range(n), "id", test_size)
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert len(b) == math.ceil(test_size * n) and not a & b and a | b == set(range(n))


def test_copies_of_one_key_stay_on_one_side(spark):
    ids = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(7)).otherwise(F.col("id")).alias("id"))
    marked = ft.mark_test_rows(ids, "id", 0.3).groupBy("id").agg(F.countDistinct("is_test").alias("sides"))
    assert marked.filter("sides > 1").count() == 0
    n = ft.mark_test_rows(ids, "id", 0.3).filter("is_test").count()
    assert 300 <= n < 700


def test_stable_split_keeps_sides_as_the_table_grows(spark):
    def test_ids(n):
        marked = ft.mark_test_rows(spark.range(n), "id", 0.1, exact=False)
        return {r["id"] for r in marked.filter("is_test").collect()}

    small, large = test_ids(1000), test_ids(5000)
    assert small == {i for i in large if i < 1000}
    assert 0.08 < len(large) / 5000 < 0.12


def test_split_has_no_global_sort(spark):
    plan = ft.mark_test_rows(spark.range(1000), "id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "TakeOrdered" not in plan


def test_chat_files(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("summaries", "train", "test", "text")]
    jsonl.append(summaries(spark, 60), paths[0])
    assert jobs.prepare_chat(spark, *paths[:3]) == {"train": 58, "test": 2}
    assert "\\u" not in spark.read.text(paths[1]).first()["value"]
    assert jobs.render(spark, paths[1], paths[3]) == {"examples": 58, "too_long": 0}


def test_equal_records_are_all_kept(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("summaries", "train", "test")]
    jsonl.append(summaries(spark, 60), paths[0])
    jsonl.append(summaries(spark, 5), paths[0])
    found = jobs.prepare_chat(spark, *paths)
    assert found["train"] + found["test"] == 65
    for path, n in zip(paths[1:], (found["train"], found["test"]), strict=True):
        assert spark.read.text(path).count() == n


@pytest.mark.parametrize("nulls", [0, 1, 10, 100])
@pytest.mark.parametrize("exact", [True, False])
def test_rows_without_a_key_have_a_side(spark, nulls, exact):
    rows = [(None if i < nulls else i, f"text {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "key bigint, text string")
    train, test = ft.train_test_split(df, "key", 0.03, exact=exact)
    found = [r["text"] for part in (train, test) for r in part.collect()]
    assert sorted(found) == sorted(text for _, text in rows)
    if exact:
        assert test.count() == 3


def test_chat_files_keep_every_record(spark, tmp_path):
    rows = [(None if i < 5 else f"p{i}", "n", f"c{i}", f"s{i}") for i in range(100)]
    rows.append(("p50", "n", "c50", "another summary"))
    jsonl.append(spark.createDataFrame(rows, schemas.SUMMARIES), str(tmp_path / "s"))
    counts = jobs.prepare_chat(spark, str(tmp_path / "s"), str(tmp_path / "a"), str(tmp_path / "b"))
    assert sum(counts.values()) == 101


def test_no_training_rows_is_an_error(spark, tmp_path):
    jsonl.append(summaries(spark, 1), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="no training"):
        jobs.prepare_chat(spark, str(tmp_path / "s"), str(tmp_path / "a"), str(tmp_path / "b"))


def test_length_budget(spark):
    df = spark.createDataFrame([("x" * 8192,), ("x" * 8193,)], "text string")
    rows = ft.with_length_budget(df).orderBy("approx_tokens").collect()
    assert [(r["approx_tokens"], r["fits"]) for r in rows] == [(2048, True), (2049, False)]


def plain_fit(messages, max_tokens):
    """The longest contents lose one character at a time, down to the same length."""
    tags = sum(len(f"<|im_start|>{r}\n<|im_end|>\n") for r, _ in messages)
    room = max(4 * max_tokens - tags, 0)
    lengths = [len(c or "") for _, c in messages]
    level = max(lengths, default=0)
    while level and sum(min(n, level) for n in lengths) > room:
        level -= 1
    return [(r, c if c is None else c[:level]) for r, c in messages]


def test_messages_are_cut_to_a_level(spark):
    import random

    rng = random.Random(8)
    rows = []
    for i in range(60):
        turns = [
            (rng.choice(["user", "assistant"]), "é" * rng.choice([0, 1, 3, 40, 90, 300]))
            for _ in range(rng.randint(1, 6))
        ]
        rows.append((i, turns))
    rows += [(100, [("user", None), ("assistant", "x" * 500)]), (101, []), (102, [("user", "y" * 90)] * 3)]
    df = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")
    for budget in (0, 20, 60, 200):
        fitted = df.withColumn("fitted", ft.fit_messages(F.col("messages"), budget))
        for row in fitted.collect():
            wanted = plain_fit([tuple(m) for m in row["messages"]], budget)
            assert [tuple(m) for m in row["fitted"]] == wanted


def test_turns_without_role_or_content_leave_the_text_within_the_budget(spark):
    rows = [
        (1, [(None, "x" * 500), ("user", "y" * 500)]),
        (2, [("user", None), ("assistant", "y" * 500)]),
        (3, [("user", "y" * 500), (None, None)]),
    ]
    df = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")
    fitted = df.withColumn("messages", ft.fit_messages(F.col("messages"), 60))
    text = ft.render_chat(F.col("messages"))
    found = {r["id"]: r for r in fitted.select("*", F.length(text).alias("n")).collect()}
    # 240 characters; tags take 28 for a user's turn and 33 for an assistant's
    assert {i: r["n"] for i, r in found.items()} == {1: 28 + 106, 2: 33 + 179, 3: 240}
    assert [(m["role"], len(m["content"])) for m in found[1]["messages"]] == [(None, 106), ("user", 106)]


def test_cut_examples_fit(spark):
    rows = [("p", "a " * 3000, "b" * 50)]
    df = spark.createDataFrame(rows, "place_id string, input_context string, target_summary string")
    chat = ft.to_chat_examples(df, "place_id")
    cut = chat.withColumn("messages", ft.fit_messages(F.col("messages"), 400))
    row = ft.with_length_budget(cut.select(ft.render_chat(F.col("messages")).alias("text")), "text", 400).first()
    assert row["fits"] and row["approx_tokens"] > 380 and row["text"].endswith("b" * 50 + "<|im_end|>\n")
