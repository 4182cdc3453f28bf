"""Contexts against a brute-force count, on ordinary, hot and awkward places."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reviewcraft.operators import context as cx

SCHEMA = "review_id long, place_id string, place_name string, rating double, cleaned_text string"


def make_reviews(seed=3):
    rng = random.Random(seed)
    rows, sizes = [], {"min": 10, "below": 9, "max": 25, "above": 26, "mid": 18, "big": 400, "none": 30}
    for place, size in sizes.items():
        for _ in range(size):
            rating = rng.choice([1.0, 2.0, 4.5, 5.0, 5.0, 5.0, None])
            if place == "none":
                rating = None
            text = " ".join(["kelime"] * rng.choice([1, 5, 9, 10, 11, 40, 80, 81, 200]))
            rows.append((len(rows), place, rng.choice([None, f"{place}-A", f"{place}-B"]), rating, text))
    # a third of all rows: one place, mostly copies of one review
    for i in range(250):
        rows.append((len(rows), "hot", "Hot", 5.0 if i % 10 else 1.0, "aynı yorum tekrar tekrar"))
    # sixty different ratings: no share is large enough for a single review
    for i in range(60):
        rows.append((len(rows), "spread", "Spread", float(i), "tek tek puanlar"))
    rows.append((len(rows), None, "Nowhere", 5.0, "yer yok"))
    rng.shuffle(rows)
    return rows


def brute_force(rows, most, least):
    places = {}
    for row in rows:
        if row[1] is not None:
            places.setdefault(row[1], []).append(row)
    result = {}
    for place, members in places.items():
        if len(members) < least:
            continue
        rated = [m for m in members if m[3] is not None]
        by_rating = {}
        for m in rated:
            by_rating.setdefault(m[3], []).append(m)
        chosen = []
        for same in by_rating.values():
            same.sort(key=lambda m: (-score(m[4]), m[0]))
            room = most if len(members) <= most else int(round(len(same) / len(rated) * most))
            chosen += same[:room]
        chosen.sort(key=lambda m: hashlib.md5(f"42:{m[0]}".encode()).hexdigest())
        lines = [f"- [Puan: {int(m[3])}/5]: {m[4]}" for m in chosen]
        names = [m[2] for m in sorted(members) if m[2] is not None]
        mean = sum(m[3] for m in rated) / len(rated) if rated else None
        result[place] = (
            "\n".join(lines),
            names[0] if names else None,
            len(members),
            round(mean * 100) / 100 if mean is not None else None,
        )
    return result


def score(text):
    words = len(text.split())
    return words / 2 if words < 10 else min(words, 80)


@pytest.mark.parametrize("salts", [1, 3])
@pytest.mark.parametrize("most", [25, 40])
def test_contexts(spark, salts, most):
    rows = make_reviews()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    params = cx.ContextParams(max_reviews=most, salts=salts)
    got = {r[0]: tuple(r)[1:] for r in cx.build_context(df, params).collect()}
    assert got == brute_force(rows, most, 10)


@pytest.mark.parametrize("salts", [1, 3])
def test_sample_stays_within_allocation(spark, salts):
    df = spark.createDataFrame(make_reviews(), SCHEMA)
    params = cx.ContextParams(salts=salts)
    sample = cx.sample_reviews(df, params).groupBy("place_id", "rating").agg(F.count("*").alias("n"))
    allocations = cx.rating_allocations(df, params)
    large = df.groupBy("place_id").count().filter("count > 25")
    over = sample.join(allocations, ["place_id", "rating"]).join(large, "place_id").filter("n > alloc")
    assert over.count() == 0


def exchanges(df):
    """Columns of each shuffle of the plan."""
    import re

    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffled = re.findall(r"Exchange hashpartitioning\(.*", plan)
    return plan, shuffled


@pytest.mark.parametrize("salts", [1, 3])
def test_rows_are_cut_before_they_are_ranked(spark, salts):
    df = spark.createDataFrame(make_reviews(), SCHEMA)
    plan, _ = exchanges(cx.build_context(df, cx.ContextParams(salts=salts)))
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_texts_move_after_the_cut(spark, tmp_path):
    """The one shuffle that carries texts is that of the chosen reviews to their places."""
    spark.createDataFrame(make_reviews(), SCHEMA).write.parquet(str(tmp_path / "reviews"))
    df = spark.read.parquet(str(tmp_path / "reviews"))
    ranked = cx._picks(df, cx._place_tables(df, cx.ContextParams())[1], cx.ContextParams())
    assert "cleaned_text" not in ranked.columns
    result = cx.build_context(df)
    sent = [e for e in _exchange_outputs(result) if "cleaned_text" in e]
    assert len(sent) <= 1


def _exchange_outputs(df):
    """Names of the columns that each shuffle of the final plan sends."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName() in ("Exchange", "BroadcastExchange"):
            found.append(node.output().mkString(","))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif hasattr(node, "plan") and node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    assert found
    return found


def test_counts_and_minimum(spark):
    df = spark.createDataFrame(make_reviews(), SCHEMA)
    assert cx.place_counts(df).first().asDict() == {
        "initial_places": 9, "kept_places": 8, "removed_places": 1,
    }
    kept = {r["place_id"] for r in cx.filter_min_reviews(df).select("place_id").distinct().collect()}
    assert "below" not in kept and None not in kept and len(kept) == 8


def test_content_ids_do_not_change_the_text(spark):
    rows = [(None, "p", "P", 5.0, "aynı yorum")] * 30
    df = spark.createDataFrame([r[1:] for r in rows], SCHEMA.split(", ", 1)[1])
    text = cx.build_context(cx.with_review_id(df)).first()["llm_input_context"]
    assert text == "\n".join(["- [Puan: 5/5]: aynı yorum"] * 25)
