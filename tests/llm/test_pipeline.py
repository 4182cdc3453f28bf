import corpus_pipeline
from tests.llm.fixtures import DOCS, odd_rows, words


def write_inputs(spark, folder, rows, items):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return str(folder)


def test_decisions_take_effect(spark, tmp_path):
    import random

    rng = random.Random(2)
    item = words(rng, 25)
    rows = odd_rows() + [(600, f"{words(rng, 30)} {item} {words(rng, 30)}", "en", "s", 1)]
    rows += [(601, "12345 67890", "en", "s", 1), (602, "漢字" * 100, None, "s", 1)]
    folder = write_inputs(spark, tmp_path / "in", rows, [(1, item)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name != "best_fit_packing":
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
    rejected = {r[0] for r in rows} - set(kept["language_id"])
    assert rejected == {500, 501, 502, 601, 602}
    assert 300 in kept["simhash_near_dedup"] and 301 not in kept["simhash_near_dedup"]
    assert len(kept["suffix_array_dedup"]) == len(kept["simhash_near_dedup"])
    gone = set(kept["suffix_array_dedup"]) - set(kept["benchmark_decontamination"])
    assert gone == {600}
    packed = docs.toPandas()
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()
    assert set(kept["best_fit_packing"]) == set(kept["benchmark_decontamination"])


def test_empty_documents(spark, tmp_path):
    folder = write_inputs(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
