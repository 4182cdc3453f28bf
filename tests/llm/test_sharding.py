import hashlib
from collections import defaultdict

import pytest

from reviewcraft.llm import sharding
from tests.llm.fixtures import DOCS, empty_docs, odd_docs, odd_rows


def plain_shards(rows, limit):
    """Split buckets one bit at a time until they fit or hold one hash only."""
    docs = []
    for i, (doc_id, text, *_) in enumerate(rows):
        inner = hashlib.md5((text or "").encode()).hexdigest()
        key = f"{'' if doc_id is None else doc_id}/{inner}"
        docs.append((int(hashlib.md5(key.encode()).hexdigest()[:15], 16), len((text or "").encode()), i))
    out, todo = {}, [("", docs)]
    while todo:
        bits, bucket = todo.pop()
        total = sum(d[1] for d in bucket)
        if total <= limit or len({d[0] for d in bucket}) == 1:
            per_page = max(1, limit // max(1, bucket[0][1])) if bucket else 1
            for no, d in enumerate(bucket):
                out[d[2]] = f"s{bits}-p{no // per_page}" if total > limit else f"s{bits}"
            continue
        at = 59 - len(bits)
        for bit in "01":
            part = [d for d in bucket if d[0] >> at & 1 == int(bit)]
            if part:
                todo.append((bits + bit, part))
    return sorted(str((rows[i][0], shard)) for i, shard in out.items())


@pytest.mark.parametrize("limit", [10**9, 20_000, 3_000, 400, 50])
def test_against_bit_by_bit_splits(spark, limit):
    rows = odd_rows() + [(3, "copied text of some length " * 3, "", "", 0)] * 25
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = sharding.shard_documents(docs, limit).collect()
    assert sorted(str((r["doc_id"], r["shard"])) for r in found) == plain_shards(rows, limit)
    sizes = defaultdict(int)
    for r in found:
        sizes[r["shard"]] += len((r["text"] or "").encode())
    assert all(sizes[r["shard"]] == r["shard_bytes"] for r in found)
    assert all(r["fits"] == (r["shard_bytes"] <= limit) for r in found)


def test_many_rounds_of_bits(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUND_BITS", 3)
    rows = odd_rows()
    found = sharding.shard_documents(odd_docs(spark), 400).collect()
    assert sorted(str((r["doc_id"], r["shard"])) for r in found) == plain_shards(rows, 400)


def test_native_plan(spark):
    sharded = sharding.shard_documents(odd_docs(spark), 3_000)
    plan = sharded._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_and_clashing_columns(spark, tmp_path):
    assert sharding.shard_documents(empty_docs(spark)).count() == 0
    clash = odd_docs(spark).withColumnRenamed("lang", "shard").withColumnRenamed("source", "cell")
    found = sharding.shard_documents(clash, 3_000)
    assert found.columns.count("shard") == 1 and found.count() == len(odd_rows())
    sharding.write_shards(odd_docs(spark), str(tmp_path / "shards"), 3_000)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(odd_rows())
