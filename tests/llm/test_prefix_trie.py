import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reviewcraft.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def graft(c):
    return c - (abs(c) % 20) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 4


def brute_force(rows, rebuild=graft):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        base, head = rebuild(c)
        built[c] = own.get(base, [])[:head] + own[c][head:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
        ends = sorted(c for c in members[node] if len(built[c]) == len(node))
        out.append(
            (
                min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                len(members[node]), len(children[node]), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def trie(df):
    conv = F.col("conv_id")
    return prefix_trie.prefix_trie(df, conv - conv % 20, F.crc32(conv.cast("string")) % 4)


def found(df):
    return sorted((tuple(r) for r in trie(df).drop("words").collect()), key=repr)


def odd_rows():
    rng = random.Random(4)
    lines = ["a b", "c", "", "two  words\there", "é x"]
    rows = []
    for c in [*range(60), -3, -20, 1000, 10**15]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(lines)))
    rows += [(200, t, "user", "hello there") for t in range(80)]
    rows += [(201, t, "user", "hello there") for t in range(75)]
    rows += [(300 + i, t, "user", "same") for i in range(50) for t in range(3)]
    rows += [(5, None, None, None), (5, None, "user", "first"), (None, 1, "user", "lost")]
    rows += [(70, 3, "user", "tie"), (70, 3, "assistant", "tie"), (71, 0, "u", "r"), (71, 0, "u", "r")]
    return rows


def test_equals_brute_force(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).withColumn(
        "part", F.lit(1)
    )
    assert found(df.repartition(5)) == brute_force(rows)


def test_long_conversations_cross_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEPTH_BLOCK", 7)
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2, 40) for t in range(300)]
    rows += [(3, t, "user", f"turn {t}") for t in range(150)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_screen_gives_the_same(spark, monkeypatch):
    """With a sketch of one cell a half, everything is grouped exactly."""
    rows = odd_rows()
    wanted = brute_force(rows)
    monkeypatch.setattr(prefix_trie, "two_cells", lambda key, cells: (key.astype("int64") * 0,) * 2)
    monkeypatch.setattr(prefix_trie, "both_set", lambda bits, key: key == key)
    assert found(spark.createDataFrame(rows, SCHEMA)) == wanted


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversations(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == []


def test_turnless(spark):
    """Base 20 exists with no turn to give; heads of 21 and 22 are longer than they are."""
    conv = next(c for c in range(21, 40) if graft(c)[1] == 3)
    rows = [(conv, 0, "user", "gone"), (conv, 1, "user", "gone too")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)


def test_plain_tries_need_no_rebuilding(spark):
    rows = odd_rows()
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).drop("words").collect()
    wanted = brute_force(rows, lambda c: (c, 0))
    assert sorted((tuple(r) for r in got), key=repr) == wanted
