"""Prefix trie of conversations (operator 11).

A node is a distinct sequence of first turns; its members are the conversations that start
with it. A prefix is known by its digest, a polynomial hash over its turns (two residues
modulo a prime of 61 bits) with its depth. Such hashes compose, so a conversation of any
length may be cut over tasks:

1. Turns are hashed where they are read. Ranges of (conversation, turn) are sorted, and each
   task takes the prefix digests of its own runs; the runs that cross tasks are composed.
2. A count-min sketch over all prefix digests shows which may be shared. An estimate of one
   proves that a prefix has a single member, and so have all deeper ones: such tails
   become nodes where they are. Only possibly shared prefixes are shuffled and grouped.
3. Sums over subtrees become sums over members: each node counts for its smallest member,
   and a member brings to a node what it counts for below it.

The sketch has at most ``cells.MAX_CELLS`` cells. Beyond some 10^8 prefixes a part of the tails
is therefore grouped too; the result is the same.

Rows without a conversation id belong to no conversation and are left out. Null roles and
texts are empty ones. Turns with equal numbers follow each other by role, then by the hash of
their content, so repeated rows are turns of their own. An empty table has no nodes.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft.llm.cells import both_set, cells_for, mixed, tallied_bits, two_cells
from reviewcraft.llm.common import bounded_batches, stored

PRIME = (1 << 61) - 1
BASES = (1_152_921_504_606_846_883 % PRIME, 730_750_818_665_451_459)
_INVERSE = tuple(pow(b, -1, PRIME) for b in BASES)
WORD = r"[^\x20\x09-\x0D]+"
#: Ids that are hashed as one string.
IDS_PER_CHUNK = 4096
#: Depths of one partial sum along a conversation.
DEPTH_BLOCK = 1024
NODE = ["depth", "k1", "k2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _fields(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


# --- digests --------------------------------------------------------------------------------

_RUNS = "part int, conv_id long, rank long, p1 long, p2 long, x1 long, x2 long, words long"


def _run_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank and prefix digest of each turn within the run of its conversation in this task."""
    from pyspark import TaskContext

    part, schema = TaskContext.get().partitionId(), _fields(_RUNS)
    conv, rank, p1, p2 = None, 0, 0, 0
    for batch in batches:
        out = []
        for c, x1, x2, words in zip(*_columns(batch, "conv_id", "x1", "x2", "words"), strict=True):
            if c != conv:
                conv, rank, p1, p2 = c, 0, 0, 0
            rank += 1
            p1 = (p1 * BASES[0] + x1) % PRIME
            p2 = (p2 * BASES[1] + x2) % PRIME
            out.append((part, c, rank, p1, p2, x1, x2, words))
        yield _batch(out, schema)


_OFFSETS = "conv_id long, part int, before long, o1 long, o2 long"


def _run_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies before each run of a conversation that several tasks share."""
    schema = _fields(_OFFSETS)
    for batch in batches:
        out = []
        for conv, runs in zip(*_columns(batch, "conv_id", "runs"), strict=True):
            before, o1, o2 = 0, 0, 0
            for run in sorted(runs, key=lambda r: r["part"]):
                out.append((conv, run["part"], before, o1, o2))
                before += run["n"]
                o1 = (o1 * pow(BASES[0], run["n"], PRIME) + run["p1"]) % PRIME
                o2 = (o2 * pow(BASES[1], run["n"], PRIME) + run["p2"]) % PRIME
        yield _batch(out, schema)


#: The plan of a conversation: turns of its own that go, turns grafted, what its digests need.
_PLANS = (
    "conv_id long, own long, taken long, d1 long, d2 long, depth long, "
    "heads array<struct<depth:long,k1:long,k2:long,q1:long,q2:long,words:long>>"
)


def _graft_plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each conversation is rebuilt: its grafted head, and what its own digests need."""

    def digests(turns: list[dict]) -> list[tuple[int, int]]:
        out = [(0, 0)]
        for t in turns:
            out.append(
                ((out[-1][0] * BASES[0] + t["x1"]) % PRIME, (out[-1][1] * BASES[1] + t["x2"]) % PRIME)
            )
        return out

    node = pa.struct([(n, pa.int64()) for n in ("depth", "k1", "k2", "q1", "q2", "words")])
    for batch in batches:
        out = []
        rows = zip(*_columns(batch, "conv_id", "n", "head", "first", "base"), strict=True)
        for conv, n, head, first, base in rows:
            by_rank = lambda t: t["rank"]
            graft = sorted(base or [], key=by_rank)[:head]
            taken, q = len(graft), digests(graft)
            own = digests(sorted(first, key=by_rank)[:head])[-1]
            d1, d2 = (q[-1][0] - own[0]) % PRIME, (q[-1][1] - own[1]) % PRIME
            heads = [
                dict(depth=i + 1, k1=q[i + 1][0], k2=q[i + 1][1], q1=q[i][0], q2=q[i][1], words=t["words"])
                for i, t in enumerate(graft)
            ]
            out.append((conv, min(head, n), taken, d1, d2, taken + max(n - head, 0), heads))
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        kinds = [*[pa.int64()] * 6, pa.list_(node)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["conv_id", "own", "taken", "d1", "d2", "depth", "heads"],
        )


_PREFIXES = "conv_id long, depth long, k1 long, k2 long, q1 long, q2 long, words long, last boolean"


def _own_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the rebuilt prefixes that end in a conversation's own turns."""
    schema = _fields(_PREFIXES)
    names = "conv_id rank p1 p2 x1 x2 words before o1 o2 own taken d1 d2 depth".split()
    for batch in batches:
        out = []
        for c, r, p1, p2, x1, x2, w, before, o1, o2, own, taken, d1, d2, depth in zip(
            *_columns(batch, *names), strict=True
        ):
            after = r + before - own
            k1 = (p1 + o1 * pow(BASES[0], r, PRIME) + d1 * pow(BASES[0], after, PRIME)) % PRIME
            k2 = (p2 + o2 * pow(BASES[1], r, PRIME) + d2 * pow(BASES[1], after, PRIME)) % PRIME
            q1 = (k1 - x1) * _INVERSE[0] % PRIME
            q2 = (k2 - x2) * _INVERSE[1] % PRIME
            out.append((c, taken + after, k1, k2, q1, q2, w, taken + after == depth))
        yield _batch(out, schema)


def rebuilt_prefixes(
    conversations: DataFrame, base: Column | None, head: Column | None, longest_head: int
) -> tuple[DataFrame, DataFrame]:
    """All prefixes of the rebuilt conversations (without the empty one), and their plans."""
    content = F.md5(
        F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    )
    half = lambda at: F.conv(F.substring(F.col("content"), at, 15), 16, 10).cast("long")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "x1", "x2"]
    turns = (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .select("conv_id", "turn", "role", content.alias("content"),
                F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
        .select("conv_id", "turn", "role", half(1).alias("x1"), half(17).alias("x2"), "words")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "x1", "x2", "words")
    )
    runs = stored(turns.mapInArrow(_run_digests, _RUNS), "trie-runs")
    # A conversation has a run in several tasks only where it crosses their borders.
    offsets = stored(
        runs.groupBy("conv_id", "part")
        .agg(F.max(F.struct("rank", "p1", "p2")).alias("end"))
        .groupBy("conv_id")
        .agg(
            F.collect_list(
                F.struct("part", F.col("end.rank").alias("n"), "end.p1", "end.p2")
            ).alias("runs")
        )
        .filter(F.size("runs") > 1)
        .mapInArrow(_run_offsets, _OFFSETS),
        "trie-offsets",
    )
    placed = runs.join(offsets, ["conv_id", "part"], "left").na.fill(0, ["before", "o1", "o2"])
    at = F.col("rank") + F.col("before")
    first = F.when(at <= longest_head, F.struct(at.alias("rank"), "x1", "x2", "words"))
    convs = stored(
        placed.groupBy("conv_id").agg(F.max(at).alias("n"), F.collect_list(first).alias("first")),
        "trie-conversations",
    )
    known = convs.select(
        "conv_id",
        "n",
        "first",
        (F.lit(0) if head is None else head).cast("long").alias("head"),
        (F.col("conv_id") if base is None else base).cast("long").alias("base_id"),
    )
    bases = convs.select(F.col("conv_id").alias("base_id"), F.col("first").alias("base"))
    plans = stored(
        known.join(bases, "base_id", "left").mapInArrow(_graft_plans, _PLANS), "trie-plans"
    )
    own = (
        placed.join(plans.drop("heads"), "conv_id")
        .filter(at > F.col("own"))
        .mapInArrow(_own_prefixes, _PREFIXES)
    )
    grafted = plans.select(
        "conv_id", F.col("depth").alias("last_depth"), F.explode("heads").alias("h")
    ).select("conv_id", "h.*", (F.col("h.depth") == F.col("last_depth")).alias("last"))
    return stored(own.unionByName(grafted), "trie-prefixes"), plans


# --- screening ------------------------------------------------------------------------------


def _digest_key(batch: pa.RecordBatch) -> np.ndarray:
    k1, k2, depth = (batch.column(n).to_numpy().astype(np.uint64) for n in ("k1", "k2", "depth"))
    return mixed(k1 ^ mixed(k2 ^ mixed(depth)))


def screened(prefixes: DataFrame) -> DataFrame:
    """Prefixes with ``possible`` (may be shared) and ``open`` (parent may be a shared node)."""
    spark = prefixes.sparkSession
    cells = cells_for(prefixes.count(), 8)

    def cells_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        touched = np.concatenate(two_cells(_digest_key(batch), cells))
        return touched, np.ones(len(touched), dtype=np.int64)

    digests = prefixes.select(*NODE)
    twice = spark.sparkContext.broadcast(
        tallied_bits(digests, cells_of, cells, lambda counts: counts > 1)
    )

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            possible = both_set(twice.value, _digest_key(batch))
            depth = batch.column("depth").to_numpy()
            _, conv = np.unique(batch.column("conv_id").to_numpy(), return_inverse=True)
            proven = np.full(len(depth), np.iinfo(np.int64).max)
            np.minimum.at(proven, conv[~possible], depth[~possible])
            possible &= depth < proven[conv]
            place = conv.astype(np.int64) << 40 | depth
            opened = ~possible & ~np.isin(place - 1, place[~possible])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(possible), pa.array(opened)],
                names=[*batch.schema.names, "possible", "open"],
            )

    # Which rows of a tail are proven depends on the batch they stand in: taken once, kept.
    return stored(
        prefixes.mapInArrow(screen, f"{_PREFIXES}, possible boolean, open boolean"), "trie-screened"
    )


# --- ends -----------------------------------------------------------------------------------


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _fields("depth long, k1 long, k2 long, first long, ids string")
    node, ids = None, []
    for batch in batches:
        out = []
        for *key, conv in zip(*_columns(batch, *NODE, "conv_id"), strict=True):
            if ids and (key != node or len(ids) == IDS_PER_CHUNK):
                out.append((*node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = key
            ids.append(conv)
        yield _batch(out, schema)
    if ids:
        yield _batch([(*node, ids[0], ",".join(map(str, ids)))], schema)


def _sha256_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _fields("depth long, k1 long, k2 long, ends_sha256 string")
    node, state = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*_columns(batch, *NODE, "ids"), strict=True):
            if key != node:
                if state:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _batch(out, schema)
    if state:
        yield _batch([(*node, state.hexdigest())], schema)


def _hash_of_ids(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each node; ids are joined in parts, a node's parts hashed in turn."""
    order = [*NODE, "conv_id"]
    parts = (
        ends.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_id_chunks, "depth long, k1 long, k2 long, first long, ids string")
    )
    return (
        parts.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .select(*NODE, "ids")
        .mapInArrow(_sha256_of_chunks, "depth long, k1 long, k2 long, ends_sha256 string")
    )


# --- the trie -------------------------------------------------------------------------------


def _on(left: list[str]) -> list[Column]:
    return [F.col(f"l.{a}") == F.col(f"r.{b}") for a, b in zip(left, NODE, strict=True)]


def prefix_trie(
    conversations: DataFrame,
    base: Column | None = None,
    head: Column | None = None,
    longest_head: int = 3,
) -> DataFrame:
    """One row per node: smallest member ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256`` and ``words`` of its last turn.

    With ``base`` and ``head`` (of ``conv_id``) a conversation is rebuilt first: the first
    ``head`` turns of ``base``, then its own after its first ``head``. No head is longer than
    ``longest_head``.
    """
    bounded_batches(conversations.sparkSession)
    prefixes, plans = rebuilt_prefixes(conversations, base, head, longest_head)
    rows = screened(prefixes)
    shared, tails = rows.filter("possible"), rows.filter("NOT possible")

    groups = stored(
        shared.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.min("q1").alias("q1"),
            F.min("q2").alias("q2"),
            F.min("words").alias("words"),
            F.count_if("last").alias("n_ends"),
            F.min(F.when(F.col("last"), F.col("conv_id"))).alias("one_end"),
        ),
        "trie-groups",
    )
    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")]
    children = stored(
        groups.select(*above)
        .unionAll(tails.filter("open").select(*above))
        .groupBy(*NODE)
        .agg(F.count(F.lit(1)).alias("n_children")),
        "trie-children",
    )
    nodes = stored(
        groups.join(children, NODE, "left").na.fill(0, ["n_children"]).withColumn(
            "saves", (F.col("n_convs") - 1) * F.col("words")
        ),
        "trie-nodes",
    )
    # What each conversation counts for, as the smallest member of nodes.
    counted = stored(
        tails.filter("last")
        .select("conv_id", F.lit(1).alias("leaf"), F.lit(0).cast("long").alias("saved"))
        .unionAll(
            nodes.filter((F.col("saves") > 0) | (F.col("n_children") == 0)).select(
                "conv_id", (F.col("n_children") == 0).cast("int"), "saves"
            )
        )
        .groupBy("conv_id")
        .agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")),
        "trie-counted",
    )
    below = stored(
        shared.select("conv_id", *NODE)
        .join(counted, "conv_id")
        .groupBy(*NODE)
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved")),
        "trie-below",
    )
    # The smallest member counts for nodes above this one too: taken off again.
    block = F.floor(F.col("depth") / DEPTH_BLOCK).alias("block")
    blocks = nodes.groupBy("conv_id", block).agg(F.sum("saves").alias("in_block"))
    passed = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = (
        Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    )
    taken_off = (
        nodes.select("*", block)
        .join(
            blocks.select("conv_id", "block", F.sum("in_block").over(passed).alias("blocks_above")),
            ["conv_id", "block"],
        )
        .withColumn(
            "above",
            F.coalesce(F.sum("saves").over(within), F.lit(0)) + F.coalesce("blocks_above", F.lit(0)),
        )
    )
    turnless = plans.filter(F.col("depth") == 0).select(
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("k1"),
        F.lit(0).cast("long").alias("k2"),
        "conv_id",
    )
    several = nodes.filter("n_ends > 1").select(*NODE)
    hashed = stored(
        _hash_of_ids(
            shared.filter("last").join(several, NODE, "left_semi").select(*NODE, "conv_id").unionAll(turnless)
        ),
        "trie-ends",
    )
    # The root: a few totals of all conversations.
    n_convs, root_conv = plans.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    leaves, saved = counted.agg(F.sum("leaves"), F.sum("saved")).first()
    at_root = (F.col("depth") == 0) & (F.col("k1") == 0) & (F.col("k2") == 0)
    root_children = children.filter(at_root).agg(F.sum("n_children")).first()[0] or 0
    root_ends = hashed.filter(at_root).agg(F.max("ends_sha256")).first()[0] or EMPTY_SHA256
    schema = (
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, words long"
    )
    root_row = (
        root_conv, 0, None, n_convs, root_children, leaves if root_children else 1,
        saved or 0, root_ends, 0,
    )
    root = conversations.sparkSession.createDataFrame([root_row] if n_convs else [], schema)
    parent = F.when(F.col("l.depth") == 1, F.lit(root_conv).cast("long")).otherwise(
        F.coalesce("r.parent", "l.conv_id")
    )
    own_end = F.when(F.col("n_ends") == 1, F.sha2(F.col("one_end").cast("string"), 256))
    parents = nodes.select(*NODE, F.col("conv_id").alias("parent"))
    grouped = (
        taken_off.withColumn("parent_depth", F.col("depth") - 1)
        .join(below, NODE, "left")
        .join(hashed, NODE, "left")
        .alias("l")
        .join(parents.alias("r"), _on(["parent_depth", "q1", "q2"]), "left")
        .select(
            "l.conv_id",
            "l.depth",
            parent.alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
            (F.coalesce("saved", F.lit(0)) - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", own_end, F.lit(EMPTY_SHA256)).alias("ends_sha256"),
            "words",
        )
    )
    tail_columns = lambda parent: [
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        (~F.col("last")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256))
        .otherwise(F.lit(EMPTY_SHA256))
        .alias("ends_sha256"),
        "words",
    ]
    closed = tails.filter("NOT open").select(*tail_columns(F.col("conv_id")))
    opened = (
        tails.filter("open")
        .withColumn("parent_depth", F.col("depth") - 1)
        .alias("l")
        .join(parents.alias("r"), _on(["parent_depth", "q1", "q2"]), "left")
        .select("l.*", parent.alias("parent"))
        .select(*tail_columns(F.col("parent")))
    )
    return root.unionByName(grouped).unionByName(closed).unionByName(opened)
