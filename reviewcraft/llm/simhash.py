"""SimHash near-duplicates over a byte-position inverted index (operator 1).

A text's fingerprint has 64 bits: one for each bit that is set in more than half of the
hashes of its shingles. Two fingerprints link if at most ``MAX_BITS`` bits differ. Those
bits lie in at most as many of the eight bytes, so linked fingerprints share at least
``8 - MAX_BITS`` bytes in place: the guaranteed number of matches.

The index has postings for the bytes at each position. A list of a single byte would hold
1/256 of all fingerprints, so lists are intersected three positions at a time: of any
four positions, at least one of the triples in ``TRIPLES`` is part, hence every pair with
four shared bytes meets in at least one list. In a list, shared positional bytes are
tallied, pairs under the guaranteed number are dropped, and the others are verified by
their differing bits. Lists give stars of linked fingerprints, never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, hot_key_cells, set_aside, stored, utf8
from reviewcraft.llm.components import components

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
MIN_SHARED_BYTES = 8 - MAX_BITS
#: More fingerprints than this in one posting list are dealt into several tasks.
LIST_ROWS = 4096


def position_triples() -> list[tuple[int, int, int]]:
    """Triples of the eight byte positions such that every four positions contain one.

    Positions are dealt into three classes (0-2, 3-5, 6-7). Triples within a class, and
    triples with two positions in a class and one in the next, suffice: four positions
    have three in one class, or two in a class and one in its successor, or two in a class
    and two in its predecessor, where the roles are swapped.
    """
    classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
    triples = [t for c in classes for t in combinations(c, 3)]
    for i, c in enumerate(classes):
        after = classes[(i + 1) % 3]
        triples += [tuple(sorted((*two, one))) for two in combinations(c, 2) for one in after]
    return triples


TRIPLES = position_triples()


def fingerprint(text: bytes) -> int:
    """Fingerprint of a text in UTF-8: ASCII letters lower-cased, ASCII white space splits."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=">u8")
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - SHINGLE_WORDS + 1
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (
                digest(joined[a:b], SEED)
                for a, b in zip(starts[:n].tolist(), ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
            ),
            dtype=np.uint64,
            count=n,
        ).astype(">u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter(
            (fingerprint(t.as_py()) for t in batch.column("_text")),
            dtype=np.uint64,
            count=batch.num_rows,
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(prints.view(np.int64))],
            names=["doc_id", "row", "print"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` (a number of the row) and ``print`` (64 bits as a signed long).

    Null text counts as empty.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        utf8().alias("_text"),
    )
    return rows.mapInArrow(_fingerprints, "doc_id long, row long, print long")


def _posting_key(triple_number: int, triple: tuple[int, int, int]) -> Column:
    key = F.lit(triple_number).cast("long")
    for position in triple:
        byte = F.shiftrightunsigned("print", 8 * (7 - position)).bitwiseAND(F.lit(255))
        key = key * 256 + byte
    return key


def _linked_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of linked fingerprints in each posting cell; rows come sorted by cell."""
    names, rest = ["key", "cell_a", "cell_b"], None
    for batch in batches:
        block = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*names, "side", "print")}
        if rest is not None:
            block = {c: np.concatenate((rest[c], block[c])) for c in block}
        new = np.zeros(len(block["key"]), dtype=bool)
        new[1:] = np.any([block[c][1:] != block[c][:-1] for c in names], axis=0)
        cuts = np.flatnonzero(new)
        last = int(cuts[-1]) if len(cuts) else 0
        yield from _stars_of(block, np.concatenate(([0], cuts)))
        rest = {c: block[c][last:] for c in block}
    if rest is not None and len(rest["key"]):
        yield from _stars_of(rest, np.array([0, len(rest["key"])]))


def _stars_of(block: dict[str, np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    found_a, found_b = [], []
    for at in np.flatnonzero(np.diff(cuts) > 1):
        lo, hi = int(cuts[at]), int(cuts[at + 1])
        prints, side = block["print"][lo:hi].view(np.uint64), block["side"][lo:hi]
        for a, b in stars(prints, side if block["cell_a"][lo] != block["cell_b"][lo] else None):
            found_a.append(a)
            found_b.append(b)
    if found_a:
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )


def stars(prints: np.ndarray, side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what links within one list, found from one fingerprint at a time.

    Fingerprints that have been reached leave the list, so a dense group of n costs about
    n comparisons for each step and gives n - 1 edges. With ``side``, only links between
    different sides count.
    """
    waiting = np.arange(len(prints))
    while len(waiting) > 1:
        frontier, waiting = [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            at = frontier.pop()
            differ = prints[waiting] ^ prints[at]
            shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            linked = (shared >= MIN_SHARED_BYTES) & (np.bitwise_count(differ) <= MAX_BITS)
            if side is not None:
                linked &= side[waiting] != side[at]
            if linked.any():
                hit = waiting[linked]
                waiting = waiting[~linked]
                frontier.extend(hit.tolist())
                yield np.full(len(hit), prints[at]), prints[hit]


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints that connect all that link."""
    postings = prints.select("print").distinct().select(
        "print", F.explode(F.array(*(_posting_key(i, t) for i, t in enumerate(TRIPLES)))).alias("key")
    )
    cells = hot_key_cells(postings, ["key"], "print", LIST_ROWS)
    order = ["key", "cell_a", "cell_b"]
    return (
        cells.repartition(*order)
        .sortWithinPartitions(*order)
        .select(*order, "side", "print")
        .mapInArrow(_linked_stars, "a long, b long")
    )


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """``prints`` with ``root``, the smallest fingerprint that links can reach."""
    nodes = stored(prints.select("print").distinct(), "fingerprint-nodes")
    roots = components(fingerprint_links(nodes))
    joined = prints.join(roots.withColumnRenamed("node", "print"), "print", "left")
    return stored(joined.withColumn("root", F.coalesce("root", "print")), "fingerprint-groups")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    ``component_id`` is the smallest ``doc_id`` that links can reach. Texts without words,
    null ones included, have fingerprint zero and link like others. Rows with a null or
    repeated ``doc_id`` are kept; null ids name a component only if it has no other. Equal
    fingerprints are one node, so copies cost no links. Other columns are ignored; an
    empty table gives no rows.
    """
    grouped = fingerprint_groups(stored(fingerprints(docs), "fingerprints"))
    # Stored, so that Spark can split the rows of a large group in the join.
    smallest = stored(
        grouped.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids"
    )
    return grouped.join(smallest, "root").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of its smallest id.

    Null ids come last, equal ids in the order of the stored rows. ``docs`` must be read
    from a table, so that its rows have the same numbers each time.
    """
    docs, given_back = set_aside(docs)
    grouped = fingerprint_groups(stored(fingerprints(docs), "fingerprints"))
    first = grouped.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    )
    kept = first.select(F.col("first.row").alias("_row"))
    return given_back(
        docs.withColumn("_row", F.monotonically_increasing_id())
        .join(kept, "_row", "left_semi")
        .drop("_row")
    )
