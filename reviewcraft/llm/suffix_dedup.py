"""Removal of repeated byte strings with suffix arrays (operator 9).

Every byte that is covered by a string of a given length (400 bytes if not told otherwise)
which also starts anywhere else is removed. A string of that length is called a window here.
The work is dealt like this:

1. Each window has an *anchor*: the position, among its first ``spread`` ones, whose 16
   bytes have the smallest hash. Equal windows have their anchors at the same distance from
   their starts. The windows of one anchor share a *core* of bytes after it. Anchors whose
   core occurs once are dropped; those with equal bytes over all their windows repeat as a
   whole; the others go on.
2. These are cut by distance into blocks of ``block`` windows, which share a longer core and
   differ only in fewer than ``block`` bytes on either side. Again unique cores drop out and
   equal ones are done.
3. What is left has an equal core and different sides. The right sides and the reversed
   left sides of a task are put in order by suffix arrays (see ``gsaca``). Common prefixes
   of neighbours give the extension that any two members share, and so the windows of each
   member that repeat.

Equality that is not compared byte by byte rests on 128 bits of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft.llm.common import bounded_batches, hot_key_cells, set_aside, stored, utf8
from reviewcraft.llm.gsaca import suffix_array

LENGTH = 400
GRAM = 16


@dataclass(frozen=True)
class Windows:
    """Length of the strings that must not repeat, and how they are searched."""

    length: int = LENGTH

    def __post_init__(self):
        if self.length < 4 * GRAM:
            raise ValueError(f"windows need {4 * GRAM} bytes at least")

    @property
    def spread(self) -> int:
        return self.length * 3 // 5

    @property
    def block(self) -> int:
        return self.length * 3 // 40


DEFAULT = Windows()
SPREAD, BLOCK = DEFAULT.spread, DEFAULT.block
CELL_MEMBERS = 2048
#: Symbols of one suffix array; whole buckets are added until it is reached.
ARRAY_SYMBOLS = 1 << 17
_CHUNK = 1 << 20


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position."""
    n = len(data) - GRAM + 1
    words = np.zeros(len(data) - 7, dtype=np.uint64)
    for i in range(8):
        words |= data[i : i + len(words)].astype(np.uint64) << np.uint64(8 * i)
    mixed = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += words[8 : 8 + n]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def anchors(text: bytes, windows: Windows = DEFAULT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions with the first and last start of the windows of each."""
    n_windows, spread = len(text) - windows.length + 1, windows.spread
    if n_windows <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    data = np.frombuffer(text, dtype=np.uint8)
    parts = []
    for begin in range(0, n_windows, _CHUNK):
        starts = min(_CHUNK, n_windows - begin)
        grams = starts + spread - 1
        hashes = _gram_hashes(data[begin : begin + grams + GRAM - 1])
        # Ties go to the rightmost position, so equal windows choose alike.
        mask = np.uint64((1 << 21) - 1)
        keys = (hashes & ~mask) | (mask - np.arange(grams, dtype=np.uint64))
        pad = -grams % spread
        rows = np.concatenate((keys, np.full(pad, ~np.uint64(0)))).reshape(-1, spread)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[spread - 1 : spread - 1 + starts])
        parts.append((mask - (least & mask)).astype(np.int64) + begin)
    chosen = np.concatenate(parts)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:] - 1, [n_windows - 1]))
    return chosen[first], first, last


ANCHORS = "row long, key long, at long, first long, last long, whole long"
BLOCKS = "row long, key binary, at long, block int, lo int, hi int, left binary, right binary"


def _anchor_rows(windows: Windows):
    length, spread = windows.length, windows.spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "key", "at", "first", "last", "whole"]
        digest = xxhash.xxh3_64_intdigest
        core = length - spread + 1
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("_text"), strict=True):
                data = text.as_py()
                at, first, last = anchors(data, windows)
                if not len(at):
                    continue
                keys, wholes = [], []
                for p, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                    keys.append(digest(data[p : p + core]))
                    wholes.append(digest(data[a : b + length], p - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), row), pa.int64()),
                        pa.array(np.array(keys, dtype=np.uint64).view(np.int64)),
                        pa.array(at),
                        pa.array(first),
                        pa.array(last),
                        pa.array(np.array(wholes, dtype=np.uint64).view(np.int64)),
                    ],
                    names=names,
                )

    return run


def _block_rows(windows: Windows):
    length, block_size = windows.length, windows.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "key", "at", "block", "lo", "hi", "left", "right"]
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for row, text, found in zip(
                batch.column("row").to_pylist(),
                batch.column("_text"),
                batch.column("anchors").to_pylist(),
                strict=True,
            ):
                data, rows = text.as_py(), []
                for anchor in found:
                    p = anchor["at"]
                    least, most = p - anchor["last"], p - anchor["first"]
                    for block in range(least // block_size, most // block_size + 1):
                        near = block_size * block
                        lo, hi = max(least - near, 0), min(most - near, block_size - 1)
                        a, b = p - near, p - near + length - block_size + 1
                        rows.append(
                            (
                                row,
                                digest(data[a:b], near),
                                p,
                                block,
                                lo,
                                hi,
                                data[a - hi : a],
                                data[b : a - lo + length],
                            )
                        )
                kinds = (
                    *(pa.int64(), pa.binary(), pa.int64()),
                    *(pa.int32(), pa.int32(), pa.int32()),
                    *(pa.binary(), pa.binary()),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=names,
                )

    return run


# --- one bucket: members with an equal core -------------------------------------------------


def _order_and_common(sides: list[bytes], buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank order of the members by side within each bucket, and what neighbours share.

    One suffix array over all sides, each closed by an end symbol, orders them.
    """
    symbols: list[int] = []
    starts = []
    for side in sides:
        starts.append(len(symbols))
        symbols.extend(b + 2 for b in side)
        symbols.append(1)
    rank = np.empty(len(symbols), dtype=np.int64)
    rank[suffix_array(symbols)] = np.arange(len(symbols))
    order = np.lexsort((rank[starts], buckets))
    common = np.zeros(len(order), dtype=np.int64)
    ordered = order.tolist()
    for i, (x, y) in enumerate(zip(ordered[:-1], ordered[1:], strict=True)):
        a, b = sides[x], sides[y]
        n = min(len(a), len(b))
        if a[:n] != b[:n]:
            n = next(k for k in range(n) if a[k] != b[k])
        common[i + 1] = n
    return order, common


def _shared(position: int, common: np.ndarray) -> np.ndarray:
    """Common prefix of the member at ``position`` with each member, in their order."""
    out = np.full(len(common), np.iinfo(np.int64).max)
    if position:
        out[:position] = np.minimum.accumulate(common[1 : position + 1][::-1])[::-1]
    out[position + 1 :] = np.minimum.accumulate(common[position + 1 :])
    return out


def repeated_ranges(
    lefts: list[bytes],
    rights: list[bytes],
    buckets: np.ndarray,
    side: np.ndarray,
    split: np.ndarray,
    block: int = BLOCK,
) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset at which each member's window repeats in its bucket (-1: none).

    A member's window at offset x has x bytes left of the core and ``block`` - 1 - x right
    of it. With a member that shares l bytes on the left and r on the right, the windows
    at ``block`` - 1 - r to l are equal. Where ``split`` is set, only members of different
    sides are compared.
    """
    n = len(lefts)
    low, high = np.full(n, block), np.full(n, -1)
    order_r, common_r = _order_and_common(rights, buckets)
    order_l, common_l = _order_and_common([x[::-1] for x in lefts], buckets)
    ordered = buckets[order_r]
    cuts = [0, *(np.flatnonzero(ordered[1:] != ordered[:-1]) + 1).tolist(), n]
    place_l = np.empty(n, dtype=np.int64)
    place_l[order_l] = np.arange(n)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a < 2:
            continue
        members = order_r[a:b]
        here_r, here_l = common_r[a:b], common_l[a:b]
        to_l = place_l[members] - a
        for i in range(b - a):
            member = members[i]
            right = _shared(i, here_r)
            left = _shared(int(to_l[i]), here_l)[to_l]
            fits = left + np.minimum(right, block) >= block - 1
            fits[i] = False
            if split[member]:
                fits &= side[members] != side[member]
            if fits.any():
                low[member] = max(0, block - 1 - int(right[fits].max()))
                high[member] = int(left[fits].max())
    high[low > block - 1] = -1
    return low, high


def _range_rows(windows: Windows):
    """Repeated windows of the classes of each cell; rows come sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "cell_a", "cell_b"]

        def solve(rows: list[tuple]) -> pa.RecordBatch | None:
            ids: dict[tuple, int] = {}
            buckets = np.array([ids.setdefault(r[:3], len(ids)) for r in rows])
            low, high = repeated_ranges(
                [r[4] for r in rows],
                [r[5] for r in rows],
                buckets,
                np.array([r[3] for r in rows]),
                np.array([r[1] != r[2] for r in rows]),
                windows.block,
            )
            out = []
            for r, a, b in zip(rows, low.tolist(), high.tolist(), strict=True):
                lo, hi, class_id = r[6], r[7], r[8]
                a, b = max(a, lo), min(b, hi)
                if a <= b:
                    out.append((r[0], class_id, a, b))
            if not out:
                return None
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["key", "class_id", "low", "high"],
            )

        waiting: list[tuple] = []
        bucket: list[tuple] = []
        symbols = 0
        for batch in batches:
            columns = [
                batch.column(c).to_pylist()
                for c in (*names, "side", "left", "right", "lo", "hi", "class_id")
            ]
            for row in zip(*columns, strict=True):
                if bucket and bucket[0][:3] != row[:3]:
                    if len(bucket) > 1:
                        waiting += bucket
                        symbols += sum(2 + len(r[4]) + len(r[5]) for r in bucket)
                    bucket = []
                    if symbols >= ARRAY_SYMBOLS:
                        found = solve(waiting)
                        if found is not None:
                            yield found
                        waiting, symbols = [], 0
                bucket.append(row)
        if len(bucket) > 1:
            waiting += bucket
        if waiting:
            found = solve(waiting)
            if found is not None:
                yield found

    return run


# --- Spark ------------------------------------------------------------------------------------


def repeated_spans(texts: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """``row``, ``from``, ``to``: runs of bytes of distinct ``texts`` (``row``, ``_text``).

    Runs may overlap; together they are the bytes of all windows that start elsewhere too.
    """
    found = stored(texts.mapInArrow(_anchor_rows(windows), ANCHORS), "anchors")
    # Sums are stored before they are joined back: only then can Spark split the rows of
    # a hot key in the join.
    cores = stored(
        found.groupBy("key", "whole")
        .agg(F.count(F.lit(1)).alias("same"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("kinds"), F.sum("same").alias("n"))
        .filter(F.col("n") > 1)
        .select("key", "kinds"),
        "repeated-cores",
    )
    repeated = stored(found.join(cores, "key").drop("whole"), "repeated-anchors")
    equal = repeated.filter(F.col("kinds") == 1).select(
        "row", F.col("first").alias("from"), (F.col("last") + windows.length).alias("to")
    )
    mixed = (
        repeated.filter(F.col("kinds") > 1)
        .groupBy("row")
        .agg(F.collect_list(F.struct("at", "first", "last")).alias("anchors"))
    )
    blocks = stored(
        texts.join(mixed, "row")
        .select("row", "_text", "anchors")
        .mapInArrow(_block_rows(windows), BLOCKS)
        .withColumn("class_id", F.xxhash64("key", "lo", "hi", "left", "right")),
        "window-blocks",
    )
    classes = blocks.groupBy("key", "class_id").agg(
        F.first("lo").alias("lo"),
        F.first("hi").alias("hi"),
        F.first("left").alias("left"),
        F.first("right").alias("right"),
        F.count(F.lit(1)).alias("same"),
    )
    classes = stored(classes, "window-classes")
    copied = classes.filter(F.col("same") > 1).select(
        "key", "class_id", F.col("lo").alias("low"), F.col("hi").alias("high")
    )
    several = stored(
        classes.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "mixed-cores"
    )
    cells = hot_key_cells(
        classes.join(several.select("key"), "key", "left_semi").drop("same"),
        ["key"],
        "class_id",
        CELL_MEMBERS,
    )
    order = ["key", "cell_a", "cell_b"]
    extended = (
        cells.repartition(*order)
        .sortWithinPartitions(*order)
        .select(*order, "side", "left", "right", "lo", "hi", "class_id")
        .mapInArrow(_range_rows(windows), "key binary, class_id long, low int, high int")
    )
    ranges = stored(
        copied.unionByName(extended)
        .groupBy("key", "class_id")
        .agg(F.min("low").alias("low"), F.max("high").alias("high")),
        "repeated-ranges",
    )
    start = F.col("at") - F.lit(windows.block) * F.col("block")
    partly = blocks.select("row", "key", "class_id", "at", "block").join(
        ranges, ["key", "class_id"]
    ).select(
        "row",
        (start - F.col("high")).alias("from"),
        (start - F.col("low") + windows.length).alias("to"),
    )
    return equal.unionByName(partly)


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for a, b in sorted((s["from"], s["to"]) for s in spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def remove_repeats(
    docs: DataFrame, as_text: bool = False, windows: Windows = DEFAULT
) -> DataFrame:
    """``docs`` with ``kept``, ``n_bytes``, ``n_removed`` and ``removed_spans``.

    ``kept`` has the remaining bytes, or with ``as_text`` their text, without the bytes of
    characters that were cut in two. ``removed_spans`` has the maximal removed runs
    (``from``, ``to``) in bytes. Null texts count as empty; texts shorter than a window lose
    nothing. Repeated rows are copies of each other, whatever their ids. Columns of these
    names are replaced, others passed on. ``docs`` must be read from a table, so that its
    rows have the same numbers each time.
    """
    bounded_batches(docs.sparkSession)
    new = ["kept", "n_bytes", "n_removed", "removed_spans"]
    docs, given_back = set_aside(docs.drop(*new))
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    spans = repeated_spans(numbered.select(F.col("_row").alias("row"), utf8().alias("_text")), windows)
    marked = spans.groupBy(F.col("row").alias("_row")).agg(
        F.collect_set(F.struct("from", "to")).alias("_spans")
    )
    rows = numbered.join(marked, "_row", "left").select(
        *(F.col(f"`{c}`") for c in docs.columns), utf8().alias("_utf8_text"), "_spans"
    )
    n_kept = len(docs.columns)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
        for batch in batches:
            kept, sizes, removed, runs = [], [], [], []
            for text, found in zip(
                batch.column(n_kept), batch.column(n_kept + 1).to_pylist(), strict=True
            ):
                data = text.as_py()
                merged = _merged(found or [])
                cuts = [0, *(x for pair in merged for x in pair), len(data)]
                rest = b"".join(
                    data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)
                )
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                runs.append([{"from": a, "to": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:n_kept],
                    pa.array(kept, pa.string() if as_text else pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.list_(span)),
                ],
                names=[*names, *new],
            )

    schema = T.StructType(docs.schema.fields)
    schema.add("kept", T.StringType() if as_text else T.BinaryType())
    schema.add("n_bytes", T.LongType()).add("n_removed", T.LongType())
    ends = T.StructType().add("from", T.LongType()).add("to", T.LongType())
    return given_back(rows.mapInArrow(run, schema.add("removed_spans", T.ArrayType(ends))))


def without_repeats(docs: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """``docs`` with what is kept as ``text``; null texts stay null.

    ``n_chars``, where it exists, counts the new text.
    """
    cut = remove_repeats(docs, as_text=True, windows=windows)
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(
            F.col("n_removed") > 0, F.length("kept").cast(kind)
        ).otherwise(F.col("n_chars"))
    return cut.withColumns(changed).select(*(F.col(f"`{c}`") for c in docs.columns))
