"""Counts over a bounded number of hashed cells, taken by tasks and kept as bits.

A count-min sketch, a Bloom filter and a table of hashed term frequencies are all of this
kind. Tasks send only the cells they touched, cut into chunks; a chunk is added up in one
array of fixed size. What remains is one bit a cell, at most ``MAX_CELLS`` / 8 bytes, which
is the bound of what the driver gets and broadcasts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 16
MIN_CELLS = 1 << 16
MAX_CELLS = 1 << 30
#: Cells that a task holds before it sends them.
_WAITING = 1 << 22
_SCHEMA = "chunk int, offsets binary, counts binary"

#: One batch -> cells (int64) and what each adds (int64).
CellsOf = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def cells_for(keys: int, per_key: int) -> int:
    """A power of two with ``per_key`` cells for each key, within the fixed bounds."""
    wanted = max(keys, 1) * per_key
    return min(max(1 << (wanted - 1).bit_length(), MIN_CELLS), MAX_CELLS)


def mixed(key: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finalizer: every bit of ``key`` decides every bit of the result."""
    z = key.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def two_cells(key: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """A cell in each half of the table for every key."""
    half = np.uint64(cells // 2 - 1)
    first = (mixed(key, 1) & half).astype(np.int64)
    second = (mixed(key, 2) & half).astype(np.int64) + cells // 2
    return first, second


def is_set(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def both_set(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether both cells of each key are set: false proves that the key was left out."""
    first, second = two_cells(key, 8 * len(bits))
    return is_set(bits, first) & is_set(bits, second)


def tallied_bits(
    df: DataFrame, cells_of: CellsOf, cells: int, keep: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """One bit for each cell: whether ``keep`` holds for its count over all rows of ``df``."""

    def send(found: list, weights: list) -> pa.RecordBatch:
        touched, at = np.unique(np.concatenate(found), return_inverse=True)
        counts = np.zeros(len(touched), dtype=np.int64)
        np.add.at(counts, at, np.concatenate(weights))
        chunks = touched // CHUNK
        cuts = np.flatnonzero(np.diff(chunks, prepend=-1))
        ends = [*cuts[1:].tolist(), len(touched)]
        offsets = (touched % CHUNK).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunks[cuts].astype(np.int32)),
                pa.array([offsets[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            ],
            names=["chunk", "offsets", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, weights, waiting = [], [], 0
        for batch in batches:
            touched, added = cells_of(batch)
            found.append(touched)
            weights.append(added)
            waiting += len(touched)
            if waiting >= _WAITING:
                yield send(found, weights)
                found, weights, waiting = [], [], 0
        if waiting:
            yield send(found, weights)

    def packed(chunk: int, total: np.ndarray) -> pa.RecordBatch:
        bits = np.packbits(keep(total), bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), pa.array([bits], pa.binary())],
            names=["chunk", "bits"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = -1, np.zeros(CHUNK, dtype=np.int64)
        for batch in batches:
            for chunk, offsets, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
                if chunk.as_py() != current:
                    if current >= 0:
                        yield packed(current, total)
                    current = chunk.as_py()
                    total[:] = 0
                at = np.frombuffer(offsets.as_buffer(), dtype="<u2")
                total[at] += np.frombuffer(counts.as_buffer(), dtype=np.int64)
        if current >= 0:
            yield packed(current, total)

    sent = df.mapInArrow(count, _SCHEMA)
    summed = sent.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
        add, "chunk int, bits binary"
    )
    bits = np.zeros(cells // 8, dtype=np.uint8)
    for row in summed.toLocalIterator():
        at = row["chunk"] * (CHUNK // 8)
        bits[at : at + CHUNK // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


#: Filters of no more keys than this are put together by the driver: a few megabytes.
_DRIVER_KEYS = 1 << 19


def key_filter(df: DataFrame, key_of: Callable[[pa.RecordBatch], np.ndarray], keys: int) -> np.ndarray:
    """A Bloom filter over the ``keys`` keys of all rows, for ``both_set``."""
    cells = cells_for(keys, 16)
    if keys <= _DRIVER_KEYS:
        return _small_filter(df, key_of, cells)

    def cells_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        touched = np.concatenate(two_cells(key_of(batch), cells))
        return touched, np.ones(len(touched), dtype=np.int64)

    return tallied_bits(df, cells_of, cells, lambda counts: counts > 0)


def _small_filter(
    df: DataFrame, key_of: Callable[[pa.RecordBatch], np.ndarray], cells: int
) -> np.ndarray:
    """The same bits without a shuffle: the cells of each batch, set one batch after another."""

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            touched = np.concatenate(two_cells(key_of(batch), cells)).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([touched.tobytes()], pa.binary())], names=["cells"]
            )

    marked = np.zeros(cells, dtype=bool)
    for row in df.mapInArrow(touch, "cells binary").toLocalIterator():
        marked[np.frombuffer(row["cells"], dtype="<i4")] = True
    return np.packbits(marked, bitorder="little")
