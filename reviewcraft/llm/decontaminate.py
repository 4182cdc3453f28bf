"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 6).

Texts and benchmark items are words (ASCII letters lower-cased; everything but letters,
digits and non-ASCII characters separates). An item of n words leaks into a document if some
stretch of the document is within ``edit_share`` * n word edits of it.

Item-sized windows of a document and the items are embedded by a random walk: at each of 3 n
steps the current word is written out, and a random bit of (step, word) decides whether the
walk moves on. Small edit distance becomes small Hamming distance, because walks join again
after an edit. Keys are words at sampled steps; several walks with several samples each
give the target recall. Windows and items that agree in a key are candidates; the exact
edit distance decides.

Only windows that hold a run of words of some item, unedited and in its place, are embedded:
with at most k edits at least one run of n // (k + 1) words is left whole, so no leak is lost.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, set_aside, utf8
from reviewcraft.llm.license_index import words_of

#: Items go to the tasks in blocks of at most so many bytes of text.
ITEM_BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class DecontaminationParams:
    edit_share: float = 0.2
    walks: int = 12
    samples_per_walk: int = 12
    words_per_key: int = 2
    seed: int = 5


def edits_allowed(n: int, params: DecontaminationParams) -> int:
    return int(params.edit_share * n + 1e-9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def embedded(windows: np.ndarray, sizes: np.ndarray, walk: int, seed: int) -> np.ndarray:
    """One random walk over each row: ``windows`` has word numbers, padded after ``sizes``.

    Row i is embedded in its first 3 * sizes[i] columns; a finished walk writes -1.
    """
    rows, steps = np.arange(len(windows)), 3 * int(sizes.max(initial=0))
    out = np.full((len(windows), steps), -1, dtype=np.int64)
    at = np.zeros(len(windows), dtype=np.int64)
    for step in range(steps):
        inside = at < sizes
        word = np.where(inside, windows[rows, np.minimum(at, windows.shape[1] - 1)], -1)
        out[:, step] = word
        salt = np.uint64((seed * 1_000_003 + walk * 8191 + step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        bit = _mixed(word.view(np.uint64) + salt) & np.uint64(1)
        at += inside & (bit == 1)
    return out


class ItemIndex:
    """Items of one block: words, whole runs, and the LSH tables of their embeddings."""

    def __init__(self, items: list[tuple[int | None, bytes]], params: DecontaminationParams):
        self.params = params
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.words: list[np.ndarray] = []
        for item_id, text in items:
            words = words_of(text)
            if words:
                self.ids.append(item_id)
                self.words.append(
                    np.array(
                        [self.vocabulary.setdefault(w, 1 + len(self.vocabulary)) for w in words],
                        dtype=np.int64,
                    )
                )
        # Whole runs: the key of a run -> (length of the item, place in it).
        self.runs: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(dict)
        for words in self.words:
            n = len(words)
            q = max(1, n // (edits_allowed(n, params) + 1))
            for place, key in enumerate(_run_keys(words, q).tolist()):
                places = self.runs[q].setdefault(key, [])
                if (n, place) not in places:
                    places.append((n, place))
        self.run_keys = {q: np.array(sorted(table), np.uint64) for q, table in self.runs.items()}
        self.tables: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        for item, keys in enumerate(self._keys(self.words)):
            for key in keys:
                self.tables[key].append(item)

    def _keys(self, windows: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """LSH keys of windows: (table, size, hash of the sampled words)."""
        if not windows:
            return []
        sizes = np.array([len(w) for w in windows])
        padded = np.full((len(windows), int(sizes.max())), -1, dtype=np.int64)
        for i, w in enumerate(windows):
            padded[i, : len(w)] = w
        rng, p, rows = np.random.default_rng(self.params.seed), self.params, np.arange(len(windows))
        keys: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        for walk in range(p.walks):
            out = embedded(padded, sizes, walk, p.seed)
            for sample in range(p.samples_per_walk):
                key = np.zeros(len(windows), dtype=np.uint64)
                for fraction in rng.random(p.words_per_key):
                    # Walks advance half a word a step; later steps are past the end.
                    step = (fraction * 2 * sizes).astype(np.int64)
                    key = _mixed(key * np.uint64(31) + out[rows, step].view(np.uint64))
                table = walk * p.samples_per_walk + sample
                for i, (n, k) in enumerate(zip(sizes.tolist(), key.tolist(), strict=True)):
                    keys[i].append((table, n, k))
        return keys

    def windows(self, words: np.ndarray) -> set[tuple[int, int]]:
        """Start and size of the windows that hold a whole run of an item in its place."""
        found: set[tuple[int, int]] = set()
        for q, table in self.runs.items():
            if len(words) < q:
                continue
            known = np.convolve(words > 0, np.ones(q, dtype=np.int64), "valid") == q
            at = np.flatnonzero(known)
            if not len(at):
                continue
            keys = _run_keys(words, q)[at]
            sorted_keys = self.run_keys[q]
            place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
            for i in np.flatnonzero(sorted_keys[place] == keys).tolist():
                for n, offset in table[int(keys[i])]:
                    found.add((int(at[i]) - offset, n))
        return found

    def leaks(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """Text number, item, distance, first and past-the-end word of its best stretch."""
        get = self.vocabulary.get
        numbered, places = {}, []
        for t, text in enumerate(texts):
            split = words_of(text)
            words = np.fromiter((get(w, 0) for w in split), dtype=np.int64, count=len(split))
            wanted = self.windows(words)
            if wanted:
                numbered[t] = words
                places += [(t, start, n) for start, n in wanted]
        cut = []
        for t, start, n in places:
            words = numbered[t]
            window = np.full(n, -1, dtype=np.int64)
            a, b = max(0, start), min(len(words), start + n)
            window[a - start : b - start] = words[a:b]
            cut.append(window)
        candidates: set[tuple[int, int, int]] = set()
        for (t, start, _), keys in zip(places, self._keys(cut), strict=True):
            for key in keys:
                for item in self.tables.get(key, ()):
                    candidates.add((t, item, start))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for t, item, start in sorted(candidates):
            n = len(self.words[item])
            k = edits_allowed(n, self.params)
            a, b = max(0, start - k), min(len(numbered[t]), start + n + k)
            distance, first, end = best_stretch(self.words[item].tolist(), numbered[t][a:b].tolist())
            found = (distance, a + first, a + end)
            if distance <= k and ((t, item) not in best or found < best[t, item]):
                best[t, item] = found
        for (t, item), (distance, first, end) in sorted(best.items()):
            yield t, item, distance, first, end


def _run_keys(words: np.ndarray, q: int) -> np.ndarray:
    n = max(0, len(words) - q + 1)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(q):
        key = _mixed(key * np.uint64(31) + words[i : i + n].view(np.uint64))
    return key


def best_stretch(item: list[int], region: list[int]) -> tuple[int, int, int]:
    """Least word edit distance of ``item`` to any stretch of ``region``, and that stretch.

    Word number 0 stands for words that no item has, so it equals no word of an item.
    """
    row = [(0, i) for i in range(len(region) + 1)]
    for word in item:
        diagonal, row[0] = row[0], (row[0][0] + 1, row[0][1])
        for i, other in enumerate(region, 1):
            above = row[i]
            cost = min(
                (diagonal[0] + (word != other), diagonal[1]),
                (above[0] + 1, above[1]),
                (row[i - 1][0] + 1, row[i - 1][1]),
            )
            diagonal, row[i] = above, cost
    end = min(range(len(row)), key=lambda i: (row[i][0], row[i][1], i))
    return row[end][0], row[end][1], end


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items, a block of bounded size at a time."""
    block, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), utf8().alias("_text"))
    for row in items.orderBy("item_id", "_text").toLocalIterator():
        block.append((row["item_id"], bytes(row["_text"])))
        size += len(row["_text"])
        if size >= ITEM_BLOCK_BYTES:
            yield block
            block, size = [], 0
    yield block


LEAKS = (
    "_row long, doc_id long, item_id long, n_item_words int, distance int, "
    "similarity double, first_word long, end_word long"
)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams | None = None
) -> DataFrame:
    """One row for each document row and item that it contains, with the best stretch.

    Columns: ``_row`` (number of the document's row), doc_id, item_id, n_item_words,
    distance, similarity (1 - distance / words), first_word, end_word. Null or empty texts
    and items without words leak nothing; repeated documents or items each give rows; with
    either table empty there are none. Other columns are ignored.
    """
    params = params or DecontaminationParams()
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8().alias("_text"),
    )
    found = None
    for block in _item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(ItemIndex(block, params))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                numbers, ids = batch.column("_row").to_pylist(), batch.column("doc_id").to_pylist()
                out = []
                for t, item, distance, first, end in index.leaks(batch.column("_text").to_pylist()):
                    n = len(index.words[item])
                    out.append(
                        (numbers[t], ids[t], index.ids[item], n, distance, 1 - distance / n, first, end)
                    )
                kinds = (
                    *(pa.int64(), pa.int64(), pa.int64(), pa.int32()),
                    *(pa.int32(), pa.float64(), pa.int64(), pa.int64()),
                )
                columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[c.split()[0] for c in LEAKS.split(", ")],
                )

        part = rows.mapInArrow(run, LEAKS)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams | None = None
) -> DataFrame:
    """``docs`` without the rows that contain an item; ``docs`` must be read from a table."""
    docs, given_back = set_aside(docs)
    leaking = find_leaks(docs, benchmark, params).select("_row").distinct()
    return given_back(
        docs.withColumn("_row", F.monotonically_increasing_id())
        .join(leaking, "_row", "left_anti")
        .drop("_row")
    )
