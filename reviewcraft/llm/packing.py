"""Best-fit packing by a grouping genetic algorithm on islands (operator 10).

Texts become token ids, each closed by an end id. A document longer than a sequence is cut
into pieces, all full but perhaps the first. Full pieces are sequences of their own; the
others are dealt into blocks of bounded size. Each block is solved by several islands. An
island keeps a population of packings; crossover injects whole well-filled bins of one
parent into the other, drops the bins that hold the same pieces, and best-fits the displaced
pieces. An epoch lasts until its search stops improving. Between epochs each island's elite
moves to the next island of its block. The emptiest bins of every block, with half of its
pieces at most, go into common new blocks, round after round until one block holds them all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, stored, tasks_for, utf8
from reviewcraft.llm.word_memo import text_slices, word_memo

PIECES = "uid long, doc_id long, piece int, start long, length int, ids_crc32 long"


@dataclass(frozen=True)
class PackingParams:
    capacity: int = 2048
    block_pieces: int = 4096
    islands: int = 2
    population: int = 4
    epochs: int = 2
    #: An epoch ends after so many generations without a better packing, or at the bound of
    #: the sum of lengths, or after ``generations``.
    patience: int = 4
    generations: int = 400
    #: Bins with at most so many free tokens count as well filled.
    slack: int = 8
    seed: int = 7


# --- one island: plain bin packing on the lengths of a block -------------------------------


class _Gaps:
    """Open bins by free space; the smallest sufficient space is found with one bit mask."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, 0
        self.bins: list[list[list[int]]] = [[] for _ in range(capacity + 1)]

    def put(self, members: list[int], gap: int) -> None:
        self.bins[gap].append(members)
        self.mask |= 1 << gap

    def best_fit(self, item: int, size: int) -> None:
        higher = self.mask >> size
        if higher:
            gap = size + (higher & -higher).bit_length() - 1
            stack = self.bins[gap]
            members = stack.pop()
            if not stack:
                self.mask &= ~(1 << gap)
            members.append(item)
            self.put(members, gap - size)
        else:
            self.put([item], self.capacity - size)

    def all(self) -> list[list[int]]:
        return [members for stack in self.bins for members in stack]


def best_fit_decreasing(
    lengths: list[int], items: list[int], kept: list[list[int]], capacity: int
) -> list[list[int]]:
    """Put ``items``, longest first, into the fullest bins that have room for them."""
    gaps = _Gaps(capacity)
    for members in kept:
        gaps.put(list(members), capacity - sum(lengths[i] for i in members))
    for item in sorted(items, key=lambda i: -lengths[i]):
        gaps.best_fit(item, lengths[item])
    return gaps.all()


def fitness(lengths: list[int], bins: list[list[int]], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones: the mean square of the fill."""
    fill = np.array([sum(lengths[i] for i in b) for b in bins], dtype=np.float64) / capacity
    return -len(bins), float((fill * fill).mean()) if len(bins) else 0.0


def crossover(
    lengths: list[int],
    receiver: list[list[int]],
    donor: list[list[int]],
    capacity: int,
    rng: np.random.Generator,
) -> list[list[int]]:
    """Inject whole well-filled bins of ``donor`` into ``receiver``."""
    full = sorted(donor, key=lambda b: -sum(lengths[i] for i in b))
    full = full[: max(1, len(full) // 2)]
    chosen = [b for b, take in zip(full, rng.random(len(full)) < 0.5, strict=True) if take]
    if not chosen:
        return receiver
    injected = {i for b in chosen for i in b}
    kept, displaced = [], []
    for members in receiver:
        if injected.isdisjoint(members):
            kept.append(members)
        else:
            displaced.extend(i for i in members if i not in injected)
    return best_fit_decreasing(lengths, displaced, kept + chosen, capacity)


def mutate(
    lengths: list[int], bins: list[list[int]], capacity: int, rng: np.random.Generator
) -> list[list[int]]:
    """Dissolve the emptiest bins and a few others, and best-fit their pieces."""
    order = sorted(bins, key=lambda b: sum(lengths[i] for i in b))
    n = min(len(order), 3 + int(rng.integers(0, 1 + len(order) // 20)))
    gone = order[:2] + [order[2 + int(k)] for k in rng.permutation(max(0, len(order) - 2))[: n - 2]]
    ids = {id(b) for b in gone}
    kept = [b for b in bins if id(b) not in ids]
    return best_fit_decreasing(lengths, [i for b in gone for i in b], kept, capacity)


def _as_bins(numbers: np.ndarray) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for item, number in enumerate(numbers.tolist()):
        bins.setdefault(number, []).append(item)
    return list(bins.values())


def _as_numbers(bins: list[list[int]], n: int) -> np.ndarray:
    numbers = np.empty(n, dtype=np.int32)
    for number, members in enumerate(bins):
        numbers[members] = number
    return numbers


def evolve(
    lengths: list[int], elites: list[np.ndarray], seed: int, params: PackingParams
) -> np.ndarray:
    """One epoch of one island: bin number of each piece in its best packing."""
    rng, cap = np.random.default_rng(seed), params.capacity
    least = -(-sum(lengths) // cap)
    everything = list(range(len(lengths)))
    population = [_as_bins(e) for e in elites]
    if not population:
        population.append(best_fit_decreasing(lengths, everything, [], cap))
    while len(population) < params.population:
        shaken = rng.permutation(len(lengths)).tolist()
        early = shaken[: len(shaken) // 4]
        late = set(everything).difference(early)
        begun = best_fit_decreasing(lengths, early, [], cap)
        population.append(best_fit_decreasing(lengths, list(late), begun, cap))
    population.sort(key=lambda p: fitness(lengths, p, cap), reverse=True)
    best, waited = fitness(lengths, population[0], cap), 0
    for _ in range(params.generations):
        if len(population[0]) <= least or waited >= params.patience:
            break
        a, b = rng.choice(len(population), 2, replace=False)
        better, worse = sorted((int(a), int(b)))
        child = crossover(lengths, population[better], population[worse], cap, rng)
        child = mutate(lengths, child, cap, rng)
        if fitness(lengths, child, cap) >= fitness(lengths, population[-1], cap):
            population[-1] = child
            population.sort(key=lambda p: fitness(lengths, p, cap), reverse=True)
        found = fitness(lengths, population[0], cap)
        waited = 0 if found > best else waited + 1
        best = found
    return _as_numbers(population[0], len(lengths))


# --- Spark: pieces, blocks, islands --------------------------------------------------------


def _pieces(tokenizer_path: str, end_id: int, capacity: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, uid = word_memo(tokenizer_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, doc_ids = batch.column("_text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in text_slices(texts):
                rows = []
                data = memo.encode([t.decode("utf-8", "replace") for t in texts[a:b]])
                for doc_id, ids in zip(doc_ids[a:b], data, strict=True):
                    ids += end
                    n = len(ids) // 4
                    at, piece = 0, 0
                    while at < n:
                        length = capacity if at or n % capacity == 0 else n % capacity
                        part = ids[4 * at : 4 * (at + length)]
                        rows.append((uid, doc_id, piece, at, length, zlib.crc32(part)))
                        at, piece, uid = at + length, piece + 1, uid + 1
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048
) -> DataFrame:
    """Pieces of at most ``capacity`` ids, written once; null text is empty (one end id)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("_text"))
    return stored(rows.mapInArrow(_pieces(tokenizer_path, end_id, capacity), PIECES), "pieces")


def _solve_blocks(pieces: DataFrame, n_blocks: int, salt: int, params: PackingParams) -> DataFrame:
    """``block``, ``uid``, ``length``, ``bin`` and ``gap`` of all pieces, packed block by block."""
    spark = pieces.sparkSession
    n_tasks = min(n_blocks * params.islands, tasks_for(spark, n_blocks * params.islands, 2))
    dealt = pieces.select(
        "uid",
        "length",
        F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(n_blocks)).cast("int").alias("block"),
    )
    blocks = (
        dealt.repartition(max(1, min(n_blocks, n_tasks)), "block")
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("items"))
        .select("block", F.col("items.uid").alias("uids"), F.col("items.length").alias("lengths"))
    )
    numbers = "array<int>"
    islands = blocks.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.lit(params.islands - 1))).alias("island"),
        F.expr(f"cast(array() as array<{numbers}>)").alias("elites"),
    )
    schema = (
        "block int, island int, uids array<long>, lengths array<int>, "
        f"elites array<{numbers}>, n_bins int, score double"
    )
    for epoch in range(params.epochs):

        def run(frames: Iterator[pd.DataFrame], epoch=epoch) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    seed = hash((params.seed, salt, int(row.block), int(row.island), epoch))
                    lengths = [int(x) for x in row.lengths]
                    best = evolve(
                        lengths, [np.asarray(e) for e in row.elites], seed & 0x7FFFFFFF, params
                    )
                    count, score = fitness(lengths, _as_bins(best), params.capacity)
                    yield pd.DataFrame(
                        {
                            "block": [row.block],
                            "island": [row.island],
                            "uids": [row.uids],
                            "lengths": [row.lengths],
                            "elites": [[best]],
                            "n_bins": [-count],
                            "score": [score],
                        }
                    )

        columns = ["block", "island", "uids", "lengths", "elites"]
        islands = (
            islands.select(*columns)
            .repartition(n_tasks, "block", "island")
            .mapInPandas(run, schema)
        )
        if epoch + 1 < params.epochs:
            # The ring: each island also gets the elite of the one before it.
            ring = Window.partitionBy("block").orderBy("island")
            last = F.max_by("elites", "island").over(Window.partitionBy("block"))
            before = F.coalesce(F.lag("elites").over(ring), last)
            islands = islands.withColumn("elites", F.concat("elites", before))
    best = islands.groupBy("block").agg(
        F.min_by(
            F.struct("uids", "lengths", F.col("elites")[0].alias("bins")),
            F.struct("n_bins", -F.col("score"), "island"),
        ).alias("b")
    )
    rows = best.select(
        "block", F.explode(F.arrays_zip("b.uids", "b.lengths", "b.bins")).alias("r")
    ).select(
        "block",
        F.col("r.uids").alias("uid"),
        F.col("r.lengths").alias("length"),
        # Named after the smallest uid of the bin, which no other bin has.
        F.min("r.uids").over(Window.partitionBy("block", "r.bins")).alias("bin"),
        (
            F.lit(params.capacity)
            - F.sum("r.lengths").over(Window.partitionBy("block", "r.bins"))
        ).alias("gap"),
    )
    return stored(rows, "packed-blocks")


def assign_sequences(pieces: DataFrame, params: PackingParams | None = None) -> DataFrame:
    """Give each piece (``uid``, ``length``) its ``sequence_id`` and gapless ``offset``.

    ``uid`` must be unique; equal lengths, repeated documents and null ids make no
    difference. An empty table gives no rows. Blocks are dealt by a hash of ``uid``, so no
    source or length can fill one.
    """
    params = params or PackingParams()
    full = pieces.filter(F.col("length") >= params.capacity).select(
        "uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    loose, settled = pieces.filter(F.col("length") < params.capacity).select("uid", "length"), []
    count, salt = loose.count(), 0
    while count:
        n_blocks = -(-count // params.block_pieces)
        packed = _solve_blocks(loose, n_blocks, salt, params)
        if n_blocks == 1:
            settled.append(packed)
            break
        # Bins by their gaps, with the pieces up to each: half of a block's pieces go on at most,
        # so every round has half the blocks of the one before.
        emptiest = Window.partitionBy("block").orderBy(F.desc("gap"), "bin")
        everything = Window.partitionBy("block")
        marked = packed.withColumn(
            "goes_on",
            (F.col("gap") > params.slack)
            & (2 * F.count(F.lit(1)).over(emptiest) <= F.count(F.lit(1)).over(everything)),
        )
        marked = stored(marked, "marked-bins")
        settled.append(marked.filter("NOT goes_on"))
        loose = marked.filter("goes_on").select("uid", "length")
        count, salt = loose.count(), salt + 1
    placed = full
    order = Window.partitionBy("bin").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    for packed in settled:
        placed = placed.unionByName(
            packed.select(
                "uid",
                F.col("bin").alias("sequence_id"),
                F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset"),
            )
        )
    return pieces.join(placed, "uid")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, params: PackingParams | None = None
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null text counts
    as empty and gives one piece of one id. Other columns of ``docs`` are ignored.
    """
    params = params or PackingParams()
    pieces = tokenized_pieces(docs, tokenizer_path, end_id, params.capacity)
    return assign_sequences(pieces, params).drop("uid")
