"""Near-duplicate vectors with iterative quantisation (operator 7).

A rotation is learned (from a bounded sample, ``sample_vectors``) such that the signs of
the rotated principal components lose as little as possible: balanced binary codes. Codes
are cut into substrings; vectors with an equal substring meet in a bucket of a multi-index
table, where they are compared by the cosine of the original vectors in double precision.

Length and number of the substrings follow from the number of vectors and the aim: buckets
of about ``bucket_vectors`` vectors, and at the threshold a share of at least ``recall`` of
pairs with an equal substring. That share is measured on the learned codes, with sampled
vectors and partners at the threshold: where vectors have a common direction, taking the mean
away makes angles larger than the cosine says. How much of the mean is taken away, and how
long substrings are, is chosen by the work that the aim then needs. More bits than dimensions
come from further rotations. Labels that fit in one bucket are compared whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, hot_key_cells, stored
from reviewcraft.llm.components import components


@dataclass(frozen=True)
class ItqParams:
    threshold: float = 0.93
    recall: float = 0.97
    bucket_vectors: int = 64
    least_bits: int = 8
    #: The documented bounds of the sample that the rotations are learned from.
    sample_vectors: int = 20_000
    sample_values: int = 1 << 22
    rounds: int = 30
    #: Pairs of each kind that the share of equal substrings is measured on, and tables to choose by.
    measured_pairs: int = 2000
    probe_tables: int = 8
    cell_vectors: int = 4096
    seed: int = 3


def learn_rotation(
    sample: np.ndarray, bits: int, rounds: int, seed: int, centring: float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Mean (or a part of it) and projection to ``bits`` components whose signs are the code."""
    mean = centring * sample.mean(axis=0)
    centred = sample - mean
    _, _, components_ = np.linalg.svd(centred.T @ centred)
    basis = components_[:bits].T
    projected = centred @ basis
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((basis.shape[1], basis.shape[1])))
    for _ in range(rounds):
        codes = np.sign(projected @ rotation)
        left, _, right = np.linalg.svd(codes.T @ projected)
        rotation = (left @ right).T
    return mean, basis @ rotation


@dataclass
class ItqIndex:
    """Means and projections of the rotations, and how their bits are cut."""

    rotations: list[tuple[np.ndarray, np.ndarray]]
    substring_bits: int
    tables: int

    def substrings(self, units: np.ndarray) -> np.ndarray:
        """One key for each vector and table."""
        if not self.substring_bits:
            return np.zeros((len(units), self.tables), dtype=np.int64)
        bits = np.concatenate([(units - m) @ p > 0 for m, p in self.rotations], axis=1)
        weights = 1 << np.arange(self.substring_bits, dtype=np.int64)
        cut = bits[:, : self.tables * self.substring_bits].reshape(
            len(units), self.tables, self.substring_bits
        )
        return cut.astype(np.int64) @ weights


def table_shape(vectors: int, params: ItqParams) -> tuple[int, int]:
    """Bits of a substring and number of tables, for codes that keep the angles of vectors."""
    bits = max(params.least_bits, math.ceil(math.log2(max(1.0, vectors / params.bucket_vectors))))
    same = (1 - math.acos(params.threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - params.recall) / math.log(1 - same)))


def threshold_pairs(sample: np.ndarray, params: ItqParams) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sampled vectors with partners at the threshold cosine, in two kinds.

    Partners lie in any direction, or in that of the difference of two sampled vectors.
    """
    rng = np.random.default_rng(params.seed)
    n, dims = sample.shape
    units = sample[rng.integers(0, n, params.measured_pairs)]
    out = []
    for away in (
        rng.standard_normal((len(units), dims)),
        sample[rng.integers(0, n, len(units))] - sample[rng.integers(0, n, len(units))],
    ):
        away = away - (away * units).sum(axis=1, keepdims=True) * units
        norms = np.linalg.norm(away, axis=1, keepdims=True)
        away = np.divide(away, norms, out=np.zeros_like(away), where=norms > 1e-9)
        near = params.threshold * units + math.sqrt(1 - params.threshold**2) * away
        out.append((units, near / np.linalg.norm(near, axis=1, keepdims=True)))
    return out


def _rotations(
    sample: np.ndarray, params: ItqParams, centring: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    dims = sample.shape[1]
    number = 0
    while True:
        part = sample
        if number:
            # A further rotation needs another start, not other vectors.
            flip = np.random.default_rng(params.seed + number).permutation(dims)
            part = sample[:, flip]
        mean, projection = learn_rotation(part, dims, params.rounds, params.seed + number, centring)
        if number:
            back = np.argsort(flip)
            mean, projection = mean[back], projection[back]
        yield mean, projection
        number += 1


def _equal_bits(rotation: tuple[np.ndarray, np.ndarray], pair: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    mean, projection = rotation
    return ((pair[0] - mean) @ projection > 0) == ((pair[1] - mean) @ projection > 0)


def _least_work(
    sample: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int, params: ItqParams
) -> tuple[float, int]:
    """Part of the mean to take away and bits of a substring, by the comparisons they need."""
    most, _ = table_shape(n, params)
    rng = np.random.default_rng(params.seed + 1)
    size = 10 * params.measured_pairs
    strangers = (sample[rng.integers(0, len(sample), size)], sample[rng.integers(0, len(sample), size)])
    best: tuple[float, float, int] | None = None
    for centring in (1.0, 0.5, 0.0):
        learned = []
        for rotation in _rotations(sample, params, centring):
            learned.append(rotation)
            if len(learned) * sample.shape[1] >= most * params.probe_tables:
                break
        equal = [
            np.concatenate([_equal_bits(r, p) for r in learned], axis=1) for p in (*pairs, strangers)
        ]
        for bits in sorted({max(params.least_bits, most - k) for k in (0, 3, 6)}, reverse=True):
            tables = equal[0].shape[1] // bits
            *same, meet = (
                float(e[:, : tables * bits].reshape(-1, tables, bits).all(axis=2).mean()) for e in equal
            )
            chance = min(max(min(same), 1e-6), 1 - 1e-6)
            needed = max(1.0, math.log(1 - params.recall) / math.log(1 - chance))
            work = needed * (params.bucket_vectors + n * meet)
            if best is None or work < best[0]:
                best = (work, centring, bits)
    return best[1], best[2]


def learn_index(sample: np.ndarray, n: int, params: ItqParams) -> ItqIndex:
    """As many tables as the aim needs, measured on pairs at the threshold."""
    if n <= params.bucket_vectors:
        return ItqIndex([], 0, 1)
    pairs = threshold_pairs(sample, params)
    centring, bits = _least_work(sample, pairs, n, params)
    rotations: list[tuple[np.ndarray, np.ndarray]] = []
    rest = [np.zeros((len(p[0]), 0), dtype=bool) for p in pairs]
    met = [np.zeros(len(p[0]), dtype=bool) for p in pairs]
    tables = 0
    for rotation in _rotations(sample, params, centring):
        rotations.append(rotation)
        rest = [
            np.concatenate([r, _equal_bits(rotation, p)], axis=1) for r, p in zip(rest, pairs, strict=True)
        ]
        while rest[0].shape[1] >= bits:
            met = [m | r[:, :bits].all(axis=1) for m, r in zip(met, rest, strict=True)]
            rest = [r[:, bits:] for r in rest]
            tables += 1
            if all(m.mean() >= params.recall for m in met):
                return ItqIndex(rotations, bits, tables)
    raise AssertionError("rotations do not end")


def build_index(vectors: DataFrame, n: int, dims: int, params: ItqParams) -> ItqIndex:
    """Learn from the vectors with the smallest hashes, as many as the bounds allow."""
    size = max(1, min(params.sample_vectors, params.sample_values // dims))
    share = min(1.0, 1.2 * size / max(n, 1))
    near = vectors.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < share * (1 << 20))
    rows = near.orderBy(F.xxhash64("node"), "node").limit(size).collect()
    sample = np.array([r["unit"] for r in rows], dtype=np.float64).reshape(-1, dims)
    return learn_index(sample, n, params)


_BUCKET = ["label", "dims", "tab", "key", "cell_a", "cell_b"]


def _bucket_links(threshold: float):
    """Links found first in this table, for each vector of each bucket cell."""

    def solve(block: dict[str, np.ndarray]) -> Iterator[tuple]:
        units = np.stack(block["unit"])
        keys = np.stack(block["keys"])
        table = int(block["tab"][0])
        side = block["side"] if block["cell_a"][0] != block["cell_b"][0] else None
        n = len(units)
        links, low = np.zeros(n, dtype=np.int64), block["node"].astype(np.int64).copy()
        label = np.arange(n)
        for a in range(0, n, 1024):
            cosines = units[a : a + 1024] @ units.T
            linked = cosines >= threshold
            linked[np.arange(len(linked)), np.arange(a, a + len(linked))] = False
            if side is not None:
                linked &= side[a : a + 1024, None] != side[None, :]
            i, j = np.nonzero(linked)
            # A pair counts in the first table in which its substrings are equal.
            new = ~(keys[i + a][:, :table] == keys[j][:, :table]).any(axis=1)
            i, j = i[new] + a, j[new]
            np.add.at(links, i, block["copies"][j])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if x < y:
                    while label[x] != x:
                        label[x] = label[label[x]]
                        x = label[x]
                    while label[y] != y:
                        label[y] = label[label[y]]
                        y = label[y]
                    label[max(x, y)] = min(x, y)
        for x in range(n):
            root = x
            while label[root] != root:
                root = label[root]
            if links[x] or root != x:
                yield int(block["node"][x]), int(links[x]), int(low[root])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_BUCKET, "side", "node", "copies", "unit", "keys"]
        kinds = (pa.int64(), pa.int64(), pa.int64())
        rest: dict[str, list] | None = None

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["node", "links", "other"],
            )

        for batch in batches:
            block = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            if rest is not None:
                block = {c: np.concatenate((rest[c], block[c])) for c in names}
            new = np.any([block[c][1:] != block[c][:-1] for c in _BUCKET], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            out: list[tuple] = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1:
                    out.extend(solve({c: block[c][a:b] for c in names}))
            rest = {c: block[c][cuts[-1] :] for c in names}
            yield emit(out)
        if rest is not None and len(rest["node"]) > 1:
            yield emit(list(solve(rest)))

    return run


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for value in batch.column("vector").to_pylist():
            unit = None
            if value and None not in value:
                vector = np.array(value, dtype=np.float64)
                norm = math.sqrt(float(vector @ vector)) if np.isfinite(vector).all() else 0.0
                if norm and math.isfinite(norm):
                    unit = vector / norm
            out.append(unit)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                batch.column("row"),
                batch.column("label"),
                pa.array(out, pa.list_(pa.float64())),
            ],
            names=["vec_id", "row", "label", "unit"],
        )


def _with_keys(index_of_dims):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            keys: list[np.ndarray | None] = [None] * batch.num_rows
            values = batch.column("unit")
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                units = np.array([values[int(i)].as_py() for i in at], dtype=np.float64)
                for i, found in zip(at.tolist(), index_of_dims.value[d].substrings(units), strict=True):
                    keys[i] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "keys"],
            )

    return run


def vector_links(
    vectors: DataFrame, params: ItqParams | None = None
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Vectors (``vec_id``, ``embedding``, ``label``) are compared if their labels are equal and
    not null and they have as many components. A vector that is null, empty, zero, or has a
    null or non-finite component links with nothing; so does one without a label. Equal
    vectors of a label are one node with a number of copies, which are linked to each other.
    Rows with a repeated ``vec_id`` are vectors of their own; a null id names no component
    unless it has no other. Other columns are ignored.
    """
    params = params or ItqParams()
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    units = stored(
        rows.mapInArrow(_units, "vec_id long, row long, label string, unit array<double>"),
        "unit-vectors",
    )
    usable = units.filter(F.col("unit").isNotNull() & F.col("label").isNotNull())
    nodes = stored(
        usable.groupBy("label", "unit").agg(
            F.min("row").alias("node"),
            F.min("vec_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first(F.size("unit")).alias("dims"),
        ),
        "vector-nodes",
    )
    sizes = {
        r["dims"]: r["n"]
        for r in nodes.groupBy("label", "dims")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("dims")
        .agg(F.max("c").alias("n"))
        .collect()
    }
    indexes = spark.sparkContext.broadcast(
        {d: build_index(nodes.filter(F.col("dims") == d), n, d, params) for d, n in sizes.items()}
    )
    keyed = nodes.select("label", "dims", "node", "copies", "unit")
    schema = "label string, dims int, node long, copies long, unit array<double>, keys array<long>"
    tables = keyed.mapInArrow(_with_keys(indexes), schema).select(
        "*", F.posexplode("keys").alias("tab", "key")
    )
    bucket = ["label", "dims", "tab", "key"]
    cells = hot_key_cells(tables, bucket, "node", params.cell_vectors)
    found = stored(
        cells.repartition(*_BUCKET)
        .sortWithinPartitions(*_BUCKET)
        .select(*_BUCKET, "side", "node", "copies", "unit", "keys")
        .mapInArrow(_bucket_links(params.threshold), "node long, links long, other long"),
        "vector-links",
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = (
        nodes.join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = stored(named, "vector-groups")
    smallest = stored(
        named.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids"
    )
    by_vector = named.join(smallest, "root").select(
        "label",
        "unit",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    return (
        units.join(by_vector, ["label", "unit"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
