"""Token ids of documents in ORC files (operator 2).

A file set is a folder of ORC files. Rows are documents in ascending ``doc_id`` order
(null first), each with its ids as ``array<int>``, which ORC stores with integer
run-length encoding. Row indexes and Bloom filters on ``doc_id`` let a lookup skip
stripes and row groups; any number of readers can take different stripes.

Columns: ``doc_id``, ``part`` (number of the file's range of documents), ``start_in_part``
(ids of the earlier documents of that part), ``n_tokens``, ``ids``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewcraft.llm.common import bounded_batches, utf8
from reviewcraft.llm.word_memo import text_slices, word_memo

STORED = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
STRIPE_BYTES = 64 << 20
ROW_INDEX_STRIDE = 10_000


def _encoded(tokenizer_path: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part, before = word_memo(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            doc_ids = batch.column("doc_id")
            for a, b in text_slices(texts):
                data = [
                    ids + end for ids in memo.encode([t.decode("utf-8", "replace") for t in texts[a:b]])
                ]
                counts = np.array([len(d) // 4 for d in data], dtype=np.int64)
                ends = np.cumsum(counts)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)), pa.int32()),
                    pa.array(np.frombuffer(b"".join(data), dtype="<i4")),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(a, b - a),
                        pa.array(np.full(b - a, part), pa.int32()),
                        pa.array(before + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        ids,
                    ],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
                )
                before += int(ends[-1])

    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encode every text, close each document with ``end_id``, write ORC files.

    Null text counts as empty, so it gives the end id alone. Rows with the same
    ``doc_id`` are ordered by a hash of their text, equal rows in any order; all are kept.
    An empty table gives a folder without rows. Other columns are ignored. Documents are
    dealt by ranges of (id, hash, row number), so one id or text may hold any share of them.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8().alias("_text"),
        F.xxhash64("text").alias("_tie"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["doc_id", "_tie", "_row"]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "_text")
        .mapInArrow(_encoded(tokenizer_path, end_id), STORED)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a file set with ``start``, the number of ids of all documents before.

    Only the sums of the parts, one row each, are put in order in one task.
    """
    stored = spark.read.schema(STORED).orc(path)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")
    )
    return (
        stored.join(F.broadcast(offsets), "part")
        .withColumn("start", F.col("_before") + F.col("start_in_part"))
        .drop("_before")
    )


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of single documents; stripes are skipped by statistics and Bloom filters."""
    return spark.read.schema(STORED).orc(path).filter(F.col("doc_id").isin(doc_ids))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32`` of their little-endian unsigned 32-bit form."""
    bounded_batches(tokens.sparkSession)
    kept = [f for f in tokens.schema.fields if f.name != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(), dtype="<i4")).cast("B")
            cuts = (4 * ids.offsets.to_numpy().astype(np.int64)).tolist()
            crc = [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(crc, pa.int64())],
                names=[*(f.name for f in kept), "ids_crc32"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return tokens.mapInArrow(run, f"{schema}, ids_crc32 long")
