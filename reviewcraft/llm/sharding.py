"""Extendible hashing of documents into shards under a byte limit (operator 8).

Only DataFrame functions. A document's key (its id and the digest of its text) is hashed
to 60 bits. The directory starts with one bucket; a bucket over the limit splits on the
next bit of the hash, others stay as they are. Bits are looked at in rounds of
``ROUND_BITS``: sizes are summed per prefix of that length (at most 2 ** ROUND_BITS sums
for the first round), all shorter prefixes follow from these sums, and only prefixes that
are still too large go into the next round.

Documents with one and the same hash (equal copies) cannot be told apart by bits. If
together they exceed the limit, their bucket gets overflow pages, each with as many copies
as fit. A single document above the limit has a shard of its own (``fits`` is false).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewcraft.llm.common import set_aside, stored

HASH_BITS = 60
ROUND_BITS = 15
SHARD_BYTES = 64 << 20


def document_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """60 bits of the MD5 of id and text; null counts as empty."""
    key = F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
        F.lit("/"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")),
    )
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {
            "_hash": document_hash(),
            "_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
        }
    )


def _round(pending: DataFrame, depth: int, limit: int) -> DataFrame:
    """Cells of the next ``ROUND_BITS`` bits with the bucket that holds each.

    ``depth`` bits are known to be too few. A cell whose own prefix is still too large has
    a null ``bucket_depth``.
    """
    to = depth + ROUND_BITS
    cells = pending.groupBy(F.shiftright("_hash", HASH_BITS - to).alias("cell")).agg(
        F.sum("_bytes").alias("b"),
        F.count(F.lit(1)).alias("n"),
        F.min("_hash").alias("lo"),
        F.max("_hash").alias("hi"),
    )
    first = depth + 1 if depth else 0
    prefixes = cells.withColumn("d", F.explode(F.sequence(F.lit(first), F.lit(to)))).withColumn(
        "prefix", F.expr(f"shiftright(cell, {to} - d)")
    )
    buckets = prefixes.groupBy("d", "prefix").agg(
        F.sum("b").alias("bytes"),
        F.sum("n").alias("docs"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    whole = (F.col("bytes") <= limit) | (F.col("lo") == F.col("hi"))
    return (
        prefixes.select("cell", "d", "prefix")
        .join(buckets, ["d", "prefix"])
        .groupBy("cell")
        .agg(
            F.min(
                F.when(whole, F.struct("d", "prefix", "bytes", "docs", "lo"))
            ).alias("bucket")
        )
        .select(
            "cell",
            F.col("bucket.d").alias("bucket_depth"),
            F.col("bucket.prefix").alias("bucket_prefix"),
            F.col("bucket.bytes").alias("bucket_bytes"),
            F.col("bucket.docs").alias("bucket_docs"),
            F.when(F.col("bucket.bytes") > limit, F.col("bucket.lo")).alias("overflow_hash"),
        )
    )


def build_directory(docs: DataFrame, limit: int = SHARD_BYTES) -> list[DataFrame]:
    """The directory, one stored table of cells for each round of bits.

    A cell points to its bucket (``bucket_depth``, ``bucket_prefix``, size and number of
    documents). No round has more cells than documents, nor the first more than
    2 ** ROUND_BITS.
    """
    pending = stored(_measured(docs).select("_hash", "_bytes"), "shard-sizes")
    rounds: list[DataFrame] = []
    for depth in range(0, HASH_BITS, ROUND_BITS):
        cells = stored(_round(pending, depth, limit), "shard-directory")
        rounds.append(cells)
        deeper = cells.filter(F.col("bucket_depth").isNull()).select("cell")
        if deeper.isEmpty():
            break
        to = depth + ROUND_BITS
        pending = pending.withColumn("cell", F.shiftright("_hash", HASH_BITS - to)).join(
            deeper, "cell", "left_semi"
        )
    return rounds


def _looked_up(measured: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """Each row with the bucket that the directory gives for its hash."""
    fields = ["bucket_depth", "bucket_prefix", "bucket_bytes", "bucket_docs", "overflow_hash"]
    found = measured
    for i, cells in enumerate(rounds):
        to = (i + 1) * ROUND_BITS
        table = cells.select(
            F.col("cell").alias(f"_cell{i}"),
            F.when(
                F.col("bucket_depth").isNotNull(), F.struct(*fields)
            ).alias(f"_bucket{i}"),
        )
        found = found.withColumn(f"_cell{i}", F.shiftright("_hash", HASH_BITS - to)).join(
            F.broadcast(table) if i == 0 else table, f"_cell{i}", "left"
        )
    names = [f"_bucket{i}" for i in range(len(rounds))]
    return (
        found.withColumn("_bucket", F.coalesce(*names))
        .drop(*names, *(f"_cell{i}" for i in range(len(rounds))))
        .select("*", *(F.col(f"_bucket.{f}").alias(f"_{f}") for f in fields))
        .drop("_bucket")
    )


def shard_documents(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Documents with ``shard``, ``shard_depth``, ``shard_page``, ``shard_bytes``, ``fits``.

    ``shard`` is ``s`` and the bits of the bucket, with ``-p<page>`` for overflow pages.
    Every row of ``docs`` comes back once, repeated rows and null ids or texts (counted
    as empty) too; an empty table gives no rows. Other columns are passed through; columns
    of the same names as the new ones are replaced.
    """
    new = ["shard", "shard_depth", "shard_page", "shard_bytes", "fits"]
    docs, given_back = set_aside(docs.drop(*new))
    rounds = build_directory(docs, limit)
    rows = _looked_up(_measured(docs), rounds)
    over = rows.filter(F.col("_overflow_hash").isNotNull())
    if all(cells.filter(F.col("overflow_hash").isNotNull()).isEmpty() for cells in rounds):
        over = over.limit(0)
    else:
        over = stored(over, "shard-overflow")
    # Copies of one text in an overflowing bucket are numbered inside each partition of
    # their stored table, then shifted by the numbers of the partitions before.
    over = over.withColumn("_in", F.spark_partition_id())
    sums = over.groupBy("_hash", "_in").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_hash").orderBy("_in").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = sums.select(
        "_hash", "_in", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift")
    )
    inside = Window.partitionBy("_hash", "_in").orderBy("_bytes")
    numbered = over.withColumn("_no", F.row_number().over(inside) - 1).join(
        shifts, ["_hash", "_in"]
    )
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("_bytes", F.lit(1))))
    page = F.floor((F.col("_no") + F.col("_shift")) / per_page)
    on_page = F.least(per_page, F.col("_bucket_docs") - page * per_page)
    bits = F.when(F.col("_bucket_depth") == 0, F.lit("")).otherwise(
        F.lpad(F.bin("_bucket_prefix"), F.col("_bucket_depth"), F.lit("0"))
    )
    paged = numbered.withColumns(
        {"shard_page": page.cast("int"), "shard_bytes": (on_page * F.col("_bytes")).cast("long")}
    )
    plain = rows.filter(F.col("_overflow_hash").isNull()).withColumns(
        {"shard_page": F.lit(0), "shard_bytes": F.col("_bucket_bytes")}
    )
    both = plain.unionByName(paged.drop("_no", "_shift", "_in"))
    suffix = F.when(
        F.col("_overflow_hash").isNotNull(),
        F.concat(F.lit("-p"), F.col("shard_page").cast("string")),
    ).otherwise(F.lit(""))
    sharded = both.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.concat(F.lit("s"), bits, suffix).alias("shard"),
        F.col("_bucket_depth").alias("shard_depth"),
        "shard_page",
        "shard_bytes",
        (F.col("shard_bytes") <= limit).alias("fits"),
    )
    return given_back(sharded)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write each shard to a folder ``shard=...`` of its own."""
    sharded = shard_documents(docs, limit)
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
