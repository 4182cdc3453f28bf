"""Small helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft.session import shared_folder, ship_package

BATCH_BYTES = 8 << 20
SPLITS_KEY = "spark.sql.files.minPartitionNum"


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that long texts cannot fill a Python worker.

    Python workers get the package here too. The number of cores that Spark cuts files for
    is fixed for the session: else losing an executor could change the splits of a table
    between two scans, and with them the numbers of its rows.
    """
    ship_package(spark)
    if spark.conf.get(SPLITS_KEY, None) is None:
        spark.conf.set(SPLITS_KEY, str(spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` without names that start with an underscore, and what gives them back.

    The operators' own columns have such names: an input column of that kind is renamed
    while they work on it.
    """
    taken = {c.lower() for c in docs.columns}
    renamed: dict[str, str] = {}
    for name in docs.columns:
        if name.startswith("_"):
            other = f"input{name}"
            while other.lower() in taken:
                other += "_"
            taken.add(other.lower())
            renamed[name] = other
    back = {other: name for name, other in renamed.items()}
    return docs.withColumnsRenamed(renamed), lambda df: df.withColumnsRenamed(back)


def utf8(column: str = "text") -> Column:
    """The bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends here, executors may go."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions of about ``rows_per_task`` rows, and enough of them for all cores."""
    cores = spark.sparkContext.defaultParallelism
    return max(min(rows, 4 * cores), -(-rows // rows_per_task), 1)


def binary_values(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The values of a binary Arrow column, one at a time."""
    for value in column:
        yield value.as_py()


def hot_key_cells(
    rows: DataFrame, key: list[str], uid: str, limit: int
) -> DataFrame:
    """Cut the groups of ``key`` with more than ``limit`` rows into cells of two blocks.

    Adds ``cell_a``, ``cell_b`` and ``side``. Small groups keep one cell (0, 0). A large
    group is dealt by a hash of ``uid`` into blocks of about ``limit`` rows, and each row
    goes to the cells of its block with every block. Any two rows of a group meet in
    exactly one cell: in cell (i, i), or on different sides of cell (i, j). So no task
    holds more than two blocks, whatever the size of the group.
    """
    # At most one in ``limit`` keys is here. Stored, its size is known: Spark broadcasts it if
    # it is small, so that rows are shuffled only once, and else can split hot keys.
    large = stored(
        rows.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > limit)
        .select(*key, F.ceil(F.col("_n") / limit).cast("int").alias("_blocks")),
        "large-groups",
    )
    dealt = rows.join(large, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn(
        "_block", F.pmod(F.xxhash64(F.col(uid), F.lit("block")), F.col("_blocks")).cast("int")
    ).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return (
        dealt.withColumn("cell_a", F.least("_block", "_other"))
        .withColumn("cell_b", F.greatest("_block", "_other"))
        .withColumn("side", (F.col("_block") > F.col("_other")).cast("int"))
        .drop("_blocks", "_block", "_other")
    )
