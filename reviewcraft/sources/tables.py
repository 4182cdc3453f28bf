"""Parquet in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft.session import shared_folder


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Scan Parquet; a missing rating may be stored as NaN, which counts as null."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return nan_to_null(df, "rating") if "rating" in df.columns else df


def nan_to_null(df: DataFrame, column: str) -> DataFrame:
    if not isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return df
    value = F.col(column)
    return df.withColumn(column, F.when(~F.isnan(value), value))


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan at least one task per core before costly work on each row.

    One file with one big row group is read by one task. Only such small inputs
    are redistributed; a large table has more splits than the cluster has cores
    and comes back as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def count_rows(df: DataFrame) -> DataFrame:
    """Number of rows; for Parquet, Spark reads the footers' row counts only."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder and read back: its lineage ends there."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """Replace ``path``. A record limit also sets the unit of an incremental run."""
    writer = df.write.mode("overwrite")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
