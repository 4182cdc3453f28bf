"""JSON lines in and out, tolerant or strict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewcraft.session import path_exists

CORRUPT = "_corrupt"


def read_tolerant(
    spark: SparkSession, path: str | list[str], schema: T.StructType, required: str | None = None
) -> DataFrame:
    """Skip lines that are not JSON; a missing path, or no path, is an empty table.

    A proper record without the ``required`` field is an error: it would
    silently lose its identity.
    """
    if not path or (isinstance(path, str) and not path_exists(spark, path)):
        return spark.createDataFrame([], schema)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    parsed = (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .filter(F.col(CORRUPT).isNull())
        .drop(CORRUPT)
    )
    return parsed if required is None else require_field(parsed, required)


def require_field(df: DataFrame, name: str) -> DataFrame:
    missing = F.raise_error(F.lit(f"record without {name}")).cast(df.schema[name].dataType)
    value: Column = F.when(F.col(name).isNull(), missing).otherwise(F.col(name))
    return df.withColumn(name, value)


def read_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Fail at the first line that is not JSON."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def append(df: DataFrame, path: str) -> None:
    """Add records as new part files; null fields are written out."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
