"""Run registered queries in Spark and DuckDB and compare rows.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
          "BOOLEAN": "boolean"}


def compare(spark: SparkSession, con, sf_dir: str, query, sql: str) -> str:
    """Empty if both agree in names, types and rows; else what differs."""
    result = query(spark, sf_dir)
    spark_types = dict(result.dtypes)
    spark_rows = _rows(result.columns, result.collect())
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {row[0]: _TYPES.get(row[1], row[1]) for row in described}
    duck_rows = _rows(list(duck_types), con.execute(sql).fetchall())
    if spark_types != duck_types:
        return f"types {spark_types} <> {duck_types}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows <> {len(duck_rows)}"
    different = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if different:
        return f"{len(different)} of {len(spark_rows)} rows differ, first: {different[0]}"
    return ""


def main(sf_dir: str, *names: str) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or oracles:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[name], oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{name:28} {time.time() - start:6.1f}s {problem[:1000] or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
