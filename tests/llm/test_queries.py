"""Operator queries: those with SQL against DuckDB, and where the others are tested."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from reviewcraft.llm import decontaminate, language_centroids, license_index, queries, sharding
from reviewcraft.llm import simhash, suffix_dedup
from tests.compare import compare, connect
from tests.llm.fixtures import odd_docs, saved

DATA = "/root/testdata/sf0.001"
#: No SQL: hashes, models, tokenizers. Each has a test against a brute-force version.
BRUTE_FORCE = {
    "op1_simhash": "test_simhash.py",
    "op2_token_ids": "test_tokens_and_packing.py",
    "op3_language": "test_language_centroids.py",
    "op4_licenses": "test_license_index.py",
    "op5_main_text": "test_html_template.py",
    "op6_decontaminate": "test_decontaminate.py",
    "op7_vector_duplicates": "test_itq.py",
    "op9_suffix_dedup": "test_suffix_dedup.py",
    "op10_pack": "test_tokens_and_packing.py",
    "op13_imatch": "test_imatch.py",
    "pipeline": "test_pipeline.py",
}


def test_every_query_has_sql_or_a_brute_force_test():
    names = {*queries.QUERIES, "pipeline"}
    assert names == queries.ORACLES.keys() | BRUTE_FORCE.keys()
    assert names <= registered.queries().keys()
    assert all((Path(__file__).parent / name).exists() for name in BRUTE_FORCE.values())


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, name):
    sql = queries.ORACLES[name]
    assert compare(spark, connect(DATA), DATA, queries.QUERIES[name], sql) == ""


OPERATORS = {
    "simhash": simhash.one_of_each_group,
    "suffix_dedup": suffix_dedup.remove_repeats,
    "without_repeats": suffix_dedup.without_repeats,
    "without_leaks": lambda docs: decontaminate.without_leaks(
        docs, docs.select(F.col("doc_id").alias("item_id"), "text").limit(3)
    ),
    "scan_licenses": license_index.scan_licenses,
    "predict_languages": language_centroids.language_of_documents,
    "shard_documents": sharding.shard_documents,
}
INTERNAL = (
    "_row _text _utf8_text _spans _hash _bytes _cell0 _bucket0 _bucket _in _n _no _shift "
    "_bucket_depth _overflow_hash _tie _block _other _blocks"
).split()


@pytest.mark.parametrize("name", OPERATORS)
def test_names_of_own_columns_may_clash(spark, tmp_path, name):
    """Columns with every internal name come back as they were, and nothing else changes."""
    plain = saved(odd_docs(spark), tmp_path / "plain")
    extra = {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INTERNAL}
    clashing = saved(plain.withColumns(extra), tmp_path / "clashing")
    found = OPERATORS[name](clashing)
    assert set(INTERNAL) <= set(found.columns)
    wrong = [F.col(c) != F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INTERNAL]
    assert found.agg(*(F.count_if(w) for w in wrong)).first() == tuple([0] * len(INTERNAL))
    wanted = OPERATORS[name](plain)
    columns = [c for c in wanted.columns if c not in ("shard",)]
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(found) == key(wanted)
