"""From raw documents to packed training sequences, stage by stage.

Each stage takes all documents that the one before it kept, and its decisions take effect:

1. language ID: documents that are rejected (no letters, or far from every language) go;
2. SimHash: one document of each group of near-duplicates stays;
3. suffix arrays: bytes of repeated long strings are cut out of the texts;
4. decontamination: documents that contain a benchmark item go;
5. packing: what is left becomes pieces in sequences.

Stages 1 to 4 return the columns of ``documents``. Empty tables, null columns and repeated
rows pass through as the operators define it; extra columns are kept until the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft.llm import decontaminate, language_centroids, packing, simhash, suffix_dedup
from reviewcraft.llm.queries import tokenizer_path
from reviewcraft.session import shared_folder


#: Passages of more than 50 words must not repeat. Words have 6.1 bytes with their space in
#: ``documents``; a window of 240 bytes also lies in passages of short words.
PASSAGE = suffix_dedup.Windows(240)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a known language. The model learns from the labelled ones."""
    model = language_centroids.train_centroids(language_centroids.training_rows(docs))
    found = language_centroids.predict_languages(docs, model)
    return found.filter(~F.col("rejected")).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, PASSAGE)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_leaks(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(), 0)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", decontaminate_documents),
    ("best_fit_packing", pack),
]

#: Fingerprints, clustering, suffix arrays and tokenizers have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
