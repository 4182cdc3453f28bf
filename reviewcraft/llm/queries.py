"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft.llm import (
    decontaminate,
    html_template,
    itq,
    language_centroids,
    license_index,
    new_queries,
    orc_tokens,
    packing,
    sharding,
    simhash,
    suffix_dedup,
)
from reviewcraft.session import shared_folder

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-ids")
    orc_tokens.write_token_ids(_table(spark, sf_dir, "documents"), path, tokenizer_path(), 2)
    return orc_tokens.with_crc32(orc_tokens.read_token_ids(spark, path)).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_centroids.language_of_documents(docs)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_index.scan_licenses(files).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_template.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, benchmark).drop("_row")


def op7_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.vector_links(_table(spark, sf_dir, "embeddings"))


def op8_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "shard", "shard_depth", "shard_page", "shard_bytes", "fits"
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), 0)
    return packed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_ids": op2_token_ids,
    "op3_language": op3_language,
    "op4_licenses": op4_licenses,
    "op5_main_text": op5_main_text,
    "op6_decontaminate": op6_decontaminate,
    "op7_vector_duplicates": op7_vector_duplicates,
    "op8_extendible_shards": op8_extendible_shards,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_pack": op10_pack,
} | new_queries.QUERIES

ORACLES = {
    "op8_extendible_shards": f"""
WITH sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS b,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/'
                             || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
copies AS (SELECT *, row_number() OVER (PARTITION BY h) - 1 AS no FROM sized),
depths AS (SELECT unnest(range(0, {sharding.HASH_BITS + 1})) AS d),
buckets AS (
  SELECT d, h >> ({sharding.HASH_BITS} - d) AS prefix, sum(b) AS bytes, count(*) AS docs,
         min(h) = max(h) AS alone
  FROM sized, depths GROUP BY ALL),
placed AS (
  SELECT c.doc_id, c.h, c.no, c.b,
         arg_min(k, k.d) AS k
  FROM copies c, buckets k
  WHERE k.prefix = c.h >> ({sharding.HASH_BITS} - k.d)
    AND (k.bytes <= {sharding.SHARD_BYTES} OR k.alone)
  GROUP BY ALL),
paged AS (
  SELECT doc_id, k, b, k.bytes > {sharding.SHARD_BYTES} AS over,
         greatest(1, {sharding.SHARD_BYTES} // greatest(b, 1)) AS per_page, no
  FROM placed)
SELECT doc_id,
       's' || CASE WHEN k.d = 0 THEN '' ELSE lpad(bin(k.prefix), CAST(k.d AS INTEGER), '0') END
           || CASE WHEN over THEN '-p' || (no // per_page) ELSE '' END AS shard,
       CAST(k.d AS INTEGER) AS shard_depth,
       CAST(CASE WHEN over THEN no // per_page ELSE 0 END AS INTEGER) AS shard_page,
       CAST(CASE WHEN over THEN least(per_page, k.docs - (no // per_page) * per_page) * b
            ELSE k.bytes END AS BIGINT) AS shard_bytes,
       CASE WHEN over THEN least(per_page, k.docs - (no // per_page) * per_page) * b
            ELSE k.bytes END <= {sharding.SHARD_BYTES} AS fits
FROM paged""",
} | new_queries.ORACLES
