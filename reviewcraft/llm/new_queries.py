"""Queries of operators 11 to 13 and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewcraft.llm import collocations, imatch, prefix_trie


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    conv = F.col("conv_id")
    return prefix_trie.prefix_trie(
        conversations, conv - conv % 20, F.crc32(conv.cast("string")) % 4, longest_head=3
    ).drop("words")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return collocations.collocations(docs).drop("words")


def op13_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return imatch.compare_with_edits(docs, imatch.learn_lexicon(docs))


QUERIES = {
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_imatch": op13_imatch,
}

ORACLES = {
    "op11_prefix_trie": r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS base_id,
         xor(list_reduce(
           [4294967295] || [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
           lambda crc, byte: list_reduce(
             [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM heads c LEFT JOIN own b ON b.conv_id = c.base_id),
members AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
nodes AS (
  SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                         FILTER (n = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL),
children AS (
  SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1)
           * len(regexp_extract_all(n.prefix[-1].t, '[^\x20\x09-\x0D]+')) END AS saves
  FROM nodes n LEFT JOIN children c USING (depth, prefix)),
upward AS (
  SELECT unnest(range(0, depth + 1)) AS depth, prefix, n_children, saves FROM counted),
subtrees AS (
  SELECT depth, prefix[1:depth] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
         sum(saves) AS saved_tokens
  FROM upward GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s USING (depth, prefix)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]""",
    "op12_collocations": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
counts AS (
  SELECT lang, w[i:i + k - 1] AS p, count(*) AS f
  FROM (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM starts)
  GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT * FROM counts WHERE len(p) > 1),
covered AS (
  SELECT DISTINCT lang, q[i:i + k - 1] AS p, f
  FROM (SELECT lang, q, f, i, unnest(range(2, least(len(q) - 1, len(q) - i + 1) + 1)) AS k
        FROM (SELECT lang, p AS q, f, unnest(range(1, len(p) + 1)) AS i FROM candidates))),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, l.f AS l, r.f AS r, t.n,
         ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:k]
  JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1:]),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT w.lang, array_to_string(w.p, ' ') AS phrase, w.a, w.l, w.r, w.n, w.score
  FROM weakest w ANTI JOIN covered v ON v.lang = w.lang AND v.p = w.p AND v.f >= w.a)
SELECT lang, row_number() OVER (
         PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM ranked
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000""",
}
