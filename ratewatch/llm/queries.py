"""The registered queries of this subpackage, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.llm import ann, audit, bpe, mixing, packing, pii, quality, resampling, simhash, substrings, tokens, topk, urls
from ratewatch.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Hosts, path starts and verdicts of the rules.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filtered(table(spark, sf_dir, "pages"), urls.rules_of(spark, URL_RULES))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(table(spark, sf_dir, "documents")))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.roundtrip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, offsets=True)


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.to_json("removed"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.qualities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.digests(packing.packed(table(spark, sf_dir, "documents"), path))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    registered = [
        op1_mix_sources, op2_url_filters, op3_personal_data, op4_nearest, op5_byte_bpe,
        op6_top_products, op7_simhash, op8_token_counts, op9_substrings, op10_quality,
        op11_packing, op12_filter_audit, op13_resampling,
    ]
    return {query.__name__: query for query in registered}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": OP2_SQL,
        "op6_top_products": OP6_SQL,
        "op12_filter_audit": OP12_SQL,
        "op13_resampling": OP13_SQL,
    }


#: Rules by host suffix and path start, the longest first; no rule allows.
OP2_SQL = """
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), judged AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
    CASE
      WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

#: All pairs of queries and candidates; whole numbers below 2^53 are exact as doubles.
OP6_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: The failing letters of each document; the step that removes it is the first whose letter is among them.
OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (
  SELECT *, min(doc_id) OVER (PARTITION BY t) AS first_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM texts
), judged AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM firsts
), flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM judged LEFT JOIN flags USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), walked AS (
  SELECT part, filter_order, fails, n, good, toxic,
    coalesce(list_min(list_transform(nullif(string_split(fails, ''), ['']), lambda c: strpos(filter_order, c))), 6) AS gone
  FROM cells, orders
), steps AS (
  SELECT part, filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS letter,
    CAST(sum(CASE WHEN gone > k THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN gone = k THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN gone < k AND contains(fails, substr(filter_order, k, 1)) THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = substr(filter_order, k, 1) THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN gone = k THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN gone = k THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM walked, range(1, 6) steps(k)
  GROUP BY part, filter_order, k
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM steps
"""

#: CRC-32 of each distinct word, byte by byte; its table of 256 follows from the polynomial, a fixed value.
OP13_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), list_transform(range(8), lambda x: CAST(0 AS UBIGINT))),
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS v
    FROM range(256) bytes(i)
  )
), words AS (
  SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM documents
  UNION ALL
  SELECT 't', NULL, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  FROM benchmark
), buckets AS (
  SELECT word, CAST(xor(CAST(4294967295 AS UBIGINT), list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
      list_transform(range(strlen(word)), lambda i: CAST(
        16 * (strpos('0123456789ABCDEF', substr(hex(encode(word)), 2 * i + 1, 1)) - 1)
        + strpos('0123456789ABCDEF', substr(hex(encode(word)), 2 * i + 2, 1)) - 1 AS UBIGINT))),
      lambda c, b: xor(tab[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8))) AS BIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), crc_table
), totals AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
  FROM words JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM totals) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM totals) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM totals
), weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
