"""The registered queries of the operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, jaccard, language, linelabel, mixing, quality, substrings, tokens, urls, vectors

#: Parameter: the vocabulary file of the token operators, by name.
TOKENIZER = "byte_bpe_50k.json"
#: Rules of the query on pages: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.copies(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return linelabel.judge(docs, linelabel.fit(docs, table(spark, sf_dir, "labels")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = language.learn(docs.where(~held_out))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents")).drop("hi", "lo")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near(table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1, "op9_url_filters": OP9}


OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN doc_id IS NULL THEN md5(coalesce(text, '')) END AS tag, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents
), cells AS (
  SELECT *, (length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::BIGINT) * 4096
    + ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'n' || tag)), 1, 8))::BIGINT % 4096 AS cell FROM sized
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM sized GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER w AS k, coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS most_before,
    coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS weight_before
  FROM named WINDOW w AS (ORDER BY (3 * source_size)::DOUBLE / weight, source IS NULL, source)
), levels AS (
  SELECT *, ((SELECT sum(source_size)::BIGINT FROM named) - most_before)::DOUBLE / ((SELECT sum(weight)::BIGINT FROM named) - weight_before) AS level FROM ordered
), goal AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE,
    (SELECT arg_min(level, k) FROM levels WHERE level <= (3 * source_size)::DOUBLE / weight) * weight) AS target,
    ('0x' || substr(md5('1:' || coalesce('s' || source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM levels
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY cell, doc_id NULLS FIRST, tag NULLS FIRST, size) AS r FROM cells
), rated AS (
  SELECT r.*, g.source_size, g.target, g.start, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate
  FROM ranked r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, ((floor(r * rate + start) - floor((r - 1) * rate + start))::BIGINT * size)::BIGINT AS taken FROM rated
"""

OP9 = r"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), judged AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""
