"""Registered queries of these operators over the tables of a folder, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import (
    attribution,
    crosstoken,
    divergence,
    exact,
    language,
    licenses,
    lm,
    mixing,
    neardup,
    packing,
    quality,
    token_files,
    toxicity,
)
from roadlens.llm.tokens import public_file as _tokenizer
from roadlens.operators.lineage import new_folder

END = 1  # the id behind every document


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predict(_table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predict(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write(_table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"), END, path)
    return token_files.read_documents(spark, path)


def op4_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"), END)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op5_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(_table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.decisions(_table(spark, folder, "documents"))


def op7_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.of_sections(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = neardup.decisions(_table(spark, folder, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op10_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(_table(spark, folder, "documents"))


def op11_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return crosstoken.align(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergences(_table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_language": op1_language,
    "op2_toxicity": op2_toxicity,
    "op3_token_files": op3_token_files,
    "op4_harmonic_packing": op4_harmonic_packing,
    "op5_compression_bands": op5_compression_bands,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_temperature_mixing": op7_temperature_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_near_dedup": op9_near_dedup,
    "op10_deleted_interpolation": op10_deleted_interpolation,
    "op11_license_notices": op11_license_notices,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}

ORACLES = {
    "op6_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
""",
    "op9_near_dedup": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE
      WHEN len(words) >= 4 THEN list_distinct(list_transform(
        range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
      ELSE [] END AS shingles
  FROM split
), shingle AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS g FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
""",
    "op13_source_divergence": r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), found AS (
  SELECT r, lang, source, unnest(terms) AS term FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d FROM found GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL HAVING sum(d) >= 30
), langs AS (
  SELECT lang, coalesce(v, 0)::HUGEINT AS v, coalesce(total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM docs)
    LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang) USING (lang)
), sources AS (
  SELECT lang, source, coalesce(total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs)
    LEFT JOIN (SELECT lang, source, sum(counts.n) AS total FROM counts JOIN kept USING (lang, term)
      GROUP BY ALL) USING (lang, source)
), shares AS (
  SELECT lang, source, term, coalesce(counts.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(counts.n, 0) + 5)) // (sources.total + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (kept.n + 5)) // (langs.total + 5 * v) AS q
  FROM sources JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
      GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), parts AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
    ORDER BY value DESC, encode(item)) AS rank FROM parts
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
