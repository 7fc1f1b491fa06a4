"""One query per operator over its whole table, and SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, decontamination, divergence, hard_negatives, language, language_model, near_duplicates, personal_data, pieces,
    quality, secrets, url_rules, warc,
)
from .common import read

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents", "doc_id", "text")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(documents(spark, sf_dir), read(spark, sf_dir, "labels", "doc_id", "quality"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_and_read(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf_dir, "pages", "page_id", "url"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.find_contamination(documents(spark, sf_dir), items)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_vectors(read(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trips(documents(spark, sf_dir), path, public_tokenizers.PATTERN))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language, op2_personal_data, op3_quality_rules, op4_warc, op5_sentencepiece, op6_url_rules, op7_language_model,
        op8_secrets, op9_near_duplicates, op10_decontamination, op11_hard_negatives, op12_source_divergence, op13_byte_bpe,
    )
}

# Words after folding A-Z; the word patterns are fixed by the operators.
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), q AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, sha256(body) AS k FROM p
), r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY k) ELSE page_id END AS chosen FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = chosen THEN NULL ELSE chosen END AS refers_to FROM r
""",
    "op6_url_rules": """
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), l(h, s, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), f AS (
  SELECT page_id, arg_max(h || s, length(h || s)) AS rule, arg_max(v, length(h || s)) AS v FROM p, l
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN f USING (page_id)
""",
    "op9_near_duplicates": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words
), rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS shared FROM rows_ a JOIN rows_ b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (SELECT x, y FROM met WHERE 100 * shared >= 75 * (nx + ny - shared)
), reach AS (SELECT x AS doc_id, y AS other FROM links UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x
), low AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id
FROM sets s LEFT JOIN low l ON s.doc_id = l.doc_id
""",
    "op10_decontamination": f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT item_id, len(w) AS size, array_to_string(w, ' ') AS g FROM b WHERE len(w) BETWEEN 1 AND 12
  UNION SELECT item_id, 13, array_to_string(w[i:i + 12], ' ') FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (SELECT doc_id, p.size, i, item_id FROM places p JOIN windows USING (size, g)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op11_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> own AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
    "op12_source_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_FOLD}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), t AS (SELECT r, lang, source, unnest(w) AS term FROM d
), k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30
), c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL
), g AS (SELECT DISTINCT lang, source FROM d
), v AS (SELECT g.lang, count(term) AS kept FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN k USING (lang) GROUP BY ALL
), s AS (
  SELECT lang, source, kept, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * CAST(coalesce(n, 0) + 5 AS HUGEINT)) // (total + 5 * kept) AS p
  FROM s JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), q AS (
  SELECT lang, term, 1 + (1000000000 * CAST(sum(n) + 5 AS HUGEINT)) // (any_value(whole) + 5 * any_value(kept)) AS q
  FROM p JOIN (SELECT lang, any_value(kept) AS kept, sum(total) AS whole FROM s GROUP BY lang) USING (lang) GROUP BY ALL
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 50
""",
}
