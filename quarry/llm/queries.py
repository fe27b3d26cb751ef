"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import bpe, decontaminate, languages, licenses, lines, negatives, pii, quality, simhash, substrings, token_files, warc, whitening

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_trie_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_digest(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_line_templates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


#: A page is a response if it is small or the first of its payload, else a revisit of that.
ORACLES["op1_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@query("op1_warc")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(table(spark, sf_dir, "pages"))


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_digest(table(spark, sf_dir, "documents"))


#: Windows of ten words (or a whole shorter item) looked up in every document.
ORACLES["op2_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bw), keys AS (SELECT DISTINCT n, k FROM bw
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)
), hits AS (SELECT dw.doc_id, dw.n, dw.i, dw.k FROM dw JOIN keys ON keys.n = dw.n AND keys.k = dw.k
), words AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, unnest(range(0, n)) t(o) GROUP BY doc_id
), found AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits JOIN bw ON bw.n = hits.n AND bw.k = hits.k GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, CAST(coalesce(len(found.items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(found.items, ','), '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
"""

#: Every window of twenty words, its first place, and the words that later ones cover.
ORACLES["op9_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) t(i) WHERE len(w) >= 20
), placed AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win
), gone AS (
  SELECT DISTINCT doc_id, i + o AS i FROM placed, unnest(range(0, 20)) t(o) WHERE r > 1
), words AS (
  SELECT doc_id, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) t(i)
), kept AS (
  SELECT words.doc_id, array_to_string(list(x ORDER BY words.i), ' ') AS text, count(*) AS n
  FROM words ANTI JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


@query("op11_language_spans")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.language_digest(table(spark, sf_dir, "documents"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_digest(table(spark, sf_dir, "embeddings"))


@query("op13_hard_negatives")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.negatives_digest(table(spark, sf_dir, "embeddings"))


#: Every score of an anchor, its first positives, and the first negatives within each one's bounds.
ORACLES["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)
QUALIFY rank <= 3
"""
