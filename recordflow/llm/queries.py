"""The registered queries of the corpus operators, and their SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm import (
    collocations,
    gnat,
    imatch,
    jaccard,
    langid,
    lblm,
    line_dedup,
    mixing,
    packing,
    quality,
    token_files,
    url_filter,
    warc,
)
from recordflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    taken = (F.col("size") * F.size("uses")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken)


@register
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return token_files.read_token_files(manifest)


def held_out() -> Column:
    """Documents that nothing is learned from; a null id is neither held out nor learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs.where(~held_out())), ["doc_id"])
    out = found.select("row.doc_id", "lang_pred", "score")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


@register
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", F.col("kept_text").alias("text"), "n_lines", "n_removed")


#: Rules of the URL query, as (host, path).
URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


@register
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        "row.page_id", "host", "path", "rule", "verdict"
    )


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(warc.normalise(warc.write_monolithic(table(spark, sf_dir, "pages"))))


@register
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(table(spark, sf_dir, "documents"))


@register
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


SQL["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists
), grams AS (
  SELECT lang, len(w) AS size, array_to_string(w, ' ') AS gram, count(*) AS f
  FROM (SELECT lang, words[i:i + k - 1] AS w FROM places, range(1, 5) AS sizes(k) WHERE i + k - 1 <= len(words))
  GROUP BY ALL
), candidates AS (
  SELECT lang, size, gram, string_split(gram, ' ') AS w, f AS a FROM grams WHERE size > 1 AND f >= 30
), inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS gram, max(a) AS above
  FROM candidates, range(2, 4) AS sizes(k), range(1, 4) AS starts(i)
  WHERE k < size AND i + k - 1 <= size GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside o USING (lang, gram)
  WHERE o.above IS NULL OR 100::HUGEINT * o.above < 80::HUGEINT * c.a
), cuts AS (
  SELECT c.lang, c.gram, c.a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM kept c JOIN range(1, 4) AS sizes(k) ON k < c.size
  JOIN grams l ON l.lang = c.lang AND l.gram = array_to_string(c.w[:k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.gram = array_to_string(c.w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.gram ORDER BY score, k) = 1
), total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank, gram AS phrase,
  a, l, r, n, CAST(score AS BIGINT) AS score
FROM cuts JOIN total USING (lang) QUALIFY rank <= 2000
"""


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@register
def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lblm.score_texts(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
