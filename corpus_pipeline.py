"""A corpus from raw documents to packed sequences.

Each stage works on everything that the one before kept, and its decisions take effect: a stage's result
is written as Parquet and read as the next one's ``docs``. All stages but the last return the columns of
``documents``. ``run`` applies them in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm import jaccard, langid, line_dedup, mixing, packing
from recordflow.llm.common import staged, table
from recordflow.llm.queries import tokenizer_path
from recordflow.session import scratch_scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The tokenizer's end of a document in the packed sequences.
END_ID = 0


def _row(**new: Column) -> list[Column]:
    """The columns of documents out of an operator's ``row``, some of them replaced; others are left behind."""
    return [new.get(c, F.col(f"row.{c}")).alias(c) for c in COLUMNS]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that belong to no language of the corpus; ``lang`` is what the text says it is.

    Null, empty and letterless texts go. Repeated rows are judged alike, a null id is kept, an empty table
    stays empty.
    """
    found = langid.identify(docs, langid.fit(docs)).where(F.col("lang_pred") != langid.REJECTED)
    return found.select(*_row(lang=F.col("lang_pred")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated passages; documents of which nothing is left go.

    Rows of which nothing is removed stay as they are, null and empty texts included. Rows with equal id and text
    lose the same lines; an empty table stays empty.
    """
    out = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    length = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("kept_text"))
    return out.where(left).select(*_row(text=F.col("kept_text"), n_chars=length.cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the smallest id, of equal ones by a hash of the text.

    Different texts are told apart whatever their ids are. Rows with equal id and text (or without id and with
    equal texts) are one document. Null, empty and wordless texts are near nothing; one without an id stays
    unless its group has one with an id. An empty table stays empty.
    """
    own = F.xxhash64("doc_id", "text")
    rows = docs.select(*COLUMNS).withColumn("_key", own)
    groups = jaccard.near_duplicates(rows.select(F.col("_key").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_key"))
    ids = rows.select("_key", "doc_id").distinct()
    first = ids.join(groups, "_key").groupBy("_group").agg(F.min(order).alias("_first"))
    kept = rows.join(first.select(F.col("_first._key").alias("_key")), "_key", "left_semi")
    return kept.dropDuplicates(["_key"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that the sources' words come to their target shares, in the order of the shards.

    A null source is a source; a null or empty text has no words. Repeated rows are drawn one by one; an empty table
    stays empty.
    """
    rows = mixing.mixed_rows(mixing.mix(docs, keep=list(COLUMNS)))
    ordered = rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return ordered.select(*_row())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of all documents in sequences of 1024 tokens; a null text is its end alone, an empty table gives no rows."""
    return packing.pack_documents(docs, tokenizer_path(), END_ID)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Language models, hashed draws and a tokenizer are not SQL; tests/llm holds the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. What a stage wrote on its way goes with it, its result with the next one's."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as scope:
            scope.take(before)
            docs = staged(stage(spark, docs, sf_dir), name)
            before = scope.owned_by(docs)
            scope.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
