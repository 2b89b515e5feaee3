"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept: texts in no known language go, repeated lines go, one document of each
group of near copies stays, passages that an earlier document has go, and what
is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import jaccard_join, language, line_dedup, packing, substring_dedup
from millrace.llm.frames import prepared, written


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without a letter or far from every centroid go."""
    prepared(spark)
    model = language.fit(docs.filter(~language.held_out()))
    return language.accepted(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stood before; a document that loses all its words goes."""
    prepared(spark)
    left = line_dedup.deduplicated(docs).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _with_length(left)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    prepared(spark)
    copies = jaccard_join.classes(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that an earlier one has."""
    prepared(spark)
    return _with_length(substring_dedup.deduplicated(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    prepared(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("passages", drop_passages),
    ("packing", pack),
]

# The language stage is a fitted classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is written and read again."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
