"""The corpus pipeline: from raw documents to token ids. Each stage reads what its predecessor kept."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from chapterloom.llm import bpe, decontamination, language_id, quality_rules, signature_join
from chapterloom.llm.queries import held_out, read, tokenizer
from chapterloom.sources.scratch import discard, store_alone


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text has no letter or fits none of the languages learned from the labelled ones."""
    return language_id.accepted(docs, language_id.learn_profiles(docs.where(~held_out(3, 1))))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a base rule or are outliers of their language and source."""
    return quality_rules.accepted(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near duplicates."""
    return signature_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding."""
    path, pattern = tokenizer()
    return bpe.digests(bpe.round_trip(docs.select("doc_id", "text"), path, pattern))


STAGES = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", bpe_stage),
]

#: The learned stages have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each result is written and read again. Tables of a stage go when its result is stored, results when their successor is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        kept = store_alone(spark, partial(stage, spark, docs, sf_dir), f"stage{k}")
        if k:
            discard(docs)
        docs = kept
    return docs
