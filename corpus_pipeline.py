"""The corpus pipeline: language ID, near-dedup, benchmark decontamination, PII masking, source mixing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a DataFrame that is
written as Parquet to the shared folder and read again as the next stage's docs. All but the last return the columns
of documents. Null and empty texts have no language and go in the first stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirelens.llm import decontaminate, langid, mixing, neardup, pii
from wirelens.llm._text import table
from wirelens.shared import new_path

#: A language is rejected where the runner-up is smaller than this share above the winner.
LEAST_MARGIN = 0.001
#: Similarity, in percent, of documents that count as near duplicates.
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; texts without letters or with a narrow margin go."""
    return langid.keep_identified(docs, LEAST_MARGIN)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    return neardup.drop_near_duplicates(docs, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked; n_chars follows the new text."""
    return pii.mask(docs, pii.train(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document so that sources meet their target shares."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: The stages learn models and compare sketches, which SQL can't express; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = new_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
