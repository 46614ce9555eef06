"""The corpus pipeline: documents in, packed training sequences out, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their
columns; the last returns packed pieces. Between stages the rows are written as Parquet
and read again, so that a lost executor costs one stage's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import pii, quality, simhash
from adtally.llm.queries import learned_rules, mix_documents, pack_documents
from adtally.llm.shared import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    return quality.keep_good(docs, learned_rules(spark, sf_dir, docs)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of 3 words, at most 3 bits apart."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_bits=3).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind; lengths counted anew."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the targets of source, language and topic that are within reach."""
    return mix_documents(docs).filter("kept").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, balanced by attention cost."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("target_mix", target_mix),
    ("packing", packing),
]

#: SimHash and sub-word tokens can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
