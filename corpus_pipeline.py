"""The corpus pipeline: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.llm import decontam, langid, packing, simhash, suffixes
from cardwarden.llm.frames import read_table
from cardwarden.llm.registry import vocabulary
from cardwarden.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters in one of the learned languages; the model is that of the folder."""
    return langid.accepted(docs, langid.fit_documents(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of long strings that occur again."""
    return suffixes.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontam.without_items(docs, read_table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.packed(docs, vocabulary("word_bpe_49k.json")).drop("th")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontaminated", decontaminated),
    ("sequences", sequences),
]

# Trained models, alignments and tokenizers are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
