"""Corpus pipeline: documents -> packed training sequences, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet and read again as the next stage's ``docs``.  Every stage
works on all that its predecessor kept and its decisions take effect; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import best_fit_packing, exact_dedup, near_dedup, substring_dedup, toxicity
from ledgerloom.llm.common import read_table
from ledgerloom.session import checkpoint_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.3 go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity 0.8 of their 5-word shingles one stays."""
    return near_dedup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 35-word windows that occur more than once go from the texts; every document stays."""
    out = substring_dedup.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of 2,048 tokens."""
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", pack),
]

#: Tokenisation and learned scores cannot be written in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
