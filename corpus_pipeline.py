"""The corpus pipeline: abusive documents, copies, near copies and benchmark passages go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of ``documents``; the last returns the pieces of each text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import decontaminate, exact_dedup, order_minhash, severity, unigram
from graphloom.llm.common import small_batches, stored
from graphloom.sources.tables import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return severity.not_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return order_minhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return unigram.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("sentencepiece", encode),
]
#: The first stage is a fitted model, which SQL cannot express; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
