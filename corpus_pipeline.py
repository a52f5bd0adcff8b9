"""The corpus pipeline: quality rules, toxicity, near duplicates, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm.common import staged
from terrane.llm.jaccard_join import keep_one
from terrane.llm.packing import pack
from terrane.llm.pii import redact
from terrane.llm.quality import keep_quality, learn_bands
from terrane.llm.toxicity import drop_toxic, learn
from terrane.session import prepare


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with limits learnt on those labelled clean."""
    return keep_quality(docs, learn_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def by_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifiers, learnt on these documents' labels, score as clean."""
    return drop_toxic(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def by_similarity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest doc_id."""
    return keep_one(docs)


def by_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind; n_chars follows the text."""
    kind = docs.schema["n_chars"].dataType
    return redact(docs).withColumn("n_chars", F.length("text").cast(kind))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and the place in it."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", by_quality),
    ("toxicity", by_toxicity),
    ("near_duplicates", by_similarity),
    ("personal_data", by_personal_data),
    ("packing", into_sequences),
]
ORACLE_SQL = None  # compression, learning and tokens are beyond SQL; tests compare by hand


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each written as Parquet and read by the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
