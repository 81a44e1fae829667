"""The corpus pipeline: every stage reads the rows its predecessor kept.

Quality classifier, exact dedup, near-dedup, mixing to target weights, BPE encoding. All stages
but the last return the columns of ``documents``; the last adds the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from versemill.llm import bpe, exact, minhash, mix, quality
from versemill.session import Staging


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below the threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.drop_low_quality(docs, quality.fit_quality(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8)."""
    return minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, shuffled by shard."""
    return mix.mix(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``ids``: packed token ids; ``n_tokens``; ``decoded_equal``: decoding gives the text back."""
    return bpe.round_trip_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", bpe_encode),
]
#: SQL cannot express the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    staging, written = Staging(spark), None
    for _, stage in STAGES[:-1]:
        path = staging.path()
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if written:
            staging.drop(written)
        written = path
    return STAGES[-1][1](spark, docs, sf_dir)
