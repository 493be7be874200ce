"""From raw documents to encoded training texts: each stage takes what the one before it kept.

Every stage reads the stored result of its predecessor and returns the columns
of documents; the last adds the token ids, how many they are, and whether
decoding them gives the text again. All stages pass further columns on, whatever
their names and types, keep repeated rows but for near duplicates, take texts of any
length and keep an empty table empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acervo.llm import byte_bpe, decontaminate, pii, simhash, toxicity
from acervo.llm.common import stored

PII_KEY = "public test key"


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the segment model rejects go. Null and empty texts hold no passage and stay, repeated rows go or stay together."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked the one with the smallest id stays.

    Null, empty and blank texts have fingerprint zero and leave one row. A null id counts as the largest.
    """
    return simhash.keep_one(docs, shingle=3, distance=3)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go. Null and empty texts hold none and stay."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to pseudonyms of their format. Null and empty texts stay as they are."""
    return pii.pseudonymise(docs, PII_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding. Columns of the new names stay; the new ones get underscores."""
    return byte_bpe.round_trips(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Fitted models, 64-bit hashes and tokens are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", "zstd")
    return stored(STAGES[-1][1](spark, docs, sf_dir), "pipeline-" + STAGES[-1][0], "zstd")
