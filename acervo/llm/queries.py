"""One registered query per operator, over the whole intended table, and SQL equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from acervo.llm import byte_bpe, chat, decontaminate, dual_tree, hmm, ngram_join, pii, simhash, toxicity, url_filter, variants, warc, whitening
from acervo.session import scratch_path

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
PII_KEY = "public test key"
SAYING = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", SAYING), (-1, 1, "assistant", SAYING)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.windows(turns.unionByName(more)))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), path=path)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.with_types(table(spark, sf_dir, "pages")), path)
    found = warc.records(warc.read(spark, path, payloads=False))
    return found.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_decontamination,
        op3_hmm,
        op4_toxicity,
        op5_chat,
        op6_topk,
        op7_byte_bpe,
        op8_url_filter,
        op9_pii,
        op10_warc,
        op11_variants,
        op12_ngram_join,
        op13_whitening,
    )
}
