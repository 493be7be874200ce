"""Set operators on document ids, for queries written as DataFrame code."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from acervo.operators.index import Index, term_bucket


def term_docs(index: Index, word: str) -> DataFrame:
    """Ids of documents having exactly this token; the word is taken as typed."""
    postings = index.postings
    if index.term_buckets:
        bucket = term_bucket(F.lit(word), index.term_buckets)
        postings = postings.filter(F.col("term_bucket") == bucket)
    return postings.filter(F.col("term") == word).select("doc_id")


def docs_and(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, "doc_id", "left_semi")


def docs_or(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def docs_not(index: Index, operand: DataFrame) -> DataFrame:
    """All documents but the operand's, empty documents included."""
    return index.documents.select("doc_id").join(operand, "doc_id", "left_anti")


def fetch_documents(index: Index, ids: DataFrame, *columns: str) -> DataFrame:
    """Columns of the documents in ``ids``.

    The block, or group of blocks, of an id is known, so with an ``ids`` that is
    broadcast the scan is pruned to those it names.
    """
    wanted = ids.withColumn(index.partition, index.partition_of(F.col("doc_id")))
    documents = index.documents.select("doc_id", index.partition, *columns)
    return documents.join(wanted, [index.partition, "doc_id"]).drop(index.partition)
