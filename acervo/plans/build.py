"""From raw pages to an index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acervo.functions.html import CONTAINER_CLASS, CONTAINER_TAG, TEXT_TAGS, read_pages
from acervo.functions.urls import path_title
from acervo.operators.index import (
    DOCS_PER_BLOCK,
    Index,
    build_documents,
    index_from_documents,
    with_dense_ids,
)
from acervo.sources.index_store import DOC_SPLITS, TERM_BUCKETS, load_index, save_index


def is_complete() -> Column:
    return F.col("url").isNotNull() & F.col("text").isNotNull() & F.col("type").isNotNull()


def complete_pages(raw: DataFrame) -> DataFrame:
    return raw.filter(is_complete())


def rejected_pages(raw: DataFrame) -> DataFrame:
    """Rows that cannot be indexed, with the names of what they lack."""
    lacking = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in ("url", "text", "type"))))
    return raw.filter(~is_complete()).withColumn("reason", F.concat(F.lit("missing "), F.array_join(lacking, ", ")))


def extract_pages(
    raw: DataFrame,
    container_tag: str = CONTAINER_TAG,
    container_class: str = CONTAINER_CLASS,
    text_tags: Sequence[str] = TEXT_TAGS,
) -> DataFrame:
    """``(doc_id, title, url, text)`` of ``raw(doc_id, url, text, type)``.

    Only html rows enter the Python reader; all other rows keep their text
    and take their title from the URL. A row without URL, text or type makes the
    job fail; ``rejected_pages`` lists such rows and ``complete_pages`` the others.
    """
    told = F.concat(F.lit("page without URL, text or type: "), F.coalesce("url", F.lit("no URL")))
    raw = raw.withColumn("type", F.when(is_complete(), F.col("type")).otherwise(F.raise_error(told)))
    html = read_pages(
        raw.filter(F.col("type") == "html").select("doc_id", "url", "text"),
        "text",
        container_tag,
        container_class,
        text_tags,
    ).select("doc_id", "title", "url", F.col("body").alias("text"))
    other = raw.filter(F.col("type") != "html").select(
        "doc_id", path_title(F.col("url")).alias("title"), "url", "text"
    )
    return html.unionByName(other)


def number_pages(raw: DataFrame) -> DataFrame:
    """Keep a given ``doc_id``, else number the pages by URL."""
    if "doc_id" in raw.columns:
        return raw
    return with_dense_ids(raw, "url")


def page_documents(
    raw: DataFrame, stop: Sequence[str] | None = None, docs_per_block: int = DOCS_PER_BLOCK, **container
) -> DataFrame:
    return build_documents(extract_pages(number_pages(raw), **container), stop, docs_per_block)


def index_pages(
    raw: DataFrame,
    path: str | None = None,
    stop: Sequence[str] | None = None,
    term_buckets: int = TERM_BUCKETS,
    doc_splits: int = DOC_SPLITS,
    docs_per_block: int = DOCS_PER_BLOCK,
    **container,
) -> Index:
    """Index of raw pages, stored below ``path`` when one is given."""
    numbered_here = "doc_id" not in raw.columns
    raw = number_pages(raw)
    documents = page_documents(raw, stop, docs_per_block, **container)
    if path is None:
        return index_from_documents(documents, docs_per_block)
    save_index(documents, path, term_buckets, doc_splits, docs_per_block, in_id_order=numbered_here, ids=raw.select("doc_id"))
    return load_index(raw.sparkSession, path)
