"""Saving and loading an index as Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acervo.operators.index import (
    DOCS_PER_BLOCK,
    Index,
    block_starts,
    block_vocabulary,
    blocks_per_group,
    document_terms,
    first_ids,
    flat_lists,
    list_figures,
    listed_cells,
    term_blocks,
    term_bucket,
    with_blocks,
)
from acervo.operators.rank import PIECE_LENGTH, flat_grams, gram_lists
from acervo.schemas import DOCUMENTS, GRAM_COUNTS, GRAM_LISTS, GRAMS, INDEX_MANIFEST, LISTS, POSTINGS, TERM_BLOCKS, VOCABULARY
from acervo.session import OPEN_FILES, batches_of_rows, cut_lineage, rows_as_sorted, write_table
from acervo.sources import manifest

TERM_BUCKETS = 64
DOC_SPLITS = 16
MOST_OPEN = 128  # files that a task keeps open
MAX_CELLS = 16_384  # tasks of one write; beyond, a task takes several cells


def save_index(
    documents: DataFrame,
    path: str,
    term_buckets: int = TERM_BUCKETS,
    doc_splits: int = DOC_SPLITS,
    docs_per_block: int = DOCS_PER_BLOCK,
    in_id_order: bool = False,
    ids: DataFrame | None = None,
) -> None:
    """Write a new version of the index at ``path``, which counts once all of it is there.

    A save goes to a folder of its own. The last write publishes the folder, the
    statistics and the catalogue of id blocks in one row, so readers keep the old index
    until then and a failed save leaves it as it was.

    Blocks hold ``docs_per_block`` documents each by rising id, however far apart the ids
    are. Their bounds come from ``ids(doc_id)``, or from the documents themselves if no
    cheaper source of their ids is given. Small blocks are stored in groups, so that the
    number of files follows the documents, not the blocks.

    Each table is derived from the one written before it, so the pages are
    read and cleaned once. Every table is moved once at most:

    * documents to their group of blocks, each group spread over ``doc_splits``
      tasks, by whole blocks if these are grouped; with ``in_id_order`` (every task holds a run of ids already, as
      after ``with_dense_ids``) they stay where they were computed;
    * postings to one cell per bucket of terms and group of blocks, which are the partitions
      that a term lookup and a search for the best prune to; as a term has one posting per
      document, no term brings more rows to a task than a group has documents. Where blocks are grouped the
      documents move instead, once more, and each task writes the buckets of its own, postings and figures in one;
    * the figures of terms by block, if these are not grouped, to the bucket of their term, summed per task first;
    * terms to the vocabulary, from those figures;
    * grams of terms not at all; each task of the vocabulary writes the buckets of its own,
      as some grams are in very many terms.
    """
    spark = documents.sparkSession
    before = manifest.latest(spark, path)
    folder = manifest.new_folder(path)
    per_group = blocks_per_group(docs_per_block)
    starts = cut_lineage(block_starts(documents if ids is None else ids, docs_per_block))
    bounds = first_ids(starts.filter(F.col("doc_block") % per_group == 0))
    documents = with_blocks(documents, starts, bounds, per_group)
    group_no = F.call_function("div", F.col("from_doc_block"), F.lit(per_group).cast("long"))
    n_groups = max(1, len(bounds))
    share, shares = F.col("doc_id"), doc_splits
    if per_group > 1:
        # Whole blocks to a task. Tasks of a whole group cost more per posting than smaller ones.
        shares = min(doc_splits, per_group)
        place = F.col("doc_block") - F.col("from_doc_block")
        share = F.call_function("div", place * shares, F.lit(per_group).cast("long"))
    if not in_id_order:
        documents = _by_cell(documents, group_no, n_groups, share, shares)
    in_order = documents.sortWithinPartitions("from_doc_block", "doc_block", "doc_id")
    write_table(in_order, f"{folder}/documents", "from_doc_block")
    stored = _read(spark, folder, "documents", DOCUMENTS)
    if per_group > 1:
        cells = _by_cell(stored, group_no, n_groups, share, shares)
        files = max(OPEN_FILES, min(term_buckets, MOST_OPEN))
        with rows_as_sorted(spark, files):
            write_table(listed_cells(cells, term_buckets), f"{folder}/postings", "term_bucket", "from_doc_block")
    else:
        bucket = term_bucket(F.col("term"), term_buckets)
        cells = _by_cell(
            document_terms(stored, "doc_block", "from_doc_block").withColumn("term_bucket", bucket),
            group_no,
            n_groups,
            F.col("term_bucket"),
            term_buckets,
        )
        with rows_as_sorted(spark):
            in_order = cells.sortWithinPartitions("term", "doc_id")
            write_table(in_order, f"{folder}/postings", "term_bucket", "from_doc_block")
        postings = _read(spark, folder, "postings", POSTINGS)
        figures = _by_cell(term_blocks(postings), F.col("term_bucket"), term_buckets, F.col("doc_block"), doc_splits)
        with rows_as_sorted(spark):
            write_table(figures, f"{folder}/term_blocks", "term_bucket")
    figures = list_figures(_read(spark, folder, "postings", LISTS)) if per_group > 1 else _read(spark, folder, "term_blocks", TERM_BLOCKS)
    terms = block_vocabulary(figures)
    write_table(terms, f"{folder}/vocabulary")
    # Only terms that are not very long get into tasks one to a row.
    with rows_as_sorted(spark, max(OPEN_FILES, min(term_buckets, MOST_OPEN))), batches_of_rows(spark, 4 * PIECE_LENGTH):
        cuts = gram_lists(_read(spark, folder, "vocabulary", VOCABULARY), term_buckets)
        write_table(cuts, f"{folder}/grams", "gram_bucket")
    counted = _read(spark, folder, "grams", GRAM_LISTS).groupBy("gram").agg(F.sum("n_terms").alias("n_terms"))
    write_table(counted, f"{folder}/gram_counts")
    row = {
        "folder": folder,
        "n_words": _read(spark, folder, "vocabulary", VOCABULARY).count(),
        "n_docs": stored.count(),
        "term_buckets": term_buckets,
        "docs_per_block": docs_per_block,
        "n_blocks": starts.count(),
        "blocks_per_group": per_group,
        "bounds": list(bounds),
        "in_one": False,
        "in_lists": per_group > 1,
        "grams_in_lists": True,
    }
    manifest.publish(spark, path, [row], INDEX_MANIFEST, before)


def _by_cell(rows: DataFrame, major: Column, n_majors: int, minor: Column, n_minors: int) -> DataFrame:
    """A task for each ``major`` number below ``n_majors`` and each remainder of ``minor``.

    Hashing these few keys would put several cells into some tasks and none into others.
    """
    cell = major * n_minors + F.pmod(minor, F.lit(n_minors).cast("long"))
    tasks = min(n_majors * n_minors, MAX_CELLS)
    return rows.repartitionById(tasks, F.coalesce(cell % tasks, F.lit(0)).cast("int"))


def load_index(spark: SparkSession, path: str) -> Index:
    """The newest index at ``path`` that was saved as a whole."""
    rows = manifest.latest(spark, path)
    if not rows:
        raise FileNotFoundError(f"no index has been saved at {path}")
    saved = rows[0]
    # Indexes of older versions do not tell; some have postings and figures in one table, told apart by ``is_figure``.
    in_one, in_lists, grams_in_lists = (bool(saved.asDict().get(name)) for name in ("in_one", "in_lists", "grams_in_lists"))
    lists = _read(spark, saved["folder"], "postings", LISTS) if in_lists else None
    postings = _read(spark, saved["folder"], "postings/is_figure=false" if in_one else "postings", POSTINGS)
    figures = _read(spark, saved["folder"], "postings/is_figure=true" if in_one else "term_blocks", TERM_BLOCKS) if lists is None else None
    listed = _read(spark, saved["folder"], "grams", GRAM_LISTS) if grams_in_lists else None
    return Index(
        documents=_read(spark, saved["folder"], "documents", DOCUMENTS),
        postings=postings if lists is None else flat_lists(lists).select(*POSTINGS.names),
        vocabulary=_read(spark, saved["folder"], "vocabulary", VOCABULARY),
        docs_per_block=saved["docs_per_block"],
        term_buckets=saved["term_buckets"],
        bounds=tuple(saved["bounds"]),
        grams=_read(spark, saved["folder"], "grams", GRAMS) if listed is None else flat_grams(listed).select(*GRAMS.names),
        gram_counts=_read(spark, saved["folder"], "gram_counts", GRAM_COUNTS),
        n_words=saved["n_words"],
        term_blocks=figures.select(*TERM_BLOCKS.names) if lists is None else list_figures(lists),
        n_blocks=saved["n_blocks"],
        blocks_per_group=saved["blocks_per_group"],
        lists=lists,
        gram_lists=listed,
    )


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row with the newest index's number of words and documents and its layout."""
    saved = manifest.versions(spark, path)
    newest = saved.agg(F.max("version").alias("version"))
    return saved.join(F.broadcast(newest), "version").select("n_words", "n_docs", "term_buckets", "docs_per_block")


def block_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_block, first_id, last_id, n_docs)`` of the newest index."""
    documents = load_index(spark, path).documents
    return documents.groupBy("doc_block").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n_docs")
    )


def _read(spark: SparkSession, folder: str, table: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{table}")
