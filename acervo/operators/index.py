"""The index: documents, postings, vocabulary, statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import partial
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from acervo.functions import text as tx
from acervo.schemas import COUNTED, LISTS, TERM_BLOCKS
from acervo.session import cut_lineage

DOCS_PER_BLOCK = 1_000_000
DOCS_PER_GROUP = 16_384  # blocks of fewer documents are stored in groups of about so many
POSTINGS_PER_LIST = 4096
BYTES_AT_ONCE = 1 << 20  # of text, whose terms a task counts in one step
BYTES_IN_ORDER = 1 << 23  # of text, whose postings and figures a task puts in the order of the store
ROWS_AT_ONCE = 1 << 17  # that go to Spark in one batch


@dataclass(frozen=True)
class Index:
    """``documents(doc_id, title, url, text, snippet, norm, doc_block)``,
    ``postings(term, doc_id, tf)`` and ``vocabulary(term, df, cf)``.

    ``term_buckets`` is set when the postings come from a saved index and
    carry the partition column ``term_bucket``. Its ``n_blocks`` blocks lie in groups of
    ``blocks_per_group``: documents and postings are partitioned by ``from_doc_block``, the first
    block of their group, and ``bounds`` are the smallest ids of the groups, rising.
    Without them a block is a run of ``docs_per_block`` ids.
    A saved index also has the dictionary of its terms' grams, ``grams(gram, token, term)``
    and ``gram_counts(gram, n_terms)``, and knows its number of terms ``n_words``. Its postings carry their
    ``doc_block``, and ``term_blocks(term, doc_block, df, cf, top)`` sums them up by term and block, with
    the largest ``tf / norm`` as ``top``. Where blocks are grouped, both are read from ``lists``, one row per
    term and block with its figures and all its postings, and the grams from ``gram_lists``.
    """

    documents: DataFrame
    postings: DataFrame
    vocabulary: DataFrame
    docs_per_block: int = DOCS_PER_BLOCK
    term_buckets: int | None = None
    bounds: tuple[int, ...] | None = None
    grams: DataFrame | None = None
    gram_counts: DataFrame | None = None
    n_words: int | None = None
    term_blocks: DataFrame | None = None
    n_blocks: int | None = None
    blocks_per_group: int = 1
    lists: DataFrame | None = None
    gram_lists: DataFrame | None = None

    @property
    def partition(self) -> str:
        """The column of documents and postings that tells where a document lies."""
        return "doc_block" if self.bounds is None else "from_doc_block"

    def partition_of(self, doc_id: Column) -> Column:
        if self.bounds is None:
            return doc_block(doc_id, self.docs_per_block)
        return block_between(doc_id, self.bounds) * self.blocks_per_group

    @property
    def block_keys(self) -> list[str]:
        return ["doc_block"] if self.bounds is None else ["from_doc_block", "doc_block"]

    @property
    def term_rows(self) -> DataFrame:
        """The postings as they are stored; ``flat`` gives one to a row."""
        return self.postings if self.lists is None else self.lists

    def flat(self, rows: DataFrame) -> DataFrame:
        """One posting to a row, from rows made of ``term_rows``."""
        return rows if self.lists is None else flat_lists(rows)

    def restricted(self, some: Callable[[DataFrame], DataFrame]) -> Index:
        """The index with some of the rows of its postings, chosen by term or block."""
        rows = some(self.term_rows)
        return replace(self, postings=self.flat(rows), lists=None if self.lists is None else rows)

    def with_partition(self, blocks: DataFrame) -> DataFrame:
        """A table by ``doc_block`` with all of ``block_keys``."""
        if self.bounds is None:
            return blocks
        return blocks.withColumn("from_doc_block", group_of(F.col("doc_block"), self.blocks_per_group))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets).cast("long"))


def term_buckets_of(terms: pa.Array, buckets: int) -> np.ndarray:
    """``term_bucket`` of an array of terms, inside a task."""
    hashed = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), terms.to_numpy(zero_copy_only=False)), np.uint64, len(terms))
    return hashed.view(np.int64) % buckets


def doc_block(doc_id: Column, docs_per_block: int = DOCS_PER_BLOCK) -> Column:
    return F.call_function("div", doc_id, F.lit(docs_per_block).cast("long"))


def blocks_per_group(docs_per_block: int) -> int:
    return max(1, -(-DOCS_PER_GROUP // docs_per_block))


def group_of(block: Column, per_group: int) -> Column:
    """The first block of the group that a block lies in."""
    return block - block % per_group


def block_between(doc_id: Column, bounds: Sequence[int]) -> Column:
    """The number of the block whose ids begin at the last of ``bounds`` that is not above the id.

    The bounds are searched in two steps, by every so many and then within these,
    so an id is compared with about twice their square root.
    """
    width = max(1, math.isqrt(len(bounds)))
    rows = [list(bounds[i : i + width]) for i in range(0, len(bounds), width)] or [[]]
    numbers = lambda values: "array(" + ", ".join(f"{v}L" for v in values) + ")"
    heads, table = F.expr(numbers(r[0] for r in rows if r)), F.expr("array(" + ", ".join(map(numbers, rows)) + ")")
    below = lambda values: F.size(F.filter(values, lambda b: b <= doc_id))
    # Ids before the first bound count to the first block.
    row = F.greatest(below(heads) - 1, F.lit(0))
    place = F.greatest(below(F.get(table, row)) - 1, F.lit(0))
    return (row * width + place).cast("long")


def block_starts(ids: DataFrame, docs_per_block: int) -> DataFrame:
    """``(doc_block, first_id)``: the smallest id of every block of ``docs_per_block`` documents, from ``ids(doc_id)``.

    Blocks hold equally many documents however far apart the ids are. Only ids are sorted.
    """
    ranked = with_dense_ids(ids.select("doc_id"), "doc_id", name="place")
    return ranked.filter(F.col("place") % docs_per_block == 0).select(
        doc_block(F.col("place"), docs_per_block).alias("doc_block"), F.col("doc_id").alias("first_id")
    )


def first_ids(starts: DataFrame) -> tuple[int, ...]:
    return tuple(row["first_id"] for row in starts.orderBy("doc_block").select("first_id").collect())


def block_bounds(ids: DataFrame, docs_per_block: int) -> tuple[int, ...]:
    """The smallest ids of all blocks, rising, in the driver."""
    return first_ids(block_starts(ids, docs_per_block))


def with_blocks(documents: DataFrame, starts: DataFrame, bounds: Sequence[int], per_group: int) -> DataFrame:
    """Documents with their ``from_doc_block`` and ``doc_block``, from the table of ``block_starts``.

    An id is compared with the ``bounds`` of the groups and then with the first ids of its own group's blocks.
    """
    group = group_of(F.col("doc_block"), per_group).alias("from_doc_block")
    inside = starts.groupBy(group).agg(F.sort_array(F.collect_list("first_id")).alias("first_ids"))
    below = F.size(F.filter("first_ids", lambda first: first <= F.col("doc_id")))
    place = F.greatest(below - 1, F.lit(0)).cast("long")
    return (
        documents.withColumn("from_doc_block", block_between(F.col("doc_id"), bounds) * per_group)
        .join(F.broadcast(inside), "from_doc_block", "left")
        .withColumn("doc_block", F.col("from_doc_block") + place)
        .drop("first_ids")
    )


def with_dense_ids(rows: DataFrame, *order: str, name: str = "doc_id") -> DataFrame:
    """Number rows 0, 1, 2, ... in the given order.

    The rows are range-sorted once and kept, then each sorted partition adds
    its row offset to the number of rows before it. Only one count per
    partition meets in a single task. The tie-breaker lets the range sort
    split a value that repeats too often for one partition.
    """
    ordered = cut_lineage(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*order, "_tie")
        .drop("_tie")
    )
    marked = ordered.withColumn("_row", F.monotonically_increasing_id())
    partition = F.shiftright("_row", 33)
    offset = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    marked = marked.withColumn("_part", partition)
    before = (
        marked.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_n")
    )
    return (
        marked.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + offset)
        .select(name, *rows.columns)
    )


def build_documents(
    extracted: DataFrame,
    stop: Sequence[str] | None = None,
    docs_per_block: int = DOCS_PER_BLOCK,
) -> DataFrame:
    """Document table from ``extracted(doc_id, title, url, text)``; no shuffle."""
    stopped = frozenset(tx.stopwords() if stop is None else stop)
    cleaned = F.arrow_udf(lambda texts: clean_texts(texts, stopped), "text string, norm double, is_known boolean")
    is_known = F.col("cleaned.is_known")
    return extracted.withColumn("cleaned", cleaned("text")).select(
        "doc_id",
        "title",
        "url",
        F.when(is_known, F.col("cleaned.text")).otherwise(tx.joined(tx.index_tokens("text", stop))).alias("text"),
        tx.snippet(F.col("text")).alias("snippet"),
        F.when(is_known, F.col("cleaned.norm")).otherwise(tx.norm(tx.index_tokens_sql("text", stop))).alias("norm"),
        doc_block(F.col("doc_id"), docs_per_block).alias("doc_block"),
    )


def clean_texts(texts: pa.Array, stop: frozenset[str]) -> pa.Array:
    """``struct<text, norm, is_known>``: texts as joined tokens, and their norms, 0.0 without tokens.

    Texts with characters that this Python does not know are left to Spark, which may know their lower case.
    """
    cleaned, norms, known = [], [], []
    for text in texts.to_pylist():
        known.append(not text or tx.all_assigned(text))
        words = tx.clean_words(text, stop) if text and known[-1] else []
        counts = Counter(words).values()
        cleaned.append(" ".join(words) if text and known[-1] else text)
        norms.append(math.sqrt(sum(map(mul, counts, counts))))
    columns = [pa.array(cleaned, pa.string()), pa.array(norms, pa.float64()), pa.array(known, pa.bool_())]
    return pa.StructArray.from_arrays(columns, ["text", "norm", "is_known"])


def text_slices(texts: pa.Array, most_bytes: int | None = None) -> Iterator[pa.Array]:
    """Runs of texts of about ``BYTES_AT_ONCE`` each, or of a single longer text; null texts become empty."""
    most_bytes = most_bytes or BYTES_AT_ONCE
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(np.array(pc.binary_length(texts)), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield texts[start:stop]
        start = stop


def counted_terms(texts: pa.Array, rising: bool = False, buckets: int | None = None) -> tuple:
    """Distinct terms, and per term and text the term's number, the text's place and the frequency.

    Texts are tokens joined by single spaces. With ``rising`` terms are numbered in their order, with ``buckets`` by
    their bucket first, and the buckets of the terms follow.
    """
    lists = pc.split_pattern(texts, " ")
    found = lists.flatten().dictionary_encode()
    terms, numbers = found.dictionary, found.indices.to_numpy().astype(np.int64)
    held = []
    if rising or buckets:
        order = pc.sort_indices(terms).to_numpy()
        if buckets:
            by_number = term_buckets_of(terms, buckets)
            order = order[np.argsort(by_number[order], kind="stable")]
            held = [by_number[order]]
        ranks = np.empty(len(terms), dtype=np.int64)
        ranks[order] = np.arange(len(terms))
        terms, numbers = terms.take(pa.array(order)), ranks[numbers]
    keys = numbers * len(texts) + np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    tf = np.diff(np.append(first, len(keys)))
    return terms, keys[first] // len(texts), keys[first] % len(texts), tf, *held


def document_terms(documents: DataFrame, *more: str) -> DataFrame:
    """Flat postings ``(term, doc_id, tf, norm)`` of a document table; no shuffle.

    The norm is the document's, so that a search needs no join to score. More columns may be kept.
    """
    kept = ["doc_id", "norm", *more]
    rows = documents.select("text", *kept)
    of_kept = [T.StructField(c, rows.schema[c].dataType) for c in kept]
    fields = [T.StructField("term", T.StringType()), T.StructField("tf", T.LongType()), *of_kept]
    return rows.mapInArrow(_count_terms, T.StructType(fields)).select("term", "doc_id", "tf", "norm", *more)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, tf, ...)`` from ``(text, ...)``: the terms of a document are counted in its own row.

    Rows come by rising term, as they are stored; sorting them there only has to merge such runs.
    """
    for batch in batches:
        batch = batch.filter(pc.greater(pc.binary_length(batch.column(0)), 0))
        done = 0
        for texts in text_slices(batch.column(0)):
            terms, numbers, places, tf = counted_terms(texts, rising=True)
            rows = pa.array(places + done)
            kept = [column.take(rows) for column in batch.columns[1:]]
            term = terms.take(pa.array(numbers)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([term, pa.array(tf, pa.int64()), *kept], ["term", "tf", *batch.schema.names[1:]])
            done += len(texts)


def listed_cells(cells: DataFrame, buckets: int) -> DataFrame:
    """``LISTS`` of blocks that each lie in one task: per term and block its figures and all its postings.

    Terms are counted once for both and written once per block, no posting moves, and each step of a task comes by
    rising bucket and term.
    """
    rows = cells.select("text", "doc_id", "norm", "doc_block", "from_doc_block").sortWithinPartitions("doc_block")
    return rows.mapInArrow(partial(_list_cells, buckets=buckets), LISTS)


def flat_lists(lists: DataFrame) -> DataFrame:
    """One posting to a row, from rows with the ``postings`` of ``LISTS``."""
    others = [c for c in lists.columns if c not in ("postings", "df", "cf", "top")]
    return lists.select(*others, F.inline("postings"))


def list_figures(lists: DataFrame) -> DataFrame:
    """The figures of ``term_blocks`` from ``LISTS``."""
    return lists.filter("df is not null").select(*TERM_BLOCKS.names)


def _list_cells(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """``LISTS`` from ``(text, doc_id, norm, doc_block, from_doc_block)`` by rising block.

    A block that goes on over several steps has its figures summed over them, in rows of their own after its lists.
    """
    kept = None
    for rows, goes_on in _block_steps(batches):
        found, lists = _listed(rows, *counted_terms(rows.column(0), buckets=buckets))
        blocks = found["doc_block"].to_numpy()
        first, last = rows.column(3)[0].as_py(), rows.column(3)[-1].as_py()
        is_part = np.zeros(len(blocks), dtype=bool)
        if kept is not None:
            is_part |= blocks == first
        if goes_on:
            is_part |= blocks == last
        yield from _list_batches(found, lists, is_part)
        if kept is not None:
            kept = _summed(pa.concat_tables([kept, found.filter(blocks == first)]))
            if not (goes_on and first == last):
                yield from _list_batches(kept)
                kept = None
        if goes_on and kept is None:
            kept = found.filter(blocks == last)


def _block_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Runs of rows of about ``BYTES_IN_ORDER`` of text, and whether the last block of a run goes on in the next one.

    Runs hold whole blocks, but for a block that is larger itself. Rows without text are left out.
    """
    waiting = None
    for batch in batches:
        rows = batch.filter(pc.greater(pc.binary_length(batch.column(0)), 0))
        if waiting is not None:
            rows = pa.concat_batches([waiting, rows])
        ends = np.cumsum(pc.binary_length(rows.column(0)).to_numpy(), dtype=np.int64)
        blocks = rows.column(3).to_numpy()
        start = 0
        while True:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BYTES_IN_ORDER, side="right")))
            if stop >= len(rows):
                break
            head = int(np.searchsorted(blocks, blocks[stop]))
            stop = head if start < head < stop else stop
            yield rows.slice(start, stop - start), bool(blocks[stop] == blocks[stop - 1])
            start = stop
        waiting = rows.slice(start)
    if waiting is not None and len(waiting):
        yield waiting, False


def _listed(rows: pa.RecordBatch, terms: pa.Array, numbers, places, tf, held) -> tuple[pa.Table, pa.Array]:
    """The figures per term and block, and for each of them its postings."""
    _, doc_id, norm, block, from_block = rows.columns
    of_row, of_block = pa.array(places), block.to_numpy()[places]
    norms = norm.to_numpy(zero_copy_only=False)[places]
    first = np.flatnonzero((np.diff(numbers, prepend=-1) != 0) | (np.diff(of_block, prepend=of_block[:1]) != 0))
    of_term, ends = numbers[first], np.append(first, len(tf))
    figures = {
        "term": terms.take(pa.array(of_term)),
        "doc_block": pa.array(of_block[first]),
        "df": pa.array(np.diff(ends)),
        "cf": pa.array(np.add.reduceat(tf, first)),
        "top": pa.array(np.fmax.reduceat(tf / norms, first), from_pandas=True),
        "term_bucket": pa.array(held[of_term]),
        "from_doc_block": from_block.take(pa.array(places[first])),
    }
    postings = pa.StructArray.from_arrays([doc_id.take(of_row), pa.array(tf), norm.take(of_row)], ["doc_id", "tf", "norm"])
    return pa.table(figures), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), postings)


def _list_batches(figures: pa.Table, lists: pa.Array | None = None, is_part: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of ``LISTS``; figures of a part of a block are left out, and figures alone have no postings."""
    if lists is None:
        lists = pa.nulls(len(figures), pa.list_(pa.struct({"doc_id": pa.int64(), "tf": pa.int64(), "norm": pa.float64()})))
    if is_part is not None and is_part.any():
        for name in ("df", "cf", "top"):
            at = figures.column_names.index(name)
            column = figures[name].combine_chunks()
            figures = figures.set_column(at, name, pc.if_else(pa.array(is_part), pa.scalar(None, column.type), column))
    for batch in figures.append_column("postings", lists).select(LISTS.names).combine_chunks().to_batches(ROWS_AT_ONCE):
        yield batch


def _summed(figures: pa.Table) -> pa.Table:
    """Figures of the parts of a block in one, by bucket and term, as the files of the store are written one after the other."""
    keys = ["term", "doc_block", "term_bucket", "from_doc_block"]
    summed = figures.group_by(keys).aggregate([("df", "sum"), ("cf", "sum"), ("top", "max")])
    summed = summed.rename_columns([name.removesuffix("_sum").removesuffix("_max") for name in summed.column_names])
    return summed.select(figures.column_names).sort_by([("term_bucket", "ascending"), ("term", "ascending")])


def _count_cells(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """``COUNTED``, one posting or figure to a row, from what ``_list_cells`` gives."""
    for batch in _list_cells(batches, buckets):
        lists = batch.column("postings")
        owners, postings = pc.list_parent_indices(lists), pc.list_flatten(lists)
        of_term = ["term", "doc_block", "term_bucket", "from_doc_block"]
        columns = {name: batch.column(name).take(owners) for name in of_term}
        columns |= {name: postings.field(name) for name in ("doc_id", "tf", "norm")}
        yield _with_nulls(columns, len(owners), False)
        figures = batch.filter(pc.is_valid(batch.column("df")))
        yield _with_nulls({name: figures.column(name) for name in (*of_term, "df", "cf", "top")}, len(figures), True)


def _with_nulls(columns: dict[str, pa.Array], n: int, is_figure: bool) -> pa.RecordBatch:
    """A batch of ``COUNTED``, whose other columns are null."""
    columns = columns | {"is_figure": pa.array(np.full(n, is_figure))}
    none = {f.name: pa.nulls(n, pa.float64() if f.dataType == T.DoubleType() else pa.int64()) for f in COUNTED if f.name not in columns}
    return pa.RecordBatch.from_pydict({name: columns[name] if name in columns else none[name] for name in COUNTED.names})


def text_terms(texts: DataFrame, stop: Sequence[str] | None = None) -> DataFrame:
    """The same straight from ``texts(doc_id, text)``, not yet normalised."""
    counts = tx.term_counts(tx.index_tokens_sql("text", stop))
    return flat_postings(texts.select("doc_id", counts.alias("counts")))


def flat_postings(counted: DataFrame, *more: str) -> DataFrame:
    # The outer form keeps the optimizer from adding a filter on the array's
    # size, which would count every document's terms a second time.
    return (
        counted.select("doc_id", *more, F.explode_outer("counts").alias("c"))
        .select(F.col("c.term").alias("term"), "doc_id", F.col("c.tf").alias("tf"), *more)
        .filter(F.col("term").isNotNull())
    )


def term_blocks(postings: DataFrame, splits: int | None = None, tasks: int | None = None) -> DataFrame:
    """Figures of each term in each block of ids, from ``postings(term_bucket, doc_block, term, tf, norm)``.

    Sums are made per task first, which helps if blocks are large. In small blocks a term has few postings; with
    ``splits`` these move once, to the bucket of their term and one of ``splits`` shares of the blocks, and are summed
    there, by ``tasks`` tasks if given.
    """
    keys = ["term_bucket", "doc_block", "term"]
    rows = postings.select(*keys, "tf", "norm")
    if splits is not None:
        split = F.pmod(F.col("doc_block"), F.lit(splits).cast("long"))
        keys = [*keys, "split"]
        rows = rows.withColumn("split", split).repartition(*([] if tasks is None else [tasks]), "term_bucket", "split")
    figures = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("cf"),
        F.max(F.col("tf") / F.col("norm")).alias("top"),
    )
    return figures.drop("split")


def block_vocabulary(blocks: DataFrame) -> DataFrame:
    """The vocabulary, from the table of ``term_blocks``."""
    return blocks.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def vocabulary(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )


def posting_lists(postings: DataFrame, ids_per_list: int = POSTINGS_PER_LIST) -> DataFrame:
    """List view for export: rising ids per term, in pieces of bounded length.

    A piece covers one range of ids, so a term of every document spreads over
    many rows; the pieces in ``list_no`` order are the whole posting list.
    """
    return (
        postings.withColumn("list_no", doc_block(F.col("doc_id"), ids_per_list))
        .groupBy("term", "list_no")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids"))
    )


def corpus_stats(index: Index) -> DataFrame:
    """One row ``(n_words, n_docs)``."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    words = index.vocabulary.select(one.alias("n_words"), none.alias("n_docs"))
    docs = index.documents.select(none.alias("n_words"), one.alias("n_docs"))
    return words.unionByName(docs).agg(
        F.coalesce(F.sum("n_words"), none).alias("n_words"),
        F.coalesce(F.sum("n_docs"), none).alias("n_docs"),
    )


def index_from_documents(documents: DataFrame, docs_per_block: int = DOCS_PER_BLOCK) -> Index:
    """Index computed in the plan from a document table, nothing stored."""
    postings = document_terms(documents)
    return Index(documents, postings, vocabulary(postings), docs_per_block)
