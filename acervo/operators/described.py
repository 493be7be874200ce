"""Postings with what the index holds on their documents and terms."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from acervo.operators.index import Index
from acervo.schemas import DESCRIBED, PACKED
from acervo.session import batches_of_rows, written

GROUPS_PER_CELL = 4  # of blocks, whose documents a cell has
SHARES = 8  # cells that a run of such groups is dealt to, by buckets of terms
BYTES_PACKED = 1 << 22  # of rows that a task packs together
ROWS_AT_ONCE = 1 << 15  # that go to Spark in one batch
MAX_CELLS = 16_384  # tasks; beyond, a task takes several cells
POSTING_BYTES = 24
DOCUMENTS, TERMS, LISTS = range(3)  # what the rows of a cell hold, in the order they are needed


def described_postings(index: Index) -> DataFrame:
    """``(term, doc_id, tf, norm, document_norm, url, df)``: every posting joined to its document and its term.

    Joins by ``doc_id`` and by ``term`` would move all postings twice, one to a row. Where they are stored in lists, these are
    packed as Arrow data and move once, to a cell for some groups of blocks and a share of the buckets of terms, and are laid out there.
    A cell has the documents of its groups, packed too, and those terms of the vocabulary that occur in it, so no term or
    document gathers its postings from several cells. Packs of lists and terms are written first, so that what was moved
    for them is gone when they meet.
    """
    of_document = ["doc_id", F.col("norm").alias("document_norm"), "url"]
    terms = index.vocabulary.select("term", "df")
    if index.lists is None:
        return index.postings.join(index.documents.select(*of_document), "doc_id").join(terms, "term").select(*DESCRIBED.names)
    shares = min(SHARES, index.term_buckets)
    run = F.call_function("div", F.col("from_doc_block"), F.lit(index.blocks_per_group * GROUPS_PER_CELL).cast("long"))
    cell = (run * shares + F.pmod("term_bucket", F.lit(shares).cast("long"))).cast("int").alias("cell")
    tasks = min(-(-max(1, len(index.bounds)) // GROUPS_PER_CELL) * shares, MAX_CELLS)
    with batches_of_rows(index.documents.sparkSession, _widest_list(index)):
        of_posting = [F.col("postings")[name].alias(name) for name in ("doc_id", "tf", "norm")]
        lists = index.lists.filter("postings is not null").select(cell, "term", *of_posting)
        lists = written(lists.mapInArrow(_pack_lists, PACKED), "lists")
        # Terms are told by their hash until the lists see them: one of equal hash is a row too many in a cell and meets no list.
        # They are dealt at once, for the join too, as tasks that read them hold few of a cell's lists of a term.
        hashed = F.xxhash64("term").alias("hash")
        of_cells = index.lists.select(hashed, cell).repartition("hash").distinct()
        of_cells = of_cells.join(terms.withColumn("hash", hashed).hint("shuffle_hash"), "hash")
        of_cells = of_cells.select("cell", "term", "df").repartitionById(tasks, F.col("cell") % tasks)
        of_cells = written(of_cells.sortWithinPartitions("cell").mapInArrow(_pack_rows, PACKED), "terms")
    runs = index.documents.select(run.cast("int").alias("cell"), *of_document).mapInArrow(_pack_rows, PACKED)
    share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    runs = runs.withColumn("share", share).select((F.col("cell") * shares + F.col("share")).alias("cell"), "packed")
    first, *others = (rows.withColumn("kind", F.lit(kind)) for kind, rows in ((DOCUMENTS, runs), (TERMS, of_cells), (LISTS, lists)))
    dealt = reduce(DataFrame.unionByName, others, first).repartitionById(tasks, F.col("cell") % tasks)
    return dealt.sortWithinPartitions("cell", "kind").select("cell", "kind", "packed").mapInArrow(_meet, DESCRIBED)


def _widest_list(index: Index) -> int:
    """Bytes of a term and of postings that no list exceeds."""
    longest = index.vocabulary.agg(F.max(F.octet_length("term"))).first()[0]
    most = index.documents.groupBy("doc_block").count().agg(F.max("count")).first()[0]
    return (longest or 0) + POSTING_BYTES * (most or 0) + POSTING_BYTES


def _same(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Beginnings and ends of the runs of equal keys."""
    return pairwise(np.flatnonzero(np.concatenate(([True], np.diff(keys) != 0, [True])))) if len(keys) else iter(())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Cells and their rows from ``(cell, ...)``, as many as follow each other, up to about ``BYTES_PACKED``."""
    cell, waiting, size = None, [], 0
    for batch in batches:
        cells = batch.column(0).to_numpy()
        for start, stop in _same(cells):
            if waiting and (cells[start] != cell or size >= BYTES_PACKED):
                yield cell, pa.Table.from_batches(waiting)
                waiting, size = [], 0
            cell = int(cells[start])
            waiting.append(batch.slice(start, stop - start))
            size += waiting[-1].nbytes
    if waiting:
        yield cell, pa.Table.from_batches(waiting)


def _packed(cell: int, table: pa.Table) -> pa.RecordBatch:
    """A row of ``PACKED``."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    columns = [pa.array([cell], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, PACKED.names)


def _unpacked(packed: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(packed.as_buffer()).read_all()


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``PACKED`` from ``(cell, ...)``."""
    for cell, rows in _runs(batches):
        yield _packed(cell, rows.drop_columns("cell"))


def _pack_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``PACKED`` from ``(cell, term, doc_id, tf, norm)``, the last three by posting: ids and norms that repeat are stored once."""
    for cell, rows in _runs(batches):
        sizes = pc.list_value_length(rows["tf"]).combine_chunks()
        ids, tf, norms = (pc.list_flatten(rows[name]).combine_chunks() for name in ("doc_id", "tf", "norm"))
        ids, norms, places = _distinct(ids, norms)
        columns = {
            "term": rows["term"].combine_chunks(),
            "size": sizes,
            "place": _narrow(places),
            "tf": _narrow(tf),
            "doc_id": ids,
            "norm": norms,
        }
        one_row = {name: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for name, c in columns.items()}
        yield _packed(cell, pa.table(one_row))


def _distinct(ids: pa.Array, norms: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The distinct pairs of an id and a norm, and the place of each posting's pair among them."""
    found = ids.dictionary_encode("encode")
    if not norms.null_count:
        # A document has one norm in an index as it was saved.
        of_id, at, bits = np.empty(len(found.dictionary), np.int64), found.indices.to_numpy(), norms.view(pa.int64()).to_numpy()
        of_id[at] = np.arange(len(at))
        if (bits[of_id][at] == bits).all():
            return found.dictionary, norms.take(pa.array(of_id)), found.indices
    of_norm = norms.dictionary_encode("encode")
    n_norms = max(1, len(of_norm.dictionary))
    pairs = pa.array(found.indices.to_numpy().astype(np.int64) * n_norms + of_norm.indices.to_numpy()).dictionary_encode()
    id_place, norm_place = np.divmod(pairs.dictionary.to_numpy(), n_norms)
    return found.dictionary.take(pa.array(id_place)), of_norm.dictionary.take(pa.array(norm_place)), pairs.indices


def _narrow(numbers: pa.Array) -> pa.Array:
    """Numbers of 0 or more in the narrowest type that holds them."""
    return numbers.cast(pa.from_numpy_dtype(np.min_scalar_type(pc.max(numbers).as_py() or 0)))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``DESCRIBED`` from ``(cell, kind, packed)`` by rising cell and kind."""
    current, held, met = None, {}, None
    for batch in batches:
        for cell, kind, packed in zip(*(column.to_pylist() for column in batch.columns[:2]), batch.column(2)):
            if cell != current:
                current, held, met = cell, {DOCUMENTS: [], TERMS: []}, None
            if kind != LISTS:
                held[kind].append(_unpacked(packed))
            elif held[DOCUMENTS] and held[TERMS]:
                met = met or _Cell(held[DOCUMENTS], held[TERMS])
                yield from met.described(_unpacked(packed))


class _Cell:
    """The documents of a cell by rising id, and its terms."""

    def __init__(self, documents: list[pa.Table], terms: list[pa.Table]):
        rows = pa.concat_tables(documents)
        rows = rows.filter(pc.is_valid(rows["doc_id"])).sort_by("doc_id").combine_chunks()
        self.ids = rows["doc_id"].to_numpy()
        self.norms, self.urls = (_whole(rows[name]) for name in ("document_norm", "url"))
        found = pa.concat_tables(terms)
        self.terms, self.df = _whole(found["term"]), _whole(found["df"])

    def described(self, packed: pa.Table) -> Iterator[pa.RecordBatch]:
        """``DESCRIBED`` of the lists of a row of ``_pack_lists``."""
        terms, sizes, places, tf, ids, norms = (pc.list_flatten(_whole(column)) for column in packed.columns)
        known, of_place = pc.is_valid(ids).to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
        first = np.searchsorted(self.ids, of_place)
        n_found = np.where(known, np.searchsorted(self.ids, of_place, side="right") - first, 0)
        of_term = pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy()
        owners, places = np.repeat(np.arange(len(terms)), sizes.to_numpy()), places.to_numpy()
        # Ids may repeat among the documents.
        times = np.where(of_term[owners] >= 0, n_found[places], 0)
        ends = np.cumsum(times)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + ROWS_AT_ONCE, side="right")))
            posting = np.repeat(np.arange(start, stop), times[start:stop])
            nth = np.arange(len(posting)) - np.repeat(ends[start:stop] - times[start:stop] - before, times[start:stop])
            own, place = owners[posting], places[posting]
            document, place = pa.array(first[place] + nth), pa.array(place)
            columns = [
                terms.take(pa.array(own)),
                ids.take(place),
                tf.take(pa.array(posting)).cast(pa.int64()),
                norms.take(place),
                self.norms.take(document),
                self.urls.take(document),
                self.df.take(pa.array(of_term[own])),
            ]
            yield pa.RecordBatch.from_arrays(columns, DESCRIBED.names)
            start = stop


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
