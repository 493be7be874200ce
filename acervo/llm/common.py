"""Helpers that several operators share: words of a text, stored tables, clean-text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from acervo.session import scratch_path


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, with A-Z lower-cased."""
    return text.lower().split() if text else []


def texts(column: pa.Array | pa.ChunkedArray, rows: int = 500) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, nulls kept; few texts at a time are copied."""
    for start in range(0, len(column), rows):
        yield from column.slice(start, rows).cast(pa.binary()).to_pylist()


def stored(df: DataFrame, name: str, compression: str = "uncompressed") -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage.

    Tables of numbers are not compressed: codecs take memory outside the heap for
    every file, and rounds of joins over many partitions write many small files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def free_name(columns: list[str], name: str) -> str:
    """``name`` with as many underscores before it as keep it apart from ``columns``, whatever their case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def holds_map(kind: T.DataType) -> bool:
    """Whether a type is a map or has one inside."""
    if isinstance(kind, T.StructType):
        return any(holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and holds_map(kind.elementType)


def row_key(schema: T.StructType) -> list[Column]:
    """Two hashes that name a row by its content; equal rows share them. Maps, which cannot be hashed, count as their JSON text."""
    quoted = [F.to_json(F.struct(F.col(f"`{f.name}`").alias("m"))) if holds_map(f.dataType) else F.col(f"`{f.name}`") for f in schema.fields]
    return [F.xxhash64(*quoted), F.xxhash64(F.lit(1), *quoted)]


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` with the fields of ``ddl`` after its own."""
    return T.StructType([*schema.fields, *T.DataType.fromDDL(ddl).fields])


def through_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for tables whose columns have any name, a dot or a clash in it included."""
    names = [f"c{i}" for i in range(len(schema))]
    plain = T.StructType([T.StructField(name, field.dataType) for name, field in zip(names, schema.fields)])

    def renamed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(parts):
            yield pa.RecordBatch.from_arrays(batch.columns, names)

    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(renamed, plain).toDF(*schema.names)


def runs(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows with equal values in the first ``keys`` columns of sorted batches, each run as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in parts:
        if not len(batch):
            continue
        own = [batch.column(i).to_numpy() for i in range(keys)]
        edges = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in own])) + 1
        edges = [0, *edges.tolist(), len(batch)]
        if held and last != tuple(x[0] for x in own):
            yield pa.concat_batches(held)
            held = []
        last = tuple(x[-1] for x in own)
        for a, b in zip(edges, edges[1:-1]):
            yield pa.concat_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(edges[-2]))
    if held:
        yield pa.concat_batches(held)
