"""Explicit schemas of every table the package reads; nothing is inferred."""

from pyspark.sql import types as T

RAW_PAGES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

STORED_PAGES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        *RAW_PAGES.fields,
        T.StructField("seq", T.LongType()),
    ]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("links", T.ArrayType(T.StringType())),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
    ]
)

QUERIES = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("line", T.StringType()),
    ]
)

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("snippet", T.StringType()),
        T.StructField("norm", T.DoubleType()),
        T.StructField("doc_block", T.LongType()),
        T.StructField("from_doc_block", T.LongType()),
    ]
)

POSTINGS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("tf", T.LongType()),
        T.StructField("norm", T.DoubleType()),
        T.StructField("doc_block", T.LongType()),
        T.StructField("term_bucket", T.LongType()),
        T.StructField("from_doc_block", T.LongType()),
    ]
)

TERM_BLOCKS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("doc_block", T.LongType()),
        T.StructField("df", T.LongType()),
        T.StructField("cf", T.LongType()),
        T.StructField("top", T.DoubleType()),
        T.StructField("term_bucket", T.LongType()),
    ]
)

# Figures of terms by block with the block's postings, as they are stored where blocks are grouped. A block that is
# counted in several steps has rows without figures, and one per term without postings.
LISTS = T.StructType(
    [
        *TERM_BLOCKS.fields[:5],
        T.StructField("postings", T.ArrayType(T.StructType(POSTINGS.fields[1:4]))),
        *POSTINGS.fields[5:],
    ]
)

# The same with one posting or figure to a row.
COUNTED = T.StructType(
    [
        *POSTINGS.fields[:5],
        *TERM_BLOCKS.fields[2:5],
        T.StructField("is_figure", T.BooleanType()),
        *POSTINGS.fields[5:],
    ]
)

# Postings with their documents and terms, and rows of one cell of that join in Arrow's format.
DESCRIBED = T.StructType(
    [
        *POSTINGS.fields[:4],
        T.StructField("document_norm", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("df", T.LongType()),
    ]
)

PACKED = T.StructType(
    [
        T.StructField("cell", T.IntegerType()),
        T.StructField("packed", T.BinaryType()),
    ]
)

VOCABULARY = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("df", T.LongType()),
        T.StructField("cf", T.LongType()),
    ]
)

GRAMS = T.StructType(
    [
        T.StructField("gram", T.StringType()),
        T.StructField("token", T.LongType()),
        T.StructField("term", T.StringType()),
        T.StructField("gram_bucket", T.LongType()),
    ]
)

# Grams as they are stored: the terms of a gram in lists, very long ones by their hash in rows of their own.
GRAM_LISTS = T.StructType(
    [
        T.StructField("gram", T.StringType()),
        T.StructField("n_terms", T.LongType()),
        T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("token", T.LongType()),
        T.StructField("gram_bucket", T.LongType()),
    ]
)

GRAM_COUNTS = T.StructType(
    [
        T.StructField("gram", T.StringType()),
        T.StructField("n_terms", T.LongType()),
    ]
)

INDEX_MANIFEST = "folder string, n_words long, n_docs long, term_buckets long, docs_per_block long, n_blocks long, blocks_per_group long, bounds array<long>, in_one boolean, in_lists boolean, grams_in_lists boolean"
