"""Scores and the ranked top n.

A query word counts wherever it occurs as a substring of the normalised text.
Words contain no space and the text is tokens joined by single spaces, so no
occurrence crosses a token: counting in the vocabulary once and weighting by
term frequencies gives the same numbers without reading a text.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from acervo.operators.index import ROWS_AT_ONCE, Index, term_bucket, term_buckets_of
from acervo.operators.query_table import MASK_BITS
from acervo.schemas import GRAM_LISTS, GRAMS

PIECE_LENGTH = 64
FEW_WORDS = 32
GRAM = 3
TERMS_AT_ONCE = 1 << 16  # whose grams a task puts in the order of the store


def occurrences(text: Column, word: Column) -> Column:
    """Non-overlapping occurrences of ``word`` in ``text``."""
    gone = F.length(text) - F.length(F.replace(text, word, F.lit("")))
    return F.call_function("div", gone.cast("long"), F.length(word).cast("long"))


def expand_words(vocabulary: DataFrame, words: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``(term, word, occ, as_typed, exact)`` for all terms containing a word.

    ``words(word)`` is joined by equality with the substrings of each term that
    have the length of some word, so no word is compared with every term. A
    term of ordinary length is cut up as it is and a match kept where it
    occurs first. Very long tokens are cut into overlapping pieces that travel
    without the token, which is joined back to the few words found.
    """
    lengths = sorted(set(lengths)) or [1]
    terms = vocabulary.select("term")
    is_long = F.length("term") > PIECE_LENGTH
    lowered = words.select("word", F.lower("word").alias("gram"))

    short = terms.filter(~is_long).filter(F.length("term") > 0)
    in_short = (
        _cuts(short.withColumn("text", F.col("term")), "length(text)", lengths, "term")
        .join(lowered, "gram")
        .filter(F.instr(F.col("term"), F.col("gram")) == F.col("at"))
        .select("term", "word", "gram")
    )

    long = terms.filter(is_long).withColumn("token", F.xxhash64("term"))
    pieces = long.select(
        "token",
        F.explode(
            F.expr(
                f"transform(sequence(1, length(term), {PIECE_LENGTH}),"
                f" p -> substring(term, p, {PIECE_LENGTH + lengths[-1] - 1}))"
            )
        ).alias("text"),
    )
    in_pieces = (
        _cuts(pieces, f"least(length(text), {PIECE_LENGTH})", lengths, "token")
        .join(lowered, "gram")
        .select("token", "word", "gram")
        .distinct()
    )
    in_long = (
        long.join(in_pieces, "token")
        .filter(F.contains(F.col("term"), F.col("gram")))
        .select("term", "word", "gram")
    )
    return _expansion(in_short.unionByName(in_long), "term")


def _cuts(rows: DataFrame, starts: str, lengths: Sequence[int], key: str) -> DataFrame:
    """``(key, at, gram)``: the substrings of ``text`` with one of the lengths that
    start at one of the first ``starts`` characters."""
    return (
        rows.select(key, "text", F.explode(F.expr(f"sequence(1, {starts})")).alias("at"))
        .select(key, "text", "at", F.explode(F.array(*(F.lit(n) for n in lengths))).alias("n"))
        # Near the end a shorter word must not be found as the rest of a longer cut.
        .filter(F.expr("at + n - 1 <= length(text)"))
        .select(key, "at", F.expr("substring(text, at, n)").alias("gram"))
    )


def term_grams(vocabulary: DataFrame, buckets: int) -> DataFrame:
    """``GRAMS``: the rows of ``gram_lists`` with one term to a row."""
    return flat_grams(gram_lists(vocabulary, buckets)).select(*GRAMS.names)


def flat_grams(lists: DataFrame) -> DataFrame:
    """One term to a row, with its hash as ``token``, from rows with the columns of ``GRAM_LISTS``."""
    others = [c for c in lists.columns if c not in ("n_terms", "terms", "token")]
    rows = lists.select(*others, "token", F.explode_outer("terms").alias("term"))
    return rows.withColumn("token", F.coalesce("token", F.xxhash64("term")))


def gram_lists(vocabulary: DataFrame, buckets: int) -> DataFrame:
    """``GRAM_LISTS``: the distinct cuts of ``GRAM`` characters of every term, with the buckets they are stored in.

    Near a term's end the cuts are shorter, so each character begins one and a word of
    fewer characters is found by the beginnings of grams. Very long tokens are cut in
    overlapping pieces and told by their hash alone, without ``terms``. Others are cut in
    Arrow batches where they lie, and listed by gram, by rising bucket and gram in steps of ``TERMS_AT_ONCE`` terms.
    """
    terms = vocabulary.select("term").filter(F.length("term") > 0)
    is_long = F.length("term") > PIECE_LENGTH
    short = terms.filter(~is_long).mapInArrow(partial(_cut_terms, buckets=buckets), GRAM_LISTS)
    pieces = terms.filter(is_long).select(
        F.xxhash64("term").alias("token"),
        F.explode(
            F.expr(
                f"transform(sequence(1, length(term), {PIECE_LENGTH}),"
                f" p -> substring(term, p, {PIECE_LENGTH + GRAM - 1}))"
            )
        ).alias("text"),
    )
    cuts = f"array_distinct(transform(sequence(1, least(length(text), {PIECE_LENGTH})), p -> substring(text, p, {GRAM})))"
    long = pieces.select(F.explode(F.expr(cuts)).alias("gram"), "token").distinct()
    held = gram_bucket(F.col("gram"), buckets).alias("gram_bucket")
    none = F.lit(None).cast(GRAM_LISTS["terms"].dataType).alias("terms")
    return short.unionByName(long.select("gram", F.lit(1).cast("long").alias("n_terms"), none, "token", held))


def _cut_terms(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """``GRAM_LISTS`` from ``(term)``."""
    waiting, n_waiting = [], 0
    for batch in batches:
        waiting.append(batch)
        n_waiting += len(batch)
        if n_waiting >= TERMS_AT_ONCE:
            yield from _grams_of(waiting, buckets)
            waiting, n_waiting = [], 0
    if n_waiting:
        yield from _grams_of(waiting, buckets)


def _grams_of(batches: list[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    terms = pa.Table.from_batches(batches).column(0).combine_chunks()
    lengths = pc.utf8_length(terms).to_numpy()
    owners = [np.flatnonzero(lengths > at) for at in range(lengths.max())]
    cuts = [pc.utf8_slice_codeunits(terms.take(pa.array(own)), at, at + GRAM) for at, own in enumerate(owners)]
    found = pa.concat_arrays(cuts).dictionary_encode()
    grams, held = found.dictionary, term_buckets_of(found.dictionary, buckets)
    order = pc.sort_indices(grams).to_numpy()
    order = order[np.argsort(held[order], kind="stable")]
    ranks = np.empty(len(grams), dtype=np.int64)
    ranks[order] = np.arange(len(grams))
    keys = np.unique(ranks[found.indices.to_numpy()] * len(terms) + np.concatenate(owners))
    rank, own = np.divmod(keys, len(terms))
    first = np.flatnonzero(np.diff(rank, prepend=-1))
    ends = np.append(first, len(keys))
    of_gram = order[rank[first]]
    columns = {
        "gram": grams.take(pa.array(of_gram)),
        "n_terms": pa.array(np.diff(ends)),
        "terms": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms.take(pa.array(own))),
        "token": pa.nulls(len(first), pa.int64()),
        "gram_bucket": pa.array(held[of_gram]),
    }
    yield from pa.table(columns).select(GRAM_LISTS.names).to_batches(ROWS_AT_ONCE)


def gram_bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets).cast("long"))


def word_grams(gram_counts: DataFrame, words: DataFrame) -> DataFrame:
    """``(word, text, gram)``: where the terms containing each of ``words(word)`` are looked up.

    A word of ``GRAM`` characters or more has one row, the gram that the fewest terms
    have; a shorter one has a row for each gram that begins with it.
    """
    lowered = words.select("word", F.lower("word").alias("text")).filter(F.length("text") > 0)
    is_short = F.length("text") < GRAM
    cuts = f"array_distinct(transform(sequence(1, length(text) - {GRAM - 1}), p -> substring(text, p, {GRAM})))"
    inside = lowered.filter(~is_short).select("word", "text", F.explode(F.expr(cuts)).alias("gram"))
    rarest = F.min(F.struct(F.coalesce("n_terms", F.lit(0)).alias("n_terms"), "gram"))
    whole = (
        inside.join(gram_counts, "gram", "left")
        .groupBy("word", "text")
        .agg(rarest.alias("least"))
        .select("word", "text", "least.gram")
    )
    # A gram has one beginning of each length, so this is a join by equality too.
    beginnings = F.explode(F.array(*(F.substring("gram", 1, n) for n in range(1, GRAM))))
    heads = gram_counts.select("gram", beginnings.alias("text")).distinct()
    return whole.unionByName(lowered.filter(is_short).join(heads, "text").select("word", "text", "gram"))


def expand_by_grams(index: Index, looked_up: DataFrame) -> DataFrame:
    """The same rows as ``expand_words``, from the stored grams that ``looked_up(word, text, gram)`` names.

    Only terms with a word's gram are read and tested for the word.
    """
    keys = ["gram"]
    if index.term_buckets:
        # True of every row; it lets Spark prune the grams' partitions by a broadcast.
        looked_up = looked_up.filter("word is not null").withColumn(
            "gram_bucket", gram_bucket(F.col("gram"), index.term_buckets)
        )
        keys = ["gram_bucket", "gram"]
    # Very long tokens have rows of their own, which a scan finds by their statistics.
    if index.gram_lists is None:
        met = index.grams.filter("term is not null").join(looked_up, keys)
        met_long = index.grams.filter("term is null").join(looked_up, keys)
    else:
        met = flat_grams(index.gram_lists.filter("token is null").join(looked_up, keys))
        met_long = index.gram_lists.filter("token is not null").join(looked_up, keys)
    # Of the grams of a term that begin with a short word, the first one counts.
    at_first = F.substring(F.col("term"), F.instr(F.col("term"), F.col("text")), F.lit(GRAM)) == F.col("gram")
    in_short = (
        met.filter(F.contains("term", "text"))
        .filter((F.length("text") >= GRAM) | at_first)
        .select("term", "word", F.col("text").alias("gram"))
    )
    long = index.vocabulary.select("term").filter(F.length("term") > PIECE_LENGTH)
    in_long = (
        long.withColumn("token", F.xxhash64("term"))
        .join(met_long.select("token", "word", "text").distinct(), "token")
        .filter(F.contains("term", "text"))
        .select("term", "word", F.col("text").alias("gram"))
    )
    return _expansion(in_short.unionByName(in_long), "term")


def expand_few_words(rows: DataFrame, words: Sequence[str]) -> DataFrame:
    """``rows(term, ...)`` with the columns of ``expand_words`` for a handful of
    words, tested as constants on every row."""
    pairs = [F.struct(F.lit(w).alias("word"), F.lower(F.lit(w)).alias("gram")) for w in words]
    inside = F.filter(F.array(*pairs), lambda w: F.contains(F.col("term"), w["gram"]))
    any_inside = reduce(
        operator.or_, (F.contains(F.col("term"), F.lower(F.lit(w))) for w in words)
    )
    found = (
        rows.filter(any_inside)
        .select("*", F.explode_outer(inside).alias("w"))
        .select(*rows.columns, F.col("w.word").alias("word"), F.col("w.gram").alias("gram"))
        .filter(F.col("word").isNotNull())
    )
    return _expansion(found, *rows.columns)


def _expansion(found: DataFrame, *columns: str) -> DataFrame:
    return found.select(
        *columns,
        "word",
        occurrences(F.col("term"), F.col("gram")).alias("occ"),
        F.contains("term", "word").alias("as_typed"),
        (F.col("term") == F.col("word")).alias("exact"),
    )


def expanded_postings(index: Index, expansion: DataFrame, needed: DataFrame | None = None) -> DataFrame:
    """Postings of the terms in ``expansion``, once per word they contain.

    With ``needed(word, ...)`` and the index' ``block_keys``, of these blocks only. Lists are met as a whole.
    """
    return index.flat(_needed(index, _met(index, index.term_rows, expansion), needed))


def few_words_postings(index: Index, words: Sequence[str], needed: DataFrame | None = None) -> DataFrame:
    """The same for a handful of words, tested on the postings where they lie."""
    return index.flat(_needed(index, expand_few_words(index.term_rows, words), needed))


def _needed(index: Index, rows: DataFrame, needed: DataFrame | None) -> DataFrame:
    return rows if needed is None else rows.join(needed, ["word", *index.block_keys], "left_semi")


def word_tops(index: Index, expansion: DataFrame) -> DataFrame:
    """``(word, doc_block, top)``: what no document of the block exceeds in occurrences of the word per norm.

    A document's ``tf / norm`` are at most the tops of its terms, and their squares sum to one
    at most, so the occurrences are bounded by the sum of the tops and by the length of the
    vector of occurrences per term.
    """
    occ = F.col("occ").cast("double")
    bound = F.least(F.sum(occ * F.col("top")), F.sqrt(F.sum(occ * occ)))
    return _met(index, index.term_blocks, expansion).groupBy("word", "doc_block").agg(bound.alias("top"))


def block_limits(tops: DataFrame, words: DataFrame) -> DataFrame:
    """``(query_id, doc_block, most)``: a score that no document of the block exceeds for the query.

    A score divides by the length of the matched words' weights, which is at least the
    smallest of them. The last factor covers the rounding of the sums.
    """
    most = F.sum(F.col("repeats") * F.col("top")) / F.min("repeats") * (1 + 1e-9)
    return tops.join(words, "word").groupBy("query_id", "doc_block").agg(most.alias("most"))


def _met(index: Index, rows: DataFrame, expansion: DataFrame) -> DataFrame:
    """The rows of a table by term, once per word that their term contains."""
    # A condition on the small side, true of every row, lets Spark turn the
    # broadcast into a filter on the table's partitions.
    expansion = expansion.filter("occ > 0")
    keys = ["term"]
    if index.term_buckets:
        bucketed = term_bucket(F.col("term"), index.term_buckets)
        expansion = expansion.withColumn("term_bucket", bucketed)
        keys = ["term_bucket", "term"]
    return rows.join(expansion, keys)


def word_matches(expanded: DataFrame, *of_document: str) -> DataFrame:
    """``(doc_id, word, tf, norm, as_typed, exact)``: the one shuffle of matched postings.

    More columns, of which a document has one value, may be kept.

    Rows are hashed by ``doc_id`` alone, so this aggregate and the one per query
    run on the same partitioning, and no frequent word gathers in one task.
    """
    return (
        expanded.select(
            "doc_id", "word", (F.col("tf") * F.col("occ")).alias("n"), "norm", "as_typed", "exact", *of_document
        )
        .repartition("doc_id")
        .groupBy("doc_id", "word")
        .agg(
            F.sum("n").alias("tf"),
            F.max("norm").alias("norm"),
            F.max("as_typed").alias("as_typed"),
            F.max("exact").alias("exact"),
            *(F.max(c).alias(c) for c in of_document),
        )
    )


def mask_columns(n_lanes: int) -> list[str]:
    return [f"mask_{lane}" for lane in range(n_lanes)]


def query_matches(
    matches: DataFrame, words: DataFrame, mask_names: list[str], keys: Sequence[str] = ("word",)
) -> DataFrame:
    """``(query_id, doc_id, tf, norm, squares, mask_0, ...)`` from per-word matches.

    ``words(query_id, word, word_no, repeats)``; the masks hold one bit per
    word found as an exact token. With ``doc_block`` as a further key, a query has
    its words only in the blocks that are searched for it.
    """
    one = F.lit(1).cast("long")
    masks = []
    for lane, name in enumerate(mask_names):
        offset = F.col("word_no") - lane * MASK_BITS
        in_lane = F.col("exact") & (offset >= 0) & (offset < MASK_BITS)
        bit = F.call_function("shiftleft", one, F.greatest(offset, F.lit(0)))
        masks.append(F.bit_or(F.when(in_lane, bit).otherwise(one - one)).alias(name))
    return (
        matches.join(words, list(keys))
        .groupBy("query_id", "doc_id")
        .agg(
            F.sum(F.col("repeats") * F.col("tf")).alias("tf"),
            F.max("norm").alias("norm"),
            F.sum(
                F.when(F.col("as_typed"), F.col("repeats") * F.col("repeats")).otherwise(one - one)
            ).alias("squares"),
            *masks,
        )
    )


def score(tf: Column, squares: Column, norm: Column) -> Column:
    """Occurrences over document norm times norm of the matched query words."""
    return F.when(
        squares > 0, tf.cast("double") / (norm * F.sqrt(squares.cast("double")))
    ).otherwise(F.lit(0.0))


def top_n(scored: DataFrame, n: int) -> DataFrame:
    """The best ``n`` rows per query, ties by rising id.

    Spark cuts every task's rows to ``n`` per query before the shuffle.
    """
    if n < 0:
        raise ValueError("the number of results must not be negative")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n)
