"""Single and batch searches over an index."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from acervo.operators import query_table as qt
from acervo.operators import rank as rk
from acervo.operators.boolean import fetch_documents
from acervo.operators.index import Index
from acervo.schemas import QUERIES
from acervo.session import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    cut_lineage,
    is_small,
)

DEFAULT_RESULTS = 10
SEED_BLOCKS = 4  # blocks per query that are searched before the others' limits are compared
SCANNED_TERMS = 10_000_000  # up to here a handful of words is tested on every term; a guess, at 0.3 M terms the scan is faster


class InvalidQuery(ValueError):
    """A strict search met a query that cannot be evaluated."""


@dataclass(frozen=True)
class Batch:
    """Distinct valid queries of one search and the figures planning needs."""

    programs: DataFrame
    words: DataFrame
    n_queries: int
    n_words: int
    most_words: int
    lengths: list[int]
    any_true_without_match: bool
    is_small: bool
    few_words: list[str] | None

    @property
    def masks(self) -> list[str]:
        return rk.mask_columns((self.most_words + qt.MASK_BITS - 1) // qt.MASK_BITS)

    def hinted(self, df: DataFrame) -> DataFrame:
        """A table of at most one row per query word, broadcast if the batch is small."""
        return F.broadcast(df) if self.is_small else df


def one_query(spark: SparkSession, line: str) -> DataFrame:
    return spark.createDataFrame([(0, line)], QUERIES)


def rejected_queries(queries: DataFrame) -> DataFrame:
    return (
        qt.query_table(queries)
        .filter(~F.col("valid"))
        .select("query_id", "line", "reason")
    )


def prepare_batch(queries: DataFrame, strict: bool = False) -> Batch:
    """Tokenise, validate and number the words of a batch.

    The driver receives one row of figures, and the words only of a batch with
    a handful of them.
    """
    programs = cut_lineage(qt.query_programs(qt.query_table(queries)))
    first = F.col("word_no") == 0
    none = F.lit(0).cast("long")
    facts = (
        programs.select(
            "n_lines",
            "n_words",
            "true_without_match",
            F.octet_length(F.array_join("tokens", " ")).alias("n_bytes"),
            F.posexplode("words").alias("word_no", "word"),
        )
        .agg(
            F.sum(F.when(first, F.col("n_lines")).otherwise(none)).alias("n_lines"),
            F.coalesce(F.sum(first.cast("long")), none).alias("n_queries"),
            F.max("n_words").alias("most_words"),
            F.count(F.lit(1)).alias("n_words"),
            F.coalesce(F.sum(F.when(first, F.col("n_bytes"))), none).alias("n_bytes"),
            F.max("true_without_match").alias("complement"),
            F.collect_set(F.length(F.lower("word"))).alias("lengths"),
        )
        .first()
    )
    if strict and (facts["n_lines"] or 0) < queries.count():
        bad = rejected_queries(queries).first()
        raise InvalidQuery(f"{bad['reason']}: {bad['line']!r}")
    # A program holds its tokens a few times over and up to 2^8 truth values.
    n_bytes = 8 * facts["n_bytes"] + 256 * facts["n_queries"]
    words = qt.program_words(programs)
    few_words = None
    if 0 < facts["n_words"] <= rk.FEW_WORDS:
        few_words = [row["word"] for row in words.select("word").distinct().collect()]
    return Batch(
        programs=programs,
        words=words,
        n_queries=facts["n_queries"],
        n_words=facts["n_words"],
        most_words=facts["most_words"] or 1,
        lengths=facts["lengths"],
        any_true_without_match=bool(facts["complement"]),
        is_small=facts["n_words"] <= MAX_BROADCAST_ROWS and n_bytes <= MAX_BROADCAST_BYTES,
        few_words=few_words,
    )


def expand_batch(index: Index, batch: Batch) -> DataFrame:
    """Vocabulary terms containing a word of the batch, computed once and kept.

    A stored index is asked by the rarest gram of each word; for a handful of words a
    vocabulary of moderate size is read instead, which gives the same rows in one job.
    """
    if index.grams is not None and not (batch.few_words and index.n_words <= SCANNED_TERMS):
        return cut_lineage(expand_by_lookup(index, batch.words.select("word").distinct()))
    if batch.few_words:
        return cut_lineage(rk.expand_few_words(index.vocabulary.select("term"), batch.few_words))
    words = batch.hinted(batch.words.select("word").distinct())
    return cut_lineage(rk.expand_words(index.vocabulary, words, batch.lengths))


def expand_by_lookup(index: Index, words: DataFrame) -> DataFrame:
    """Vocabulary terms containing one of ``words(word)``, by the stored grams, which stay where they are if the words are few."""
    looked_up = cut_lineage(rk.word_grams(index.gram_counts, words))
    return rk.expand_by_grams(index, F.broadcast(looked_up) if is_small(looked_up) else looked_up)


def batch_matches(
    index: Index, batch: Batch, expansion: DataFrame, needed: DataFrame | None = None, with_block: bool = False
) -> DataFrame:
    """Matches per document and word, by the cheapest way the sizes allow.

    A small expansion goes to the postings as a broadcast. When a few short
    words are inside too many terms for that, they are tested on the postings
    where they lie, which spares a shuffle of all postings. Otherwise the two
    are joined by hash. With ``needed(word, doc_block)``, and the index' ``block_keys``, a word is looked for in
    these blocks only. The blocks are kept then, and ``with_block``.
    """
    if is_small(expansion):
        expanded = rk.expanded_postings(index, F.broadcast(expansion), needed)
    elif batch.few_words:
        expanded = rk.few_words_postings(index, batch.few_words, needed)
    else:
        expanded = rk.expanded_postings(index, expansion, needed)
    return rk.word_matches(expanded, *(["doc_block"] if with_block or needed is not None else []))


def scored_documents(
    index: Index, batch: Batch, expansion: DataFrame, chosen: DataFrame | None = None
) -> DataFrame:
    """Every document with an occurrence of some query word, per query:
    ``(query_id, doc_id, score, is_match)``.

    With a stored ``chosen(query_id, doc_block)``, of these blocks only.
    """
    if chosen is None:
        matches = batch_matches(index, batch, expansion)
        per_query = rk.query_matches(matches, batch.hinted(batch.words), batch.masks)
    else:
        held = F.broadcast if is_small(chosen) else lambda df: df
        # True of every row; it lets Spark prune the postings' partitions by a broadcast.
        words = cut_lineage(index.with_partition(batch.words.join(held(chosen), "query_id")))
        words = words.filter(F.col(index.partition) >= 0)
        held = F.broadcast if is_small(words) else lambda df: df
        needed = held(words.select("word", *index.block_keys).distinct())
        matches = batch_matches(index, batch, expansion, needed)
        per_query = rk.query_matches(matches, held(words), batch.masks, ["word", "doc_block"])
    programs = batch.programs.select("query_id", "program", "truth_table")
    return (
        per_query.join(batch.hinted(programs), "query_id")
        .select(
            "query_id",
            "doc_id",
            rk.score(F.col("tf"), F.col("squares"), F.col("norm")).alias("score"),
            qt.query_true(batch.masks, batch.most_words).alias("is_match"),
        )
    )


def best_matches(
    index: Index, batch: Batch, expansion: DataFrame, n: int, chosen: DataFrame | None = None
) -> DataFrame:
    scored = scored_documents(index, batch, expansion, chosen)
    return rk.top_n(scored.filter("is_match").drop("is_match"), n)


def limited_blocks(index: Index, batch: Batch, expansion: DataFrame) -> DataFrame:
    """``(query_id, doc_block, most, place)``: the blocks with some word of the query, the most promising first."""
    held = F.broadcast(expansion) if is_small(expansion) else expansion
    limits = rk.block_limits(rk.word_tops(index, held), batch.hinted(batch.words))
    line = Window.partitionBy("query_id").orderBy(F.desc("most"), "doc_block")
    return cut_lineage(limits.withColumn("place", F.row_number().over(line)))


def blocks_in_reach(limits: DataFrame, best: DataFrame, n: int) -> DataFrame:
    """Of the blocks after the first, those that can hold a document as good as the query's nth of ``best``."""
    nth = best.filter(F.col("rank") == n).select("query_id", F.col("score").alias("nth"))
    rest = limits.filter(F.col("place") > SEED_BLOCKS).join(nth, "query_id", "left")
    return rest.filter(F.col("most") >= F.coalesce("nth", F.lit(0.0))).select("query_id", "doc_block")


def best_by_blocks(index: Index, batch: Batch, expansion: DataFrame, n: int) -> DataFrame:
    """The same rows as ``best_matches``, without the blocks whose best possible score is too low.

    Each query is first answered from the few blocks with the highest limits. Blocks that
    cannot reach its nth score there are not read for it; equal scores count as reached,
    as a smaller id may win. A query with fewer than n results so far reads all its blocks.
    """
    limits = limited_blocks(index, batch, expansion)
    first = limits.filter(F.col("place") <= SEED_BLOCKS).select("query_id", "doc_block")
    best = cut_lineage(best_matches(index, batch, expansion, n, cut_lineage(first)))
    rest = cut_lineage(blocks_in_reach(limits, best, n))
    if rest.isEmpty():
        return best
    more = best_matches(index, batch, expansion, n, rest)
    return rk.top_n(best.unionByName(more).drop("rank"), n)


def rank_batch(index: Index, batch: Batch, n: int) -> DataFrame:
    """``(query_id, doc_id, score, rank)``, the best ``n`` per query."""
    expansion = expand_batch(index, batch)
    # With few blocks the limits could not spare what they cost.
    by_blocks = n > 0 and index.term_blocks is not None and index.n_blocks > 2 * SEED_BLOCKS
    best = (best_by_blocks if by_blocks else best_matches)(index, batch, expansion, n)
    if not batch.any_true_without_match or n == 0:
        return best
    # Queries such as NOT x are also true for documents without any of their
    # words. Those score 0.0, so they matter only where fewer than n documents
    # score more.
    best = cut_lineage(best)
    enough = (
        best.filter("score > 0")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n_above"))
        .filter(F.col("n_above") >= n)
    )
    short = cut_lineage(
        batch.programs.filter("true_without_match").join(enough, "query_id", "left_anti")
    )
    if short.isEmpty():
        return best
    part = replace(batch, programs=short, words=qt.program_words(short))
    needed = part.hinted(part.words.select("word").distinct())
    rest = untouched_documents(index, part, expansion.join(needed, "word", "left_semi"), n)
    return rk.top_n(
        best.drop("rank").unionByName(rest.withColumn("score", F.lit(0.0))), n
    )


def touched_documents(index: Index, batch: Batch, expansion: DataFrame) -> DataFrame:
    """``(query_id, doc_id, doc_block)`` of documents with an occurrence of some query word."""
    matches = batch_matches(index, batch, expansion, with_block=True)
    return (
        matches.join(batch.hinted(batch.words.select("query_id", "word")), "word")
        .select("query_id", "doc_id", "doc_block")
        .distinct()
    )


def untouched_documents(index: Index, batch: Batch, expansion: DataFrame, n: int) -> DataFrame:
    """For each query the ``n`` smallest ids of documents without any of its words.

    Documents lie in blocks of ids. Counting touched documents per block finds
    the first blocks with enough free ids, and only those are listed, so the
    documents are never paired with all queries. At most ``n`` plus the number
    of fully touched blocks have to be considered per query.
    """
    # One row per block: a millionth of the documents at the default size.
    blocks = (
        index.documents.groupBy("doc_block")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .withColumn("place", F.row_number().over(Window.orderBy("doc_block")) - 1)
    )
    if "doc_block" not in index.postings.columns:
        index = replace(index, postings=index.postings.withColumn("doc_block", index.partition_of(F.col("doc_id"))))
    touched = touched_documents(index, batch, expansion)
    used = cut_lineage(
        touched.groupBy("query_id", "doc_block")
        .agg(F.count(F.lit(1)).alias("n_used"))
        .join(blocks, "doc_block")
        .select("query_id", "place", (F.col("n_docs") - F.col("n_used")).alias("free"))
    )
    n_full = used.filter("free = 0").groupBy("query_id").agg(F.count(F.lit(1)).alias("n_full"))
    last = F.lit(n - 1) + F.coalesce("n_full", F.lit(0))
    candidates = (
        batch.programs.select("query_id")
        .join(n_full, "query_id", "left")
        .select("query_id", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("place"))
        .join(blocks, "place")
        .join(used, ["query_id", "place"], "left")
        .select("query_id", "doc_block", "place", F.coalesce("free", "n_docs").alias("free"))
        .filter("free > 0")
    )
    earlier = (
        Window.partitionBy("query_id")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    chosen = cut_lineage(
        candidates.withColumn("before", F.coalesce(F.sum("free").over(earlier), F.lit(0)))
        .filter(F.col("before") < n)
        .select("query_id", "doc_block")
        .transform(index.with_partition)
    )
    if batch.n_queries * n <= MAX_BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    blocks = chosen.select(*index.block_keys).distinct()
    in_blocks = index.restricted(lambda rows: rows.join(blocks, index.block_keys, "left_semi"))
    by_id = Window.partitionBy("query_id").orderBy("doc_id")
    return (
        index.documents.select("doc_id", *index.block_keys)
        .join(chosen, index.block_keys)
        .select("query_id", "doc_id")
        .join(
            touched_documents(in_blocks, batch, expansion), ["query_id", "doc_id"], "left_anti"
        )
        .withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= n)
        .drop("place")
    )


def search_batch(
    index: Index, queries: DataFrame, n: int = DEFAULT_RESULTS, strict: bool = False
) -> DataFrame:
    """All queries in one job: ``(query_id, query, rank, doc_id, url, snippet, score)``.

    Queries with the same canonical form are answered once, under the smallest
    id. Invalid ones are left out (see ``rejected_queries``), or fail the whole
    batch when ``strict``.
    """
    if n < 0:
        raise ValueError("the number of results must not be negative")
    batch = prepare_batch(queries, strict)
    ranked = rank_batch(index, batch, n)
    if batch.n_queries * n <= MAX_BROADCAST_ROWS:
        ranked = F.broadcast(ranked)
    names = batch.programs.select("query_id", F.col("canon").alias("query"))
    return (
        fetch_documents(index, ranked, "url", "snippet")
        .join(batch.hinted(names), "query_id")
        .select("query_id", "query", "rank", "doc_id", "url", "snippet", "score")
    )


def search_one(index: Index, line: str, n: int = DEFAULT_RESULTS) -> DataFrame:
    """One query, best first: ``(rank, doc_id, url, snippet, score)``."""
    queries = one_query(index.documents.sparkSession, line)
    found = search_batch(index, queries, n, strict=True)
    return found.select("rank", "doc_id", "url", "snippet", "score").orderBy("rank")


def match_one(index: Index, line: str) -> DataFrame:
    """Ids of all documents one query is true for, unranked.

    Only the postings of the query's own words are read.
    """
    batch = prepare_batch(one_query(index.documents.sparkSession, line), strict=True)
    wanted = index
    if batch.few_words:
        # As constants the words also prune row groups of the sorted postings.
        wanted = index.restricted(lambda rows: rows.filter(F.col("term").isin(batch.few_words)))
    exact = batch.words.select(
        F.col("word").alias("term"),
        "word",
        F.lit(1).cast("long").alias("occ"),
        F.lit(True).alias("as_typed"),
        F.lit(True).alias("exact"),
    )
    found = rk.expanded_postings(wanted, batch.hinted(exact))
    matches = rk.word_matches(found)
    per_doc = rk.query_matches(matches, batch.hinted(batch.words), batch.masks)
    judged = per_doc.join(batch.hinted(batch.programs), "query_id").select(
        "doc_id", qt.query_true(batch.masks, batch.most_words).alias("is_match")
    )
    if not batch.any_true_without_match:
        return judged.filter("is_match").select("doc_id")
    return index.documents.select("doc_id").join(
        judged.filter(~F.col("is_match")), "doc_id", "left_anti"
    )
