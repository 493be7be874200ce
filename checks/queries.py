"""One entry per operator, each over the driver's whole tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``checks.oracle`` has
the same result as SQL where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from acervo.functions import html as hx
from acervo.functions import text as tx
from acervo.functions import urls
from acervo.operators import boolean as bl
from acervo.operators import index as ix
from acervo.operators import links as lk
from acervo.operators import query_table as qt
from acervo.operators import rank as rk
from acervo.operators.described import described_postings
from acervo.plans import build, search
from acervo.plans.crawl import expand_fetched, expand_frontier
from acervo.schemas import QUERIES as QUERY_SCHEMA
from acervo.session import scratch_path
from acervo.sources.index_store import block_catalogue, save_index
from acervo.sources.pages import read_pages_back, scan_page_files, write_pages
from acervo.sources.query_files import read_query_file
from checks import corpus

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORE_LINE = "(tion OR mente) AND NOT (ing AND ado) OR Tion OR tion"
BATCH_LINES = [
    (1, "mente AND NOT ado OR tion"),
    (2, "ado"),
    (3, "(tion OR mente) AND NOT (ing AND ado)"),
    (4, "NOT the"),
    (5, "Tion OR tion"),
    (6, "NOT (ing)"),
    (7, "((ado) )"),
    (8, "NOT zzzz AND NOT qqqq"),
    (9, "ado mente"),
    (10, ""),
]
SITE = "https://u.example"
FILE_SUFFIX = r"[aeiou]\w*"
CRAWL_CAP = 300


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- text -------------------------------------------------------------------------
@query
def norm_text(spark, sf_dir):
    tokens = tx.index_tokens("text")
    return corpus.texts(spark, sf_dir).select("doc_id", tx.joined(tokens).alias("norm_text"))


@query
def norm_steps(spark, sf_dir):
    """The five normalisation steps one by one."""
    text = F.col("text")
    return (
        corpus.texts(spark, sf_dir)
        .withColumn("t1", tx.spaces_for_split_symbols(text))
        .withColumn("t2", tx.without_punctuation(F.col("t1")))
        .withColumn("t3", tx.single_spaced(F.col("t2")))
        .withColumn("t4", tx.words(F.col("t3")))
        .withColumn("t5", tx.without_stopwords("t4"))
        .select(
            "doc_id",
            F.md5("t1").alias("t1"),
            F.md5("t2").alias("t2"),
            F.md5("t3").alias("t3"),
            F.size("t4").cast("long").alias("n_words"),
            F.md5(F.array_join("t4", " ")).alias("t4"),
            F.size("t5").cast("long").alias("n_tokens"),
            F.md5(F.array_join("t5", " ")).alias("t6"),
        )
    )


@query
def snippet(spark, sf_dir):
    return corpus.texts(spark, sf_dir).select("doc_id", tx.snippet(F.col("text")).alias("snippet"))


# -- index ------------------------------------------------------------------------
@query
def doc_terms(spark, sf_dir):
    return ix.text_terms(corpus.texts(spark, sf_dir))


@query
def doc_norm(spark, sf_dir):
    return corpus.texts(spark, sf_dir).select(
        "doc_id", tx.norm(tx.index_tokens_sql("text")).alias("norm")
    )


@query
def postings_list(spark, sf_dir):
    postings = ix.text_terms(corpus.texts(spark, sf_dir))
    return ix.posting_lists(postings).select(
        "term",
        "list_no",
        F.size("doc_ids").cast("long").alias("n_docs"),
        F.array_join(F.col("doc_ids").cast("array<string>"), ",").alias("doc_ids"),
    )


@query
def document_frequency(spark, sf_dir):
    return ix.vocabulary(ix.text_terms(corpus.texts(spark, sf_dir)))


@query
def document_table(spark, sf_dir):
    return corpus.documents(spark, sf_dir).drop("doc_block")


@query
def document_numbering(spark, sf_dir):
    raw = corpus.texts(spark, sf_dir).select("url", F.col("doc_id").alias("given_id"))
    return ix.with_dense_ids(raw, "url")


@query
def corpus_stats(spark, sf_dir):
    texts = corpus.texts(spark, sf_dir)
    postings = ix.text_terms(texts)
    return ix.corpus_stats(ix.Index(texts, postings, ix.vocabulary(postings)))


@query
def index_round_trip(spark, sf_dir):
    """All stored postings with the stored norm and URL of their documents and the frequency of their terms."""
    return described_postings(corpus.stored_index(spark, sf_dir))


@query
def index_blocks(spark, sf_dir):
    """The catalogue of an index whose ids lie far apart."""
    documents = corpus.documents(spark, sf_dir).withColumn("doc_id", F.col("doc_id") * 1_000_003)
    path = scratch_path(spark, "index")
    save_index(documents, path, 4, 4, 300, ids=documents.select("doc_id"))
    return block_catalogue(spark, path)


@query
def term_blocks(spark, sf_dir):
    """Figures of terms by block, from which searches see what a block can reach."""
    index = corpus.stored_index(spark, sf_dir, docs_per_block=100)
    return index.term_blocks.select("term", "doc_block", "df", "cf", "top")


# -- boolean ----------------------------------------------------------------------
@query
def term_lookup(spark, sf_dir):
    return bl.term_docs(corpus.plan_index(spark, sf_dir), "tion")


@query
def bool_and(spark, sf_dir):
    index = corpus.plan_index(spark, sf_dir)
    return bl.docs_and(bl.term_docs(index, "tion"), bl.term_docs(index, "ing"))


@query
def bool_or(spark, sf_dir):
    index = corpus.plan_index(spark, sf_dir)
    return bl.docs_or(bl.term_docs(index, "tion"), bl.term_docs(index, "mente"))


@query
def bool_not(spark, sf_dir):
    index = corpus.plan_index(spark, sf_dir)
    return bl.docs_not(index, bl.term_docs(index, "the"))


@query
def bool_left_to_right(spark, sf_dir):
    """mente OR tion AND ing AND NOT er, evaluated in the written order."""
    return search.match_one(
        corpus.plan_index(spark, sf_dir), "mente OR tion AND ing AND NOT er"
    )


@query
def bool_grouped(spark, sf_dir):
    return search.match_one(
        corpus.stored_index(spark, sf_dir), "NOT (tion AND (ing OR mente)) OR (the AND NOT er)"
    )


@query
def bool_combined(spark, sf_dir):
    """(tion OR mente) AND NOT (ing AND er) as DataFrame code."""
    index = corpus.stored_index(spark, sf_dir)
    docs = lambda word: bl.term_docs(index, word)
    either = bl.docs_or(docs("tion"), docs("mente"))
    return bl.docs_and(either, bl.docs_not(index, bl.docs_and(docs("ing"), docs("er"))))


# -- query tables -----------------------------------------------------------------
@query
def query_tokens(spark, sf_dir):
    table = qt.query_table(corpus.query_lines(spark, sf_dir))
    return table.select("query_id", F.array_join("tokens", "|").alias("tokens"), "kinds")


@query
def query_terms(spark, sf_dir):
    return qt.query_terms(qt.query_table(corpus.query_lines(spark, sf_dir)))


@query
def query_valid(spark, sf_dir):
    return qt.query_table(corpus.query_lines(spark, sf_dir)).select("query_id", "valid", "reason")


@query
def query_canonical(spark, sf_dir):
    table = qt.query_table(corpus.query_lines(spark, sf_dir))
    return qt.distinct_queries(table).select("query_id", "canon")


@query
def query_rejects(spark, sf_dir):
    return search.rejected_queries(corpus.query_lines(spark, sf_dir))


@query
def query_file(spark, sf_dir):
    """Query lines stored as text files and read back, numbered in file and line order."""
    path = scratch_path(spark, "query-lines")
    corpus.query_lines(spark, sf_dir).orderBy("query_id").select("line").write.text(path)
    return read_query_file(spark, path)


# -- scores and searches ----------------------------------------------------------
@query
def word_expansion(spark, sf_dir):
    """Terms that contain a word of the benchmark texts, looked up in the stored grams."""
    index = corpus.stored_index(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = lines.select(F.explode(F.split("text", " ")).alias("word")).filter("word <> ''").distinct()
    return search.expand_by_lookup(index, words)


def _matches(spark, sf_dir):
    index = corpus.stored_index(spark, sf_dir)
    batch = search.prepare_batch(search.one_query(spark, SCORE_LINE))
    expansion = search.expand_batch(index, batch)
    return index, batch, expansion


@query
def score_tf(spark, sf_dir):
    index, batch, expansion = _matches(spark, sf_dir)
    per_query = rk.query_matches(search.batch_matches(index, batch, expansion), batch.words, batch.masks)
    return per_query.select("doc_id", F.col("tf").alias("query_tf"))


@query
def score_query_norm(spark, sf_dir):
    index, batch, expansion = _matches(spark, sf_dir)
    per_query = rk.query_matches(search.batch_matches(index, batch, expansion), batch.words, batch.masks)
    return per_query.filter("squares > 0").select(
        "doc_id", F.sqrt(F.col("squares").cast("double")).alias("query_norm")
    )


@query
def score(spark, sf_dir):
    index, batch, expansion = _matches(spark, sf_dir)
    return search.scored_documents(index, batch, expansion).select("doc_id", "score", "is_match")


@query
def search_one(spark, sf_dir):
    return search.search_one(corpus.stored_index(spark, sf_dir), BATCH_LINES[0][1])


@query
def search_not(spark, sf_dir):
    return search.search_one(corpus.stored_index(spark, sf_dir), "NOT zzzz AND NOT qqqq OR ado", 60)


@query
def search_batch(spark, sf_dir):
    lines = spark.createDataFrame(BATCH_LINES, QUERY_SCHEMA)
    return search.search_batch(corpus.stored_index(spark, sf_dir), lines)


@query
def search_by_blocks(spark, sf_dir):
    """The batch on an index of many blocks, of which only those in reach are read."""
    lines = spark.createDataFrame(BATCH_LINES, QUERY_SCHEMA)
    return search.search_batch(corpus.stored_index(spark, sf_dir, docs_per_block=20), lines)


# -- links and fetch logs ---------------------------------------------------------
@query
def page_links(spark, sf_dir):
    return corpus.pages(spark, sf_dir).select(
        "doc_id", F.explode(lk.hrefs(F.col("text"))).alias("href")
    )


@query
def site_links(spark, sf_dir):
    """Root-relative links made absolute, then those on an https host."""
    found = corpus.pages(spark, sf_dir).select(
        "url", F.explode(lk.hrefs(F.col("text"))).alias("href")
    )
    absolute = found.select("url", F.concat(corpus.host(F.col("url")), "href").alias("dst"))
    return absolute.filter(lk.is_site_link(F.col("dst"), F.lit("https://blog.")))


@query
def relative_links(spark, sf_dir):
    """The edge table, with a suffix that occurs in the pages."""
    return lk.page_links(
        corpus.pages(spark, sf_dir), corpus.host(F.col("url")), suffix=FILE_SUFFIX
    )


@query
def url_type(spark, sf_dir):
    files = corpus.texts(spark, sf_dir).select("url")
    all_urls = corpus.pages(spark, sf_dir).select("url").unionByName(files)
    return all_urls.select("url", urls.document_type(F.col("url")).alias("type"))


@query
def url_strip(spark, sf_dir):
    return corpus.pages(spark, sf_dir).select(
        "url", urls.without_parameters(F.col("url")).alias("stripped")
    )


@query
def url_key(spark, sf_dir):
    return corpus.pages(spark, sf_dir).select(
        "url",
        urls.storage_key(F.col("url")).alias("key"),
        urls.storage_file("store", F.col("url")).alias("file"),
    )


@query
def page_dedup(spark, sf_dir):
    """Page sink and source, fed every page twice, the second with a parameter."""
    pages = corpus.pages(spark, sf_dir)
    again = pages.select(
        (F.col("doc_id") + 1_000_000_000).alias("doc_id"),
        F.concat("url", F.lit("?again")).alias("url"),
        "text",
        "type",
    )
    path = scratch_path(spark, "pages")
    write_pages(pages.unionByName(again), path, seq="doc_id")
    return read_pages_back(spark, path).select("url", F.md5("text").alias("text_md5"), "type")


@query
def page_upsert(spark, sf_dir):
    """A second crawl that brings new texts for some pages, an older one for others, and further pages."""
    pages = corpus.pages(spark, sf_dir)
    path = scratch_path(spark, "pages")
    write_pages(pages, path, seq="doc_id", buckets=32)
    kind = F.col("doc_id") % 5
    write_pages(
        pages.select(
            F.when(kind == 0, F.col("doc_id") + 1_000_000_000).otherwise(-F.col("doc_id") - 1).alias("doc_id"),
            F.when(kind == 1, F.concat("url", F.lit("/more"))).otherwise(F.col("url")).alias("url"),
            F.concat("text", F.lit("second")).alias("text"),
            "type",
        ),
        path,
        seq="doc_id",
    )
    return read_pages_back(spark, path).select("url", F.md5("text").alias("text_md5"), "type")


@query
def page_files(spark, sf_dir):
    """JSON files of all pages, some cut off and some without a field: pages and rejects."""
    pages = corpus.pages(spark, sf_dir)
    kind = F.col("doc_id") % 10
    whole = F.to_json(F.struct("url", F.when(kind != 7, F.col("text")).alias("text"), "type"))
    line = F.when(kind == 3, F.substring(whole, 1, 20)).otherwise(whole)
    path = scratch_path(spark, "page-files")
    # Tasks move their files into place themselves; the driver would move them one by one.
    by_task = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    pages.select(line.alias("value")).write.options(maxRecordsPerFile="1", **by_task).text(path)
    found = scan_page_files(spark, path, "*.txt")
    return found.select("url", F.md5("text").alias("text_md5"), "type", "reason")


@query
def fetch_outcome(spark, sf_dir):
    return lk.fetch_outcome(corpus.fetch_log(spark, sf_dir))


@query
def fetch_success(spark, sf_dir):
    return lk.fetched_pages(corpus.fetch_log(spark, sf_dir)).select("seq", "url")


@query
def fetch_retry(spark, sf_dir):
    return lk.retry_urls(corpus.fetch_log(spark, sf_dir))


@query
def frontier_step(spark, sf_dir):
    """Hrefs of http sites that no https site links to."""
    edges = corpus.site_edges(spark, sf_dir)
    http = edges.filter(F.col("src").startswith("http://")).select(F.col("dst").alias("url"))
    https = edges.filter(F.col("src").startswith("https://")).select(F.col("dst").alias("url"))
    return lk.unvisited(http, https.distinct())


@query
def frontier_bfs(spark, sf_dir):
    edges = corpus.site_edges(spark, sf_dir)
    seed = edges.filter(F.col("src").startswith("http")).agg(F.min("src").alias("url"))
    return expand_frontier(edges, seed, CRAWL_CAP)


@query
def frontier_fetched(spark, sf_dir):
    """Expansion that follows only pages whose fetch came through, after up to three attempts."""
    edges = corpus.site_edges(spark, sf_dir)
    seed = edges.filter(F.col("src").startswith("http")).select(F.col("src").alias("url"))
    return expand_fetched(edges, corpus.link_log(edges), seed, 10**9, max_attempts=3)


# -- titles and page bodies -------------------------------------------------------
@query
def title_html(spark, sf_dir):
    return corpus.pages(spark, sf_dir).select(
        "doc_id", hx.html_title(F.col("text")).alias("title")
    )


@query
def title_stem(spark, sf_dir):
    files = corpus.texts(spark, sf_dir).select("url")
    all_urls = corpus.pages(spark, sf_dir).select("url").unionByName(files)
    return all_urls.select("url", urls.path_title(F.col("url")).alias("title"))


@query
def page_body(spark, sf_dir):
    read = hx.read_pages(
        corpus.pages(spark, sf_dir), "text", container_tag="article", container_class=""
    )
    return read.select("doc_id", "title", "body", F.size("hrefs").cast("long").alias("n_hrefs"))


@query
def page_reader(spark, sf_dir):
    """Decoded titles and all link targets, from the reader."""
    read = hx.read_pages(corpus.pages(spark, sf_dir))
    return read.select("doc_id", "title", F.array_join("hrefs", " ").alias("hrefs"))


@query
def page_index(spark, sf_dir):
    """Html pages and texts in one index."""
    texts = corpus.texts(spark, sf_dir).withColumn("doc_id", F.col("doc_id") + 1_000_000_000)
    raw = corpus.pages(spark, sf_dir).unionByName(texts, allowMissingColumns=True)
    return build.page_documents(raw, container_tag="article", container_class="").drop("doc_block")
