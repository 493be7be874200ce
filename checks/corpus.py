"""The driver's tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acervo.functions import urls
from acervo.operators.index import Index, build_documents, index_from_documents
from acervo.operators.links import hrefs
from acervo.sources.index_store import load_index, save_index
from acervo.sources.pages import read_page_table
from acervo.session import scratch_path


def spread_small_scan(scan: DataFrame) -> DataFrame:
    """Spread a scan with fewer tasks than cores over all cores.

    Such an input is at most one split per core, so the exchange is small; a
    large scan has more tasks than that and is left where it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < cores:
        return scan.repartition(cores)
    return scan


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, url, text, type)``; documents are taken as extracted pdf text."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spread_small_scan(table.select("doc_id", "source", "text")).select(
        "doc_id",
        F.concat(
            F.lit("https://"), "source", F.lit(".example/doc/"), F.col("doc_id").cast("string"), F.lit(".txt.pdf")
        ).alias("url"),
        "text",
        F.lit("pdf").alias("type"),
    )


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select(
        "doc_id", urls.path_title(F.col("url")).alias("title"), "url", "text"
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_documents(extracted(spark, sf_dir))


def plan_index(spark: SparkSession, sf_dir: str) -> Index:
    """Index inside the plan, for operators that read one table of it once."""
    return index_from_documents(documents(spark, sf_dir))


def stored_index(
    spark: SparkSession, sf_dir: str, term_buckets: int = 8, doc_splits: int = 8, docs_per_block: int = 1000
) -> Index:
    """Index written to and read from the shared folder, as searches use it."""
    path = scratch_path(spark, "index")
    save_index(documents(spark, sf_dir), path, term_buckets, doc_splits, docs_per_block)
    return load_index(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for jobs that read it repeatedly."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small_scan(read_page_table(spark, f"{sf_dir}/pages.parquet"))


def host(url):
    """Scheme and host of a URL."""
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream read as a log of fetch attempts."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("https://u.example/"), F.col("user_id").cast("string")).alias("url"),
        F.when(F.col("event_type") == "error", 429)
        .when(F.col("event_type") == "signup", 404)
        .otherwise(200)
        .alias("status_code"),
    )


def site_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges host -> href -> host, both ways, from all pages."""
    found = pages(spark, sf_dir).select(
        host(F.col("url")).alias("site"), F.explode(hrefs(F.col("text"))).alias("href")
    )
    there = found.select(F.col("site").alias("src"), F.col("href").alias("dst"))
    back = found.select(F.col("href").alias("src"), F.col("site").alias("dst"))
    return stored(there.unionByName(back).distinct(), "links")


def link_log(edges: DataFrame) -> DataFrame:
    """Up to four fetches of every URL of the edges, with statuses drawn from hashes; some URLs have none."""
    urls = edges.select(F.col("src").alias("url")).distinct()
    fetches = urls.select("url", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("k"))
    drawn = F.substring(F.md5(F.concat("url", F.lit("#"), F.col("k").cast("string"))), 1, 1)
    status = F.when(drawn < "7", 200).when(drawn < "b", 429).otherwise(404)
    logged = fetches.select(F.col("k").cast("long").alias("seq"), "url", status.alias("status_code"), drawn.alias("drawn"))
    return logged.filter("drawn <> 'f'").drop("drawn")


def query_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per conversation turn, made of its whole text.

    The turn's punctuation becomes operators, so lines are valid and invalid
    in many ways: commas join by AND, sentence ends by ") OR NOT (", blanks by
    OR in the assistant's turns and by nothing in the user's. Lines are put in
    parentheses, but for first turns and the last one of fourth turns.
    """
    turns = spread_small_scan(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    flat = F.translate("text", "\n", " ")
    blank = F.when(F.col("role") == "assistant", F.lit(" OR ")).otherwise(F.lit(" "))
    body = F.replace(flat, F.lit(" "), blank)
    body = F.regexp_replace(body, "[,;:]( OR)? +", " AND ")
    body = F.regexp_replace(body, "[.?!]( OR)? +", ") OR NOT (")
    body = F.regexp_replace(body, "[.?!]+$", "")
    line = (
        F.when(F.col("turn") == 0, body)
        .when(F.col("turn") == 3, F.concat(F.lit("("), body))
        .otherwise(F.concat(F.lit("("), body, F.lit(")")))
    )
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), line.alias("line"))
