"""Headline timings on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acervo.functions.html import read_pages  # noqa: E402
from acervo.operators.boolean import docs_and, docs_not, docs_or, term_docs  # noqa: E402
from acervo.plans.crawl import expand_frontier  # noqa: E402
from acervo.plans.search import match_one, search_batch, search_one  # noqa: E402
from acervo.session import scratch_path  # noqa: E402
from acervo.sources.index_store import load_index, save_index  # noqa: E402
from checks import corpus  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from checks.scratch import name_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
PLAIN = (
    "norm_text",
    "doc_terms",
    "doc_norm",
    "document_table",
    "postings_list",
    "corpus_stats",
    "query_canonical",
    "page_links",
    "page_dedup",
    "fetch_outcome",
    "title_stem",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_scratch(spark)
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def batch_lines(index, n: int) -> DataFrame:
    """``n`` queries over the most frequent terms, a third of each shape."""
    terms = index.vocabulary.filter("length(term) > 2").orderBy(F.desc("df"), "term")
    words = [row["term"] for row in terms.limit(3 * n).collect()]
    shapes = ("{0} AND NOT {1} OR {2}", "({0} OR {1}) AND NOT {2}", "{0} AND ({1} OR {2})")
    lines = [
        (i, shapes[i % 3].format(words[i % len(words)], words[(i + n) % len(words)], words[(i + 2 * n) % len(words)]))
        for i in range(n)
    ]
    return index.documents.sparkSession.createDataFrame(lines, "query_id long, line string")


def combined(index) -> DataFrame:
    docs = {word: term_docs(index, word) for word in ("tion", "mente", "ing", "ado")}
    either = docs_or(docs["tion"], docs["mente"])
    return docs_and(either, docs_not(index, docs_and(docs["ing"], docs["ado"])))


def main() -> None:
    spark = session()
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    timings: dict[str, float] = {}

    def timed(name: str, job) -> None:
        best = []
        for _ in range(RUNS):
            started = time.perf_counter()
            job()
            best.append(time.perf_counter() - started)
        timings[name] = round(sorted(best)[len(best) // 2], 3)

    def build(sf_dir: str):
        path = scratch_path(spark, "index")
        save_index(corpus.documents(spark, sf_dir), path, term_buckets=8, doc_splits=2, docs_per_block=2000)
        return load_index(spark, path)

    def searches(index, sizes=(1, 100, 1000)):
        lines = {n: batch_lines(index, n) for n in sizes}
        return {
            "search_one": lambda: run(search_one(index, "mente AND NOT ado OR tion")),
            "search_complement": lambda: run(search_one(index, "NOT zzzz AND NOT qqqq")),
            "bool_combined": lambda: run(combined(index)),
            "match_grouped": lambda: run(match_one(index, "(tion OR mente) AND NOT (ing AND ado)")),
            **{f"search_batch_{n}": lambda b=b: run(search_batch(index, b)) for n, b in lines.items()},
        }

    def others(sf_dir: str):
        edges = corpus.site_edges(spark, sf_dir)
        seed = edges.filter(F.col("src").startswith("http")).agg(F.min("src").alias("url"))
        return {
            "page_body": lambda: run(
                read_pages(
                    corpus.pages(spark, sf_dir), "text", container_tag="article", container_class=""
                )
            ),
            "frontier_bfs": lambda: run(expand_frontier(edges, seed)),
            **{name: lambda name=name: run(QUERIES[name](spark, sf_dir)) for name in PLAIN},
        }

    warm = build(small)
    for job in {**searches(warm, (1, 10)), **others(small)}.values():
        job()

    timed("index_build", lambda: build(SF_DIR))
    index = build(SF_DIR)
    for name, job in {**searches(index), **others(SF_DIR)}.items():
        timed(name, job)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
