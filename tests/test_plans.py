"""Plans that must not change their shape, and the paths beyond a broadcast."""

import re

import pytest

from acervo import session as session_module
from acervo.operators import boolean as bl
from acervo.operators.index import build_documents
from acervo.plans import search as search_module
from acervo.plans.search import match_one, one_query, prepare_batch, search_batch, search_one
from acervo.sources.index_store import load_index, save_index


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [(i, "t", f"u{i}", f"alfa dos{i % 3} tres{i % 5} posgrado{i}") for i in range(60)]
    raw = spark.createDataFrame(rows, "doc_id long, title string, url string, text string")
    path = str(tmp_path_factory.mktemp("index") / "plans")
    save_index(build_documents(raw), path, term_buckets=4, doc_splits=2, docs_per_block=10)
    return load_index(spark, path)


def test_term_lookup_reads_one_bucket(index):
    plan = plan_of(bl.term_docs(index, "alfa"))
    assert re.search(r"PartitionFilters: \[.*term_bucket#\d+L = \d+\)", plan)
    assert "EqualTo(term,alfa)" in plan
    assert "Exchange" not in plan


def test_match_prunes_by_word(index):
    plan = plan_of(match_one(index, "alfa AND dos1"))
    assert re.search(r"PushedFilters: .*In\(term, \[", plan)
    assert re.search(r"PartitionFilters: .*dynamicpruning", plan)


def test_search_moves_matched_postings_once(index):
    plan = plan_of(search_one(index, "alfa AND NOT dos1 OR tres2"))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan
    # The pruning subquery repeats the broadcast it reuses.
    main = plan.split("===== Subqueries =====")[0]
    assert len(re.findall(r"hashpartitioning\(doc_id#", main)) == 1
    assert "text:string" not in plan
    assert re.search(r"PartitionFilters: .*doc_block#\d+L\), dynamicpruning", plan)


def test_search_scores_without_the_document_table(spark, index):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        main = plan_of(search_one(index, "alfa AND NOT dos1 OR tres2")).split("===== Subqueries =====")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"hashpartitioning\(doc_id#", main)) == 1
    assert "norm" not in "".join(re.findall(r"ReadSchema: \S+snippet\S+", main))


@pytest.mark.parametrize("line", ["alfa AND NOT dos1 OR tres2", "NOT zzz AND NOT qqq", "NOT (dos1 OR alfa)"])
def test_same_results_without_broadcasts(index, monkeypatch, line):
    hinted = [tuple(r) for r in search_one(index, line).collect()]
    monkeypatch.setattr(session_module, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(search_module, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(search_module, "SCANNED_TERMS", 0)
    plain = search_one(index, line)
    assert "BroadcastNestedLoopJoin" not in plan_of(plain)
    assert [tuple(r) for r in plain.collect()] == hinted


def test_many_identical_queries_are_answered_once(spark, index):
    lines = [(i, "alfa AND tres2") for i in range(500)] + [(1000, "(dos1)")]
    rows = search_batch(index, spark.createDataFrame(lines, "query_id long, line string"), 3).collect()
    assert {r["query_id"] for r in rows} == {0, 1000}
    assert len(rows) == 6


def test_few_words_are_looked_up_in_a_large_vocabulary(index, monkeypatch):
    scanned = [tuple(r) for r in search_one(index, "os1 OR fa AND NOT o").collect()]
    monkeypatch.setattr(search_module, "SCANNED_TERMS", 0)
    assert [tuple(r) for r in search_one(index, "os1 OR fa AND NOT o").collect()] == scanned


@pytest.fixture(scope="module")
def many_blocks(spark, tmp_path_factory):
    """Forty blocks of ten documents; "alfa" is in all of them, and prominent in some of block 7, 21 and 22."""
    rows = []
    for i in range(400):
        rest = " ".join(f"w{i}x{k}" for k in range(12))
        rows.append((i, "t", f"u{i}", "alfa " * (9 if i in range(212, 224) or i == 75 else 1) + f"dos{i % 3} {rest}"))
    raw = spark.createDataFrame(rows, "doc_id long, title string, url string, text string")
    path = str(tmp_path_factory.mktemp("index") / "blocks")
    save_index(build_documents(raw), path, term_buckets=4, doc_splits=2, docs_per_block=10)
    return load_index(spark, path)


def reach_of(index, line, n):
    """Blocks with a word of the query, and the ones that are read after the first."""
    batch = prepare_batch(one_query(index.documents.sparkSession, line))
    expansion = search_module.expand_batch(index, batch)
    limits = search_module.limited_blocks(index, batch, expansion)
    first = limits.filter(f"place <= {search_module.SEED_BLOCKS}").select("query_id", "doc_block")
    best = search_module.best_matches(index, batch, expansion, n, first).checkpoint()
    return limits.count(), {r["doc_block"] for r in search_module.blocks_in_reach(limits, best, n).collect()}


def test_blocks_out_of_reach_are_not_read(many_blocks):
    assert reach_of(many_blocks, "alfa", 10) == (40, set())
    assert reach_of(many_blocks, "alfa OR zzz", 13) == (40, set())
    # With more results than the first blocks hold, all blocks are read; ties too.
    assert len(reach_of(many_blocks, "alfa", 50)[1]) == 36
    assert len(reach_of(many_blocks, "alfa", 14)[1]) == 36


@pytest.mark.parametrize("n", [1, 10, 14, 50])
def test_same_results_with_and_without_limits(many_blocks, monkeypatch, n):
    lines = ["alfa", "alfa AND dos1", "dos2 OR NOT alfa", "w75x OR lfa", "ALFA OR alfa", "alfa AND NOT dos0 OR w3"]
    limited = [[tuple(r) for r in search_one(many_blocks, line, n).collect()] for line in lines]
    monkeypatch.setattr(search_module, "SEED_BLOCKS", 1000)
    assert [[tuple(r) for r in search_one(many_blocks, line, n).collect()] for line in lines] == limited


def test_chosen_blocks_prune_the_postings(spark, many_blocks):
    batch = prepare_batch(one_query(spark, "alfa"))
    expansion = search_module.expand_batch(many_blocks, batch)
    chosen = spark.createDataFrame([(0, 7)], "query_id long, doc_block long")
    plan = plan_of(search_module.scored_documents(many_blocks, batch, expansion, chosen))
    assert re.search(r"PartitionFilters: .*doc_block#\d+L\), dynamicpruning", plan)
    assert "BroadcastNestedLoopJoin" not in plan
