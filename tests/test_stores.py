import html
import json
import random
import time
from dataclasses import replace
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from acervo.functions import text as tx
from acervo.functions.references import decoded
from acervo.operators import links as lk
from acervo.operators import described as described_module
from acervo.operators import index as index_module
from acervo.operators import rank as rank_module
from acervo.operators.described import described_postings
from acervo.operators.index import block_between, block_bounds, build_documents, index_from_documents
from acervo.plans import crawl as crawl_module
from acervo.plans import search as search_module
from acervo.plans.crawl import expand_fetched, seed_urls
from acervo.plans.search import search_one
from acervo.schemas import DESCRIBED, GRAMS, POSTINGS, TERM_BLOCKS, VOCABULARY
from acervo.session import DROP_MOVED_KEY, OPEN_FILES, OPEN_FILES_KEY, rows_as_sorted, setting
from acervo.sources import index_store, manifest
from acervo.sources.pages import file_rejects, page_rows, read_pages_back, scan_page_files, write_pages
from checks.queries import QUERIES

PAGE = "seq long, url string, text string, type string"


def texts_of(spark, path):
    return {r["url"]: r["text"] for r in read_pages_back(spark, path).collect()}


# -- links ------------------------------------------------------------------------
@pytest.mark.parametrize("piece", ["<!--", "<script>", "<style ", "<a ", '<a x="', "<a href='", "<"])
def test_markup_that_never_closes_is_read_once(spark, piece):
    page = "<a href='/first'>" + piece * (1_000_000 // len(piece))
    frame = spark.createDataFrame([(page,)], "html string").select(lk.hrefs(F.col("html")).alias("h"))
    frame.collect()
    start = time.time()
    assert frame.first()["h"][0] == "/first"
    assert time.time() - start < 10


def test_links_after_closed_and_in_open_markup(spark):
    rows = [
        ("<!-- <a href='/no'> --><a href='/yes'>", ["/yes"]),
        ("<script>'<a href=\"/no\">'</SCRIPT ><a href=/yes>", ["/yes"]),
        ("<a href='/yes'><!-- <a href='/no'>", ["/yes"]),
        ("<a href='/yes'><style><a href='/no'>", ["/yes"]),
        ("<scripted><a href='/yes'></scripted>", ["/yes"]),
        ("<a title='a<b' href='/yes'>", ["/yes"]),
        (None, None),
    ]
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, html string")
    got = {r["i"]: r["h"] for r in frame.select("i", lk.hrefs(F.col("html")).alias("h")).collect()}
    assert got == {i: r[1] for i, r in enumerate(rows)}


def test_character_references_like_the_standard_library(spark):
    """With a semicolon every name and number decodes as in the standard library."""
    rnd = random.Random(1)
    cases = [f"/a&{name}b" for name in html.entities.html5 if name.endswith(";")]
    # Numbers that are no character at all give nothing in the library, and themselves here.
    numbers = [n for n in [*range(32, 127), *range(160, 300), 0x20AC, 0x1F600, 0xD800, 0x110000, 10**15, 128, 150, 159, 0] if n not in (0xB,)]
    cases += [f"x&#{n};y&#x{n:x};&#X{n:X};" for n in numbers]
    cases += ["&#65 &#x41 &#065;", "&", "&&amp;&", "&;", "&#;", "&#x;", "&nosuchname;", "&amp;lt;", "plain", ""]
    cases += ["".join(rnd.choices(["&amp;", "&lt;", "&eacute;", "&#233;", "a", "é", " ", "&"], k=8)) for _ in range(100)]
    cases = [c for c in cases if c]
    frame = spark.createDataFrame([(c,) for c in cases], "v string")
    for row in frame.select("v", decoded(F.col("v")).alias("d")).collect():
        assert row["d"] == html.unescape(row["v"]), row["v"]


def test_names_without_semicolon_in_attributes(spark):
    cases = {
        "?a=1&copy=2&reg=3": "?a=1&copy=2&reg=3",
        "?a&copy": "?a©",
        "?a&copy&amp b": "?a©& b",
        "&notit;": "&notit;",
        "&eacute/x": "é/x",
        "&eacutex": "&eacutex",
        "&lang": "&lang",
    }
    frame = spark.createDataFrame([(c,) for c in cases], "v string")
    assert {r["v"]: r["d"] for r in frame.select("v", decoded(F.col("v")).alias("d")).collect()} == cases


# -- page store -------------------------------------------------------------------
def test_second_crawl_replaces_only_its_pages(spark, tmp_path):
    path = str(tmp_path / "store")
    write_pages(spark.createDataFrame([(i, f"https://h/{i}", f"old {i}", "html") for i in range(40)], PAGE), path, buckets=8)
    first = manifest.latest(spark, path)
    later = [(100, "https://h/3?again", "new 3", "html"), (-1, "https://h/4", "older 4", "html"), (101, "https://h/x", "new x", "html")]
    for _ in range(2):  # the same save again changes nothing
        write_pages(spark.createDataFrame(later, PAGE), path, buckets=99)
        expected = {f"https://h/{i}": f"old {i}" for i in range(40) if i != 3} | {"https://h/3?again": "new 3", "https://h/x": "new x"}
        assert texts_of(spark, path) == expected
    second = manifest.latest(spark, path)
    before, after = ({r["bucket"]: r["folder"] for r in rows} for rows in (first, second))
    assert sum(before[b] != after[b] for b in before) <= 3 and second[0]["buckets"] == 8


def test_failed_page_save_leaves_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    write_pages(spark.createDataFrame([(1, "https://h/a", "A", "html")], PAGE), path)
    for row in [(2, None, "B", "html"), (None, "https://h/b", "B", "html")]:
        with pytest.raises(Exception, match="page without URL or sequence number"):
            write_pages(spark.createDataFrame([(3, "https://h/a", "new", "html"), row], PAGE), path)
    assert texts_of(spark, path) == {"https://h/a": "A"}


def test_empty_crawls(spark, tmp_path):
    path = str(tmp_path / "store")
    none = spark.createDataFrame([], PAGE)
    write_pages(none, path)
    assert texts_of(spark, path) == {}
    write_pages(spark.createDataFrame([(1, "u", "A", "html")], PAGE), path)
    write_pages(none, path)
    assert texts_of(spark, path) == {"u": "A"}


def test_pages_without_url_are_not_dropped_by_key(spark):
    rows = [(1, None, "A", "html"), (2, None, "B", "html"), (3, "u", "C", "html"), (None, "v", "D", "html")]
    kept = lk.latest_per_storage_key(spark.createDataFrame(rows, PAGE))
    assert sorted(r["text"] for r in kept.collect()) == ["B", "C", "D"]


# -- page files -------------------------------------------------------------------
def test_every_file_is_a_page_or_a_reject(spark, tmp_path):
    good = {"url": "u1", "text": "t", "type": "html"}
    files = {
        "a/content.json": json.dumps(good, indent=2),
        "b/content.json": '{"url": "u2", "text": ',
        "b/c/content.json": json.dumps({"url": "u3", "type": "pdf"}),
        "d/content.json": " \n",
        "e/content.json": "no json",
        "f/content.json": json.dumps({"url": 7, "text": "t", "type": "html", "more": [1]}),
        "g/content.json": '{"url": {"x": 1}, "text": "t", "type": "html"}',
    }
    for name, content in files.items():
        target = tmp_path / "pages" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(content, encoding="utf-8")
    scanned = scan_page_files(spark, str(tmp_path / "pages"))
    assert scanned.count() == len(files)
    assert {r["url"] for r in page_rows(scanned).collect()} >= {"u1", "7"}
    rejects = {r["file"].split("/pages/")[1]: r["reason"] for r in file_rejects(scanned).collect()}
    assert rejects["b/content.json"] == rejects["e/content.json"] == "malformed JSON"
    assert rejects["b/c/content.json"] == "missing text" and rejects["d/content.json"] == "empty file"
    assert page_rows(scanned).count() + len(rejects) == len(files)


# -- index store ------------------------------------------------------------------
def documents(spark, ids, word="docencia"):
    rows = [(i, "t", f"https://h/{i}", f"{word} palabra{i}") for i in ids]
    return build_documents(spark.createDataFrame(rows, "doc_id long, title string, url string, text string"))


def test_failed_save_leaves_the_old_index(spark, tmp_path):
    path = str(tmp_path / "index")
    index_store.save_index(documents(spark, range(5)), path, 2, 1, 10)
    broken = documents(spark, range(9), "nuevo").withColumn("text", F.when(F.col("doc_id") == 7, F.raise_error(F.lit("torn"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="torn"):
        index_store.save_index(broken, path, 2, 1, 10)
    old = index_store.load_index(spark, path)
    assert old.documents.count() == 5 and search_one(old, "docencia").count() == 5
    index_store.save_index(documents(spark, range(9), "nuevo"), path, 2, 1, 10)
    assert index_store.load_index(spark, path).documents.count() == 9
    assert old.documents.count() == 5  # readers of the old version go on
    assert tuple(index_store.load_stats(spark, path).first())[1] == 9
    with pytest.raises(FileNotFoundError):
        index_store.load_index(spark, str(tmp_path / "nothing"))


def test_sparse_ids_share_blocks(spark, tmp_path):
    path = str(tmp_path / "index")
    ids = [i * 10_000_019 - 5 for i in range(60)]
    index_store.save_index(documents(spark, ids), path, 2, 2, 100)
    assert [tuple(r) for r in index_store.block_catalogue(spark, path).collect()] == [(0, ids[0], ids[-1], 60)]
    index_store.save_index(documents(spark, ids), path, 2, 2, 7)
    blocks = index_store.block_catalogue(spark, path).orderBy("doc_block").collect()
    assert [r["n_docs"] for r in blocks] == [7] * 8 + [4]
    index = index_store.load_index(spark, path)
    assert sorted(r["doc_id"] for r in search_one(index, "NOT palabra", 90).collect()) == sorted(ids)
    assert [r["doc_id"] for r in search_one(index, f"NOT palabra{ids[0]}", 3).collect()] == sorted(ids[1:])[:3]
    assert search_one(index, f"palabra{ids[33]}").first()["url"] == f"https://h/{ids[33]}"


def test_small_blocks_share_partitions(spark, tmp_path, monkeypatch):
    """Thirty blocks of two documents in groups of five: six partitions, and the results of an index in the plan."""
    monkeypatch.setattr(index_module, "DOCS_PER_GROUP", 10)
    path = str(tmp_path / "index")
    docs = documents(spark, [i * 7 for i in range(60)])
    index_store.save_index(docs, path, 2, 2, 2)
    for table in ("documents", "postings"):
        assert len({p.name for p in (tmp_path / "index").glob(f"versions/*/{table}/**/from_doc_block=*")}) == 6
    index = index_store.load_index(spark, path)
    blocks = index_store.block_catalogue(spark, path).orderBy("doc_block").collect()
    assert [tuple(r) for r in blocks] == [(b, 14 * b, 14 * b + 7, 2) for b in range(30)]
    assert (index.n_blocks, index.bounds) == (30, tuple(70 * g for g in range(6)))
    plain = index_from_documents(docs)
    for line, n in [("palabra7 OR bra42", 50), ("NOT palabra0 AND NOT palabra14", 3)]:
        assert [tuple(r) for r in search_one(index, line, n).collect()] == [tuple(r) for r in search_one(plain, line, n).collect()]


def test_figures_of_small_blocks_are_summed_where_they_arrive(spark):
    rows = [(i % 3, i % 5, f"t{i % 7}", 1 + i % 4, 1.0 + i % 2) for i in range(400)]
    postings = spark.createDataFrame(rows, "term_bucket long, doc_block long, term string, tf long, norm double")
    summed, moved = index_module.term_blocks(postings), index_module.term_blocks(postings, 3)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert moved.columns == summed.columns and plan.count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, moved.collect())) == sorted(map(tuple, summed.collect()))


def test_block_of_any_id(spark):
    ids = [0, 5, 6, 100, 101, 102, 5000]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for size in (1, 2, 3, 7, 50):
        bounds = block_bounds(frame, size)
        got = frame.select("doc_id", block_between(F.col("doc_id"), bounds).alias("b")).collect()
        assert {r["doc_id"]: r["b"] for r in got} == {i: k // size for k, i in enumerate(ids)}
    assert block_bounds(frame.limit(0), 5) == ()
    assert frame.limit(1).select(block_between(F.col("doc_id"), ())).first()[0] == 0


# -- counting in batches, written in the order of the tasks --------------------------
def test_documents_and_postings_equal_the_column_expressions(spark):
    """Cleaning and counting in Arrow batches against the expressions of ``functions.text``."""
    texts = [None, "", "  \t", "Casa casa CASA, (Árbol)  árbol;", "ΟΣ.Α ΟΣ İx", "ᲉB Ɤb \U00010d50Σ b", "de la y Uno"]
    texts += [f"w{i % 7} w{i % 3} w{i % 7} Palabra\x85fin" for i in range(50)]
    raw = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = raw.withColumn("title", F.lit("t")).withColumn("url", F.lit("u"))
    built = index_module.build_documents(raw)
    plain = raw.select("doc_id", tx.joined(tx.index_tokens("text")).alias("text"), tx.norm(tx.index_tokens_sql("text")).alias("norm"))
    assert sorted(map(tuple, built.select("doc_id", "text", "norm").collect())) == sorted(map(tuple, plain.collect()))
    got = index_module.document_terms(built, "doc_block").select("term", "doc_id", "tf", "norm").collect()
    counted = index_module.text_terms(raw).join(plain.drop("text"), "doc_id").select("term", "doc_id", "tf", "norm").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, counted)) and len(got) > 150


def test_terms_are_counted_in_bounded_steps(monkeypatch):
    """Postings of a batch come in several steps, each by rising term; null and empty texts have none."""
    monkeypatch.setattr(index_module, "BYTES_AT_ONCE", 12)
    texts = ["b a b", None, "", "c", "a very long text beyond the step a", "ñ z ñ", "b"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "doc_id": list(range(len(texts)))})
    steps = [step.to_pylist() for step in index_module._count_terms([batch])]
    assert len(steps) > 2 and all([r["term"] for r in step] == sorted(r["term"] for r in step) for step in steps)
    counted = {(i, w): t.split(" ").count(w) for i, t in enumerate(texts) if t for w in t.split(" ")}
    assert {(r["doc_id"], r["term"]): r["tf"] for step in steps for r in step} == counted
    norms = index_module.clean_texts(batch.column(0), frozenset()).field("norm").to_pylist()
    assert norms == [5**0.5, 0.0, 0.0, 1.0, 10**0.5, 5**0.5, 1.0]


def test_small_cells_are_written_without_a_sort_by_partition(spark, tmp_path):
    """Partitions come out whole, sorted inside, and the session's setting is as before."""
    def orders(df):
        with rows_as_sorted(spark):
            df.write.partitionBy("bucket").parquet(str(tmp_path / "rows"))

    rows = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("n"), (F.col("id") % 20).alias("bucket"))
    orders(rows.coalesce(1).sortWithinPartitions("n"))
    assert spark.conf.get(OPEN_FILES_KEY, None) is None
    stored = spark.read.parquet(str(tmp_path / "rows")).withColumn("file", F.input_file_name())
    assert stored.select("n", "bucket").exceptAll(rows).isEmpty() and stored.count() == 3000
    lists = stored.withColumn("at", F.monotonically_increasing_id()).groupBy("bucket", "file").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("l"))
    assert sum([x["n"] for x in r["l"]] == sorted(x["n"] for x in r["l"]) for r in lists.collect()) >= OPEN_FILES


def test_figures_of_blocks_are_spread_as_the_index_grows(spark):
    """Tasks follow the cells, not the session's shuffle partitions."""
    rows = [(i % 2, i % 60, f"t{i % 7}", 1 + i % 4, 1.0 + i % 2) for i in range(400)]
    postings = spark.createDataFrame(rows, "term_bucket long, doc_block long, term string, tf long, norm double")
    spread = index_module.term_blocks(postings, 30, 60)
    assert spread.rdd.getNumPartitions() == 60
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, index_module.term_blocks(postings).collect()))


# -- expansion over a fetch log ---------------------------------------------------
def plain_expansion(edges, log, seeds, most):
    """Level by level with one fetch of every waiting URL per level."""
    tried, state, waiting, depth = {}, {}, {}, 0
    for url in sorted(seeds):
        state[url], waiting[url] = depth, 0
    found = {}
    while waiting:
        new = set()
        for url in list(waiting):
            statuses = log.get(url, [])
            if waiting[url] >= min(most, len(statuses)):
                found[url] = (state[url], waiting[url], statuses[waiting[url] - 1] if waiting[url] else None, False)
                del waiting[url]
                continue
            waiting[url] += 1
            if statuses[waiting[url] - 1] == 200:
                found[url] = (state[url], waiting[url], 200, True)
                del waiting[url]
                new |= {b for a, b in edges if a == url and b not in state}
        depth += 1
        for url in sorted(new):
            state[url], waiting[url] = depth, 0
    return found


@pytest.mark.parametrize("seed, few", [(1, 10**6), (2, 1)])
def test_expansion_follows_the_fetch_log(spark, monkeypatch, seed, few):
    monkeypatch.setattr(crawl_module, "MAX_BROADCAST_ROWS", few)
    rnd = random.Random(seed)
    urls = [f"u{i:02}" for i in range(30)]
    edges = sorted({(rnd.choice(urls), rnd.choice(urls)) for _ in range(90)})
    log = {u: [rnd.choice([200, 200, 404, 429, 500]) for _ in range(rnd.randint(0, 4))] for u in urls}
    rows = [(10 * k + i, u, s) for u, own in log.items() for k, s in enumerate(own) for i in [rnd.randint(0, 9)]]
    log_frame = spark.createDataFrame(rows, "seq long, url string, status_code int")
    links = spark.createDataFrame(edges, "src string, dst string")
    got = expand_fetched(links, log_frame, seed_urls(links, "u00", "u01", "u02"), 10**6, max_attempts=3).collect()
    assert {r["url"]: tuple(r)[1:] for r in got} == plain_expansion(edges, log, ["u00", "u01", "u02"], 3)


def test_long_chain_over_a_log_keeps_its_plan(spark, monkeypatch):
    monkeypatch.setattr(crawl_module, "LEVELS_PER_TABLE", 4)
    edges = [(f"u{i:02}", f"u{i + 1:02}") for i in range(20)]
    log = spark.createDataFrame([(k, u, 200 if k == 2 or i % 3 else 500) for i, (u, _) in enumerate(edges) for k in (1, 2)], "seq long, url string, status_code int")
    links = spark.createDataFrame(edges, "src string, dst string")
    visited = expand_fetched(links, log, seed_urls(links, "u00"))
    rows = {r["url"]: r for r in visited.collect()}
    assert len(rows) == 21 and rows["u20"]["attempts"] == 0 and rows["u20"]["status_code"] is None
    assert rows["u20"]["depth"] == sum(1 if i % 3 else 2 for i in range(20))
    assert visited._jdf.queryExecution().analyzed().toString().count("LogicalRDD") <= 6
    assert expand_fetched(links, log, seed_urls(links, "u00"), max_webs=5).count() == 5


# -- postings, figures and grams are written where they are counted -----------------
def test_cells_are_counted_in_steps_that_cut_blocks(spark, monkeypatch):
    """Postings and figures of one pass against those of the plans, where a block goes on over several steps."""
    monkeypatch.setattr(index_module, "BYTES_IN_ORDER", 40)
    texts = [f"w{i % 7} ñ{i % 3} w{i % 7} x{i}" if i % 11 else "" for i in range(60)]
    rows = [(i, 1.0 + i % 5, i // 25, 0) for i in range(60)]
    names = ["text", "doc_id", "norm", "doc_block", "from_doc_block"]
    columns = [pa.array(texts)] + [pa.array(column) for column in zip(*rows)]
    batches = pa.table(columns, names).to_batches(max_chunksize=17)
    found = [r for batch in index_module._count_cells(iter(batches), 3) for r in batch.to_pylist()]
    docs = spark.createDataFrame([(*r, t) for r, t in zip(rows, texts)], "doc_id long, norm double, doc_block long, from_doc_block long, text string")
    bucket = index_module.term_bucket(F.col("term"), 3)
    postings = index_module.document_terms(docs, "doc_block", "from_doc_block").withColumn("term_bucket", bucket)
    for is_figure, plain in [(False, postings), (True, index_module.term_blocks(postings))]:
        got = [tuple(r[c] for c in plain.columns) for r in found if r["is_figure"] == is_figure]
        assert sorted(got) == sorted(map(tuple, plain.collect())) and len(got) > 30
    null = [r for r in found if r["is_figure"] and r["doc_id"] is not None or not r["is_figure"] and r["df"] is not None]
    assert not null


@pytest.mark.parametrize("per_block", [2, 20_000])
def test_saved_tables_equal_the_plans(spark, tmp_path, per_block):
    """Grouped and ungrouped blocks; ids that repeat; more buckets than open files."""
    texts = [f"palabra{i % 5} {'ab' * (i % 40)} ñandú{i}" for i in range(45)] + [None, ""]
    raw = spark.createDataFrame([(i - i % 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = index_module.build_documents(raw.withColumn("title", F.lit("t")).withColumn("url", F.lit("u")))
    path = str(tmp_path / "index")
    index_store.save_index(docs, path, 70, 2, per_block)
    index = index_store.load_index(spark, path)
    assert index.postings.columns == POSTINGS.names and index.term_blocks.columns == TERM_BLOCKS.names
    plain = index_module.document_terms(docs).select("term", "doc_id", "tf", "norm")
    assert index.postings.select("term", "doc_id", "tf", "norm").exceptAll(plain).isEmpty() and index.postings.count() == plain.count()
    summed = index_module.term_blocks(index.postings).select(*TERM_BLOCKS.names)
    assert index.term_blocks.exceptAll(summed).isEmpty() and index.term_blocks.count() == summed.count()
    held = index_module.term_bucket(F.col("term"), 70) != F.col("term_bucket")
    assert index.postings.filter(held).isEmpty() and index.term_blocks.filter(held).isEmpty()


def test_grouped_postings_are_not_moved(spark, tmp_path, monkeypatch):
    """Each task writes the buckets of its own blocks: documents are dealt, postings are not."""
    dealt = []
    by_cell = index_store._by_cell
    monkeypatch.setattr(index_store, "_by_cell", lambda rows, *more: dealt.append(rows.columns) or by_cell(rows, *more))
    raw = spark.createDataFrame([(i, f"casa árbol{i}") for i in range(9)], "doc_id long, text string")
    docs = index_module.build_documents(raw.withColumn("title", F.lit("t")).withColumn("url", F.lit("u")))
    index_store.save_index(docs, str(tmp_path / "index"), 2, 2, 4)
    assert dealt and all("text" in columns and "term" not in columns for columns in dealt)


def test_grams_of_batches_equal_plain_cuts(spark, monkeypatch):
    monkeypatch.setattr(rank_module, "TERMS_AT_ONCE", 3)
    terms = ["a", "ab", "ababab", "ñandú", "x𐐷y𐐷x𐐷y", "z" * 64, "abcde" * 30, "", "aaa"]
    frame = spark.createDataFrame([(t, 1, 1) for t in terms], VOCABULARY).coalesce(1)
    got = rank_module.term_grams(frame, 5)
    cut = lambda t: {t[i : i + 3] for i in range(len(t))}
    plain = sorted((g, t if len(t) <= 64 else "") for t in terms for g in cut(t))
    assert sorted((r["gram"], r["term"] or "") for r in got.collect()) == plain
    wrong = (F.col("term").isNotNull() & (F.xxhash64("term") != F.col("token"))) | (rank_module.gram_bucket(F.col("gram"), 5) != F.col("gram_bucket"))
    assert got.filter(wrong).isEmpty() and got.columns == GRAMS.names


# -- lists: one row per term and block ------------------------------------------------
def test_whole_blocks_are_counted_in_one_step(monkeypatch):
    """Small blocks are not cut by steps or batches; of a large one the figures follow in rows of their own."""
    monkeypatch.setattr(index_module, "BYTES_IN_ORDER", 60)
    sizes = [3, 3, 40, 3, 1]
    blocks = [b for b, n in enumerate(sizes) for _ in range(n)]
    columns = {"text": [f"casa w{i % 2}" for i in range(len(blocks))], "doc_id": range(len(blocks)), "norm": [1.0] * len(blocks)}
    rows = pa.table({name: list(c) for name, c in columns.items()} | {"doc_block": blocks, "from_doc_block": [0] * len(blocks)})
    found = [r for batch in index_module._list_cells(iter(rows.to_batches(max_chunksize=4)), 2) for r in batch.to_pylist()]
    own = {b: [r for r in found if r["term"] == "casa" and r["doc_block"] == b] for b in range(len(sizes))}
    assert [len(own[b]) for b in (0, 1, 3, 4)] == [1] * 4 and len(own[2]) > 3
    for b, n in enumerate(sizes):
        assert [(r["df"], r["cf"], r["top"]) for r in own[b] if r["df"] is not None] == [(n, n, 1.0)]
        ids = [p["doc_id"] for r in own[b] for p in r["postings"] or []]
        assert sorted(ids) == [i for i, at in enumerate(blocks) if at == b]


def test_grouped_blocks_are_stored_as_lists(spark, tmp_path):
    """A row per term and block, as many as figures, and no second table or row for these."""
    docs = documents(spark, range(60))
    index_store.save_index(docs, str(tmp_path / "index"), 2, 2, 20)
    (folder,) = (tmp_path / "index").glob("versions/*/postings")
    assert spark.read.parquet(str(folder)).count() == 60 + 3 and not list(tmp_path.glob("index/versions/*/term_blocks"))
    index = index_store.load_index(spark, str(tmp_path / "index"))
    assert index.postings.count() == 120 and index.term_blocks.count() == 63
    found = index.postings.filter("term = 'docencia'").groupBy("doc_block").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
    assert {r["doc_block"]: r["ids"] for r in found.collect()} == {b: list(range(20 * b, 20 * b + 20)) for b in range(3)}


def test_grams_are_stored_as_lists(spark, tmp_path, monkeypatch):
    """A row per gram where a task read its terms, and the counts and terms of a flat table; long terms by their hash."""
    docs = documents(spark, range(30), f"docencia {'xyz' * 30}")
    index_store.save_index(docs.coalesce(1), str(tmp_path / "index"), 2, 2, 20)
    index = index_store.load_index(spark, str(tmp_path / "index"))
    plain = rank_module.term_grams(index.vocabulary, 2)
    assert index.grams.columns == plain.columns == GRAMS.names and index.grams.count() == plain.count()
    assert index.grams.exceptAll(plain).isEmpty()
    (folder,) = (tmp_path / "index").glob("versions/*/grams")
    stored = spark.read.parquet(str(folder)).filter("gram = 'pal'").collect()
    assert sum(r["n_terms"] for r in stored) == 30 and len(stored) < 30
    assert index.gram_counts.exceptAll(plain.groupBy("gram").count()).isEmpty()
    words = spark.createDataFrame([("labra1",), ("zx",), ("ia",)], "word string")
    got = rank_module.expand_by_grams(index, rank_module.word_grams(index.gram_counts, words))
    assert got.groupBy("word").count().exceptAll(spark.createDataFrame([("labra1", 11), ("zx", 1), ("ia", 1)], "word string, n long")).isEmpty()


def test_few_words_do_not_move_the_grams(spark, tmp_path):
    index_store.save_index(documents(spark, range(30), f"docencia {'xyz' * 30}"), str(tmp_path / "index"), 2, 2, 20)
    index = index_store.load_index(spark, str(tmp_path / "index"))
    words = spark.createDataFrame([("labra1",), ("zxy",)], "word string")
    found = search_module.expand_by_lookup(index, words)
    main = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "SortMergeJoin" not in main and "IsNull(token)" in main and "IsNotNull(token)" in main
    plain = rank_module.expand_by_grams(index, rank_module.word_grams(index.gram_counts, words))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect())) and found.count() == 12


# -- postings with their documents and terms --------------------------------------
def plain_description(index):
    documents = index.documents.select("doc_id", F.col("norm").alias("document_norm"), "url")
    return index.postings.join(documents, "doc_id").join(index.vocabulary, "term").select(*DESCRIBED.names)


@pytest.mark.parametrize("per_block, buckets", [(3, 4), (3, 20), (20_000, 4)])
def test_described_postings_equal_plain_joins(spark, tmp_path, monkeypatch, per_block, buckets):
    """Several cells; ids that repeat, a norm that differs from its copy, documents without text or URL."""
    monkeypatch.setattr(index_module, "DOCS_PER_GROUP", 6)
    texts = [f"palabra{i % 5} casa {'ab' * (i % 40)} ñandú{i} casa" for i in range(90)] + [None, ""]
    rows = [(i - i % 2 if i < 30 else i * 7, None if i == 3 else f"u{i}", t) for i, t in enumerate(texts)]
    raw = spark.createDataFrame(rows, "doc_id long, url string, text string")
    path = str(tmp_path / "index")
    index_store.save_index(index_module.build_documents(raw.withColumn("title", F.lit("t"))), path, buckets, 2, per_block)
    saved = index_store.load_index(spark, path)
    changed = F.when(F.col("doc_id") == 350, F.lit(0.5)).when(F.col("doc_id") != 357, F.col("norm"))
    index = replace(saved, documents=saved.documents.withColumn("norm", changed), vocabulary=saved.vocabulary.filter("term <> 'palabra3'"))
    got, plain = (sorted(map(str, frame.collect())) for frame in (described_postings(index), plain_description(index)))
    assert got == plain and len(got) > 300
    assert described_postings(index).columns == DESCRIBED.names


@pytest.mark.parametrize("odd", [lambda d, k: d / 3, lambda d, k: None if d == 2 else d / 3, lambda d, k: d / (k % 2 + 1)])
def test_described_lists_are_met_in_steps(monkeypatch, odd):
    """Batches that cut cells, rows of the result in small batches, ids without document, stored norms that are null or differ."""
    monkeypatch.setattr(described_module, "BYTES_PACKED", 200)
    monkeypatch.setattr(described_module, "ROWS_AT_ONCE", 3)
    kinds = {"doc_id": pa.int64(), "tf": pa.int64(), "norm": pa.float64()}
    lists = [[{"doc_id": d if d != 4 else None, "tf": 300 * d + 1, "norm": odd(d, k)} for d in range(k % 5, 7)] for k in range(40)]
    by_list = {name: pa.array([[p[name] for p in postings] for postings in lists], pa.list_(kind)) for name, kind in kinds.items()}
    table = pa.table({"cell": pa.array([k // 15 for k in range(40)], pa.int32()), "term": [f"t{k}" for k in range(40)], **by_list})
    packed = list(described_module._pack_lists(iter(table.to_batches(max_chunksize=7))))
    documents = [(cell, d, None if d is None else d / 3, f"u{cell}.{d}.{k}") for cell in range(3) for d in (None, 6, 2, 0, 1, 3) for k in range(1 + d % 3 if d else 1)]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*documents), (pa.int32(), pa.int64(), pa.float64(), pa.string()))]
    names = ["cell", "doc_id", "document_norm", "url"]
    described = list(described_module._pack_rows(iter(pa.table(columns, names).to_batches(max_chunksize=4))))
    assert len(packed) > 3
    of_terms = pa.table({"cell": pa.array([k // 15 for k in range(40)], pa.int32()), "term": [f"t{k}" for k in range(40)], "df": range(40)})
    of_terms = of_terms.filter(pc.not_equal(of_terms["term"], "t8"))
    terms = list(described_module._pack_rows(iter(of_terms.to_batches(max_chunksize=4))))
    schema = pa.schema({"cell": pa.int32(), "kind": pa.int32(), "packed": pa.binary()})
    rows = []
    for cell in range(3):
        held = [(described_module.DOCUMENTS, described), (described_module.TERMS, terms), (described_module.LISTS, packed)]
        rows += [{"cell": cell, "kind": kind, "packed": r["packed"]} for kind, found in held for b in found for r in b.to_pylist() if r["cell"] == cell]
    batches = pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=11)
    found = list(described_module._meet(iter(batches)))
    assert max(map(len, found)) == 3
    got = [tuple(r.values()) for b in found for r in b.to_pylist()]
    plain = [
        (f"t{k}", p["doc_id"], p["tf"], p["norm"], d[2], d[3], k)
        for k, postings in enumerate(lists)
        if k != 8
        for p in postings
        for d in documents
        if d[0] == k // 15 and p["doc_id"] is not None and d[1] == p["doc_id"]
    ]
    assert sorted(map(str, got)) == sorted(map(str, plain))


def test_registered_round_trip_moves_no_posting_by_itself(spark):
    """Postings move in lists that are packed, so no row of an exchange is a posting."""
    found = QUERIES["index_round_trip"](spark, "/root/testdata/sf0.001")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "doc_id" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_saved_tables_leave_no_moved_rows(spark, tmp_path):
    """Shuffle files of the tables of a save go with it, and do not wait for the driver's garbage; tables are packed tightly."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles())
    moved = lambda: {f.getName(): f.length() for f in files() if f.getName().startswith("shuffle_")}
    rnd = random.Random(1)
    texts = [(i, "t", "u", " ".join(f"{rnd.getrandbits(128):x}" for _ in range(60))) for i in range(1000)]
    rows = spark.createDataFrame(texts, "doc_id long, title string, url string, text string")
    before = moved()
    index_store.save_index(build_documents(rows), str(tmp_path / "index"), 4, 2, 100)
    end = time.time() + 20
    while (left := sum(size for name, size in moved().items() if name not in before)) > 200_000 and time.time() < end:
        time.sleep(0.2)
    assert left <= 200_000  # ids and counts; the texts alone are 2 MB and move twice
    assert spark.conf.get(DROP_MOVED_KEY) == "false"
    folder = manifest.latest(spark, str(tmp_path / "index"))[0]["folder"]
    stored = [file for table in ("documents", "postings", "vocabulary", "grams") for file in Path(folder, table).rglob("*.parquet")]
    assert stored and all(".zstd." in file.name for file in stored)
