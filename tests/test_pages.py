import json
import os

import pytest
from pyspark.sql import functions as F

from acervo.functions import html as hx
from acervo.functions import urls
from acervo.operators import links as lk
from acervo.operators.index import corpus_stats
from acervo.operators.links import hrefs
from acervo.plans import crawl as crawl_module
from acervo.plans.build import complete_pages, extract_pages, index_pages, rejected_pages
from acervo.plans.crawl import expand_fetched, expand_frontier, seed_urls
from acervo.plans.search import InvalidQuery, match_one, search_batch, search_one
from acervo.sources.index_store import load_index, load_stats
from acervo.sources.pages import read_page_files, read_pages_back, write_pages
from acervo.sources.query_files import read_query_file

RAW = [
    (0, "https://u.example/grado", '<html><head><title>Grado en Datos</title></head><body><div class="page main"><h1>Grado en Datos</h1><p>El grado, la docencia: <b>docencia</b>.</p></div></body></html>', "html"),
    (1, "https://u.example/vacia?x=1", "<html><head><title></title></head><body><p>fuera del bloque</p></body></html>", "html"),
    (2, "https://u.example/docs/master.plan.pdf", "Máster y posgrado\nmaster-plan 2024", "pdf"),
    (3, "https://u.example/corta", '<body><div class="page"><p>Docencia</p><p>¿Qué es?</p></div></body>', "html"),
]
SEARCHES = {
    "docencia": [(3, 1.0), (0, 0.801783725737)],
    "grado": [(0, 0.534522483825)],
    "NOT docencia": [(1, 0.0), (2, 0.0)],
    "grado OR NOT docencia": [(0, 0.944911182523), (2, 0.5), (1, 0.0)],
    "Grado OR docencia": [(0, 1.336306209562), (3, 1.0)],
    "docencia OR docencia": [(3, 1.0), (0, 0.801783725737)],
    "docencia OR grado AND datos": [(0, 0.925820099773)],
    "NOT (grado OR datos)": [(2, 0.5), (1, 0.0), (3, 0.0)],
    "GRADO": [],
}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    raw = spark.createDataFrame(RAW, "doc_id long, url string, text string, type string")
    path = str(tmp_path_factory.mktemp("index") / "golden")
    return index_pages(raw, path, term_buckets=3, doc_splits=2, docs_per_block=2)


def test_documents(index):
    rows = {r["doc_id"]: r for r in index.documents.collect()}
    assert [rows[i]["title"] for i in range(4)] == ["Grado en Datos", "None", "master.plan", ""]
    assert rows[0]["snippet"] == "Grado en Datos El grado, la docencia: docencia. docencia..."
    assert [rows[i]["snippet"] for i in (1, 3)] == ["...", "Docencia ¿Qué es?..."]
    assert [rows[i]["text"] for i in range(4)] == [
        "grado datos grado docencia docencia docencia",
        "",
        "máster posgrado master-plan 2024",
        "docencia",
    ]
    assert [rows[i]["norm"] for i in range(4)] == [3.7416573867739413, 0.0, 2.0, 1.0]


def test_statistics(index, spark):
    assert tuple(corpus_stats(index).first()) == (7, 4)


@pytest.mark.parametrize("line", SEARCHES)
def test_search(index, line):
    found = search_one(index, line).collect()
    assert [(r["doc_id"], round(r["score"], 12)) for r in found] == SEARCHES[line]
    assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
    assert sorted(r["doc_id"] for r in match_one(index, line).collect()) == sorted(
        doc for doc, _ in SEARCHES[line]
    )


def test_batch_and_limits(index, spark):
    lines = list(enumerate(["a b", "", *SEARCHES, "((docencia) )"]))
    queries = spark.createDataFrame(lines, "query_id long, line string")
    rows = search_batch(index, queries, 2).collect()
    by_query = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        by_query.setdefault(r["query"], []).append((r["doc_id"], round(r["score"], 12)))
    assert by_query["docencia"] == SEARCHES["docencia"]
    assert by_query["((docencia OR grado) AND datos)"] == SEARCHES["docencia OR grado AND datos"]
    assert by_query["NOT (grado OR datos)"] == SEARCHES["NOT (grado OR datos)"][:2]
    assert len(by_query) == len(SEARCHES) - 1
    assert search_batch(index, queries, 0).count() == 0
    assert search_batch(index, queries.limit(2)).count() == 0
    with pytest.raises(ValueError):
        search_batch(index, queries, -1)
    with pytest.raises(InvalidQuery):
        search_batch(index, queries, 2, strict=True)


def test_page_files_and_numbering(spark, tmp_path):
    for _, url, text, kind in RAW:
        folder = tmp_path / "pages" / url.removeprefix("https://").split("?")[0]
        os.makedirs(folder)
        (folder / "content.json").write_text(
            json.dumps({"url": url, "text": text, "type": kind}, indent=4), encoding="utf-8"
        )
    raw = read_page_files(spark, str(tmp_path / "pages"))
    assert raw.count() == 4
    built = index_pages(raw, str(tmp_path / "index"), term_buckets=2, doc_splits=1)
    numbered = {r["url"]: r["doc_id"] for r in built.documents.collect()}
    assert numbered == {url: i for i, url in enumerate(sorted(r[1] for r in RAW))}
    assert load_stats(spark, str(tmp_path / "index")).first()["n_words"] == 7
    reloaded = load_index(spark, str(tmp_path / "index"))
    first = search_one(reloaded, "docencia").first()
    assert (first["url"], first["snippet"]) == ("https://u.example/corta", "Docencia ¿Qué es?...")


def test_page_sink_keeps_the_later_page(spark, tmp_path):
    pages = spark.createDataFrame(
        [
            (1, "https://h/x?p=1", "old", "html"),
            (2, "https://h/x?p=2", "new", "html"),
            (3, "http://h/x", "other", "html"),
        ],
        "seq long, url string, text string, type string",
    )
    for file_format in ("parquet", "json"):
        path = str(tmp_path / file_format)
        write_pages(pages, path, file_format=file_format)
        kept = read_pages_back(spark, path)
        assert sorted(r["text"] for r in kept.collect()) == ["new", "other"]


def test_url_columns(spark):
    cases = ["https://h/x?a=1?b", "http://h/x", "https://h/x#top", "https://h/a/x.tar.pdf", "https://h/d.PDF/"]
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    url = F.col("url")
    rows = df.select(
        urls.storage_key(url).alias("key"), urls.document_type(url).alias("type"), urls.path_title(url).alias("title"),
        urls.storage_file("out", url).alias("file"),
    ).collect()
    assert [r["key"] for r in rows] == ["h/x", "http://h/x", "h/x#top", "h/a/x.tar.pdf", "h/d.PDF/"]
    assert [r["type"] for r in rows] == ["html", "html", "html", "pdf", "html"]
    assert [r["title"] for r in rows][1:] == ["x", "x#top", "x.tar", "d"]
    assert rows[0]["file"] == "out/h/x/content.json"


def test_found_urls(spark):
    hrefs = ["https://u.example/a", "https://u.example/a", "https://u.example.evil/b", "http://u.example/c",
             "/docs/x.pdf", "/docs/y.PDF", "z.pdf", "/k"]
    body = "".join(f'<a class="n" href="{h}">t</a>' for h in hrefs)
    body += "<!-- <a href='https://u.example/hidden'> --><script>'<a href=\"https://u.example/s\">'</script>"
    body += "<A HREF='/docs/w.pdf'>w</A><abbr href='/docs/no.pdf'>n</abbr><a data-href='/docs/no2.pdf'>n</a>"
    pages = spark.createDataFrame(
        [("https://u.example/p", body), ("https://u.example/q.pdf", body)], "url string, text string"
    )
    found = lk.page_links(pages, "https://u.example").collect()
    assert sorted((r["src"], r["dst"]) for r in found) == [
        ("https://u.example/p", u)
        for u in sorted(["https://u.example/a", "https://u.example.evil/b",
                         "https://u.example/docs/x.pdf", "https://u.example/docs/w.pdf"])
    ]


def test_fetch_log(spark):
    log = spark.createDataFrame(
        [(1, "a", 429), (2, "a", 200), (3, "b", 200), (4, "b", 500), (5, "c", 429)],
        "seq long, url string, status_code int",
    )
    rows = {r["url"]: (r["retry"], r["throttled"], r["was_throttled"]) for r in lk.fetch_outcome(log).collect()}
    assert rows == {"a": (False, False, True), "b": (True, False, False), "c": (True, True, True)}
    assert sorted(r["seq"] for r in lk.fetched_pages(log).collect()) == [2, 3]


@pytest.mark.parametrize("few", [10**6, 2])
def test_expansion(spark, monkeypatch, few):
    monkeypatch.setattr(crawl_module, "MAX_BROADCAST_ROWS", few)
    edges = [e.split(">") for e in "a>b a>c b>d c>d d>a d>e e>f".split()]
    links = spark.createDataFrame(edges, "src string, dst string")
    seed = seed_urls(links, "a")
    expected = [("a", 0), ("b", 1), ("c", 1), ("d", 2), ("e", 3), ("f", 4)]
    for cap in (1, 2, 5, 300):
        got = sorted(map(tuple, expand_frontier(links, seed, cap).collect()), key=lambda r: (r[1], r[0]))
        assert got == expected[:cap]


READER_CASES = [
    # html, title, body
    ("<title>a &amp; b&#233;&#x41;&copy;&nope;</title>", "a & béA©&nope", ""),
    ("<title>x<b>y</b></title>", "None", ""),
    ("<title><b>y</b></title>", "y", ""),
    ("<title> x </title><title>z</title>", " x ", ""),
    ('<div class="page"><p>a<p>b</div><p>c</p>', "", "ab b"),
    ('<div class="x page y"><p>a<br>b</p></b></div>', "", "ab"),
    ('<div class="page2"><p>no</p></div><div class="page"><h2>yes</h2><h4>no</h4></div>', "", "yes"),
    ('<div class="page"><p>a<script>s</script><!-- c --><style>t</style>d</p></div>', "", "ad"),
    ('<div class="page"><p>a<div><i>b</i></div></p><a href="/u">c</a></div><div class="page"><p>z</p></div>', "", "ab b c"),
    ('<div class="page"><p> \n </p><p>&lt;x&gt;</p></div>', "", "\n <x>"),
    ('<div class="page"><p/><p>k</p><img src="i"/></div>', "", " k"),
    ("", "", ""),
]


@pytest.mark.parametrize("html,title,body", READER_CASES)
def test_reader(html, title, body):
    got = hx.PageReader("div", "page", hx.TEXT_TAGS).read(html)
    assert got[:2] == (title, body)


def test_reader_as_a_job(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(READER_CASES)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in hx.read_pages(df).collect()}
    for i, (_, title, body) in enumerate(READER_CASES):
        assert (rows[i]["title"], rows[i]["body"]) == (title, body)
    assert rows[8]["hrefs"] == ["/u"]


def test_query_file(spark, tmp_path):
    lines = ["a AND b", "", "(c", "NOT d"]
    path = tmp_path / "queries.txt"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = read_query_file(spark, str(path)).orderBy("query_id").collect()
    assert [tuple(r) for r in rows] == list(enumerate(lines))


def test_long_and_unclosed_anchors(spark):
    many = "<a " + " ".join(f'x{i}="{i}"' for i in range(20_000)) + ' href="/found">'
    rows = [(1, many), (2, "<a " + "word " * 100_000), (3, '<a href="/k?x=1&amp;y=2&quot;">'), (4, "<a / href='/s'>"), (5, '<a href="/a&amp;lt;">')]
    frame = spark.createDataFrame(rows, "i int, html string").select("i", hrefs(F.col("html")).alias("h"))
    assert {r["i"]: r["h"] for r in frame.collect()} == {1: ["/found"], 2: [], 3: ['/k?x=1&y=2"'], 4: ["/s"], 5: ["/a&lt;"]}


def test_incomplete_pages_are_not_lost(spark):
    rows = [(1, "u1", "text", "pdf"), (2, "u2", "text", None), (3, None, "text", "pdf"), (4, "u4", None, "html")]
    raw = spark.createDataFrame(rows, "doc_id long, url string, text string, type string")
    assert extract_pages(complete_pages(raw)).count() == 1
    assert {r["doc_id"]: r["reason"] for r in rejected_pages(raw).collect()} == {2: "missing type", 3: "missing url", 4: "missing text"}
    with pytest.raises(Exception, match="page without"):
        extract_pages(raw).collect()


def test_equal_sequence_numbers_keep_their_pages(spark, tmp_path):
    rows = [(1, "https://u.example/a", "A", "html"), (1, "https://u.example/b", "B", "html"), (1, "https://u.example/b?x", "B2", "html")]
    write_pages(spark.createDataFrame(rows, "seq long, url string, text string, type string"), str(tmp_path / "pages"))
    assert sorted((r["url"], r["text"]) for r in read_pages_back(spark, str(tmp_path / "pages")).collect()) == [("https://u.example/a", "A"), ("https://u.example/b?x", "B2")]


def test_long_chain_keeps_short_plans(spark, monkeypatch):
    monkeypatch.setattr(crawl_module, "LEVELS_PER_TABLE", 3)
    chain = spark.createDataFrame([(f"u{i:02}", f"u{i + 1:02}") for i in range(11)], "src string, dst string")
    visited = expand_frontier(chain, seed_urls(chain, "u00"))
    assert [(r["url"], r["depth"]) for r in visited.orderBy("depth").collect()] == [(f"u{i:02}", i) for i in range(12)]
    assert visited._jdf.queryExecution().analyzed().toString().count("LogicalRDD") <= 4
