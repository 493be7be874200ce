import random
import time

from pyspark.sql import functions as F

from acervo.llm import url_filter
from acervo.llm.queries import RULES


def plain(url, rules):
    """Host, path and the longest rule by looking at every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:stop], rest[stop:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1]), len(r[2]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y#z", "x://example.org/es", "x://example.org/en/1", "x://example.org/en/12/3", "x://org", "x://org/",
    "x://notexample.org/es/", "x://example.com/fr/a", "x://a.b.com/de/", "x://com/de/x://com/fr/", "x://a.com?x/de/", "x://a.com#/de/", "x://ÀB.com/fr/",
    "a://b://com/de/", "x://user@example.org:80/en/1", "x://.org/", "x://a..org/", "x://a.com//de/", "line\nbreak://a.com/de/\nx", "x://" + "a." * 5000 + "org/" + "p/" * 5000,
]


def check(spark, urls, rules):
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = {r["page_id"]: r for r in url_filter.judge(frame, rules).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        r = rows[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(url, rules), url


def test_contract_rules(spark):
    rnd = random.Random(1)
    hosts, tails = ["a.example.org", "example.org", "b.com", "com", "x.net"], ["", "/", "/es/", "/es/q", "/en/1", "/en/19", "/en/2", "/fr/", "/fr", "/de/x"]
    check(spark, URLS + [f"https://{rnd.choice(hosts)}{rnd.choice(tails)}" for _ in range(200)], RULES)


def test_many_rules_in_several_tries(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TRIE_RULES", 7)
    rnd = random.Random(2)
    host = lambda: ".".join(rnd.choices("abc", k=rnd.randrange(1, 4)))
    path = lambda: "".join(rnd.choices(["/", "a", "b", "/a"], k=rnd.randrange(0, 4)))
    rules = list({(h, p): (rnd.choice(["allow", "block"]), h, p) for h, p in ((host(), path()) for _ in range(60))}.values())
    check(spark, [f"x://{host()}{path()}" for _ in range(400)], rules)


def test_repeated_rules_block(spark):
    frame = spark.createDataFrame([("x://a.com/",)], "url string")
    rules = [("block", "com", "/"), ("allow", "com", "/")]
    assert url_filter.judge(frame, rules).first()["verdict"] == "block"
    assert url_filter.judge(frame, [], default="block").first()["verdict"] == "block"
    assert url_filter.judge(frame.filter(F.lit(False)), rules).collect() == []


def test_many_rules_of_one_host_are_not_scanned():
    rules = [("block" if i % 3 else "allow", "example.org", f"/item-{i}") for i in range(100_000)]
    trie = url_filter.Trie(rules)
    started = time.perf_counter()
    for i in range(5_000):
        assert trie.find("www.example.org", f"/item-{i * 20}x/more")[1] == f"example.org/item-{i * 20}"
    assert time.perf_counter() - started < 1


def test_repeated_rows_long_urls_and_empty_tables(spark):
    long = "x://" + "a." * 20_000 + "com/" + "de/" * 20_000
    frame = spark.createDataFrame([(long,), (long,), (None,)], "url string")
    rows = url_filter.judge(frame, [("block", "com", "/de/"), ("allow", "com", "/de/" * 2)]).collect()
    assert [r["rule"] for r in rows if r["url"]] == ["com/de/"] * 2
    assert url_filter.judge(frame.filter(F.lit(False)), RULES).columns == ["url", "host", "path", "rule", "verdict"]
