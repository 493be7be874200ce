"""Random corpora and queries against a direct per-document definition."""

import itertools
import math
import random
from collections import Counter

import pytest

from acervo import session as session_module
from acervo.operators import query_table as qt
from acervo.operators import rank as rk
from acervo.operators.index import build_documents, index_from_documents
from acervo.plans import search as search_module
from acervo.plans.search import match_one, rejected_queries, search_batch
from acervo.sources.index_store import load_index, save_index

WORDS = ["a", "ab", "aba", "ababa", "b", "ba", "Ab", "zz", "q", "ñu", "AB", "x" * 70 + "aba" + "y" * 70, "yx"]


class Direct:
    """One query evaluated the slow way: parse by recursion, count in the text."""

    def __init__(self, line):
        self.tokens = line.replace("(", " ( ").replace(")", " ) ").split()
        self.words = [t for t in self.tokens if t not in ("AND", "OR", "NOT", "(", ")")]

    def truth(self, present):
        value, rest = self._chain(self.tokens, present)
        assert not rest
        return value

    def _operand(self, tokens, present):
        head, rest = tokens[0], tokens[1:]
        if head == "NOT":
            value, rest = self._operand(rest, present)
            return not value, rest
        if head == "(":
            value, rest = self._chain(rest, present)
            return value, rest[1:]
        return head in present, rest

    def _chain(self, tokens, present):
        value, rest = self._operand(tokens, present)
        while rest and rest[0] in ("AND", "OR"):
            other, after = self._operand(rest[1:], present)
            value = (value and other) if rest[0] == "AND" else (value or other)
            rest = after
        return value, rest

    def score(self, text, norm):
        """Occurrences by an explicit scan, each query word weighted by its repeats in the query."""
        weights, hits, length = Counter(self.words), 0, 0
        for word, weight in weights.items():
            if text.find(word) >= 0:
                length += weight * weight
            low, at = word.lower(), 0
            while (at := text.find(low, at)) >= 0:
                hits, at = hits + weight, at + len(low)
        return hits / norm / math.sqrt(length) if length else 0.0


def random_query(rng, size):
    def operand(depth):
        negation = "NOT " if rng.random() < 0.25 else ""
        if depth < 3 and rng.random() < 0.3:
            return f"{negation}({chain(depth + 1, rng.randint(1, 3))})"
        return negation + rng.choice(WORDS)

    def chain(depth, length):
        parts = [operand(depth)]
        for _ in range(length - 1):
            parts += [rng.choice(["AND", "OR"]), operand(depth)]
        return " ".join(parts)

    return chain(0, size)


def brute_force(texts, line, n):
    query = Direct(line)
    ranked = []
    for doc_id, text in texts.items():
        tokens = text.split()
        norm = math.sqrt(sum(tokens.count(w) ** 2 for w in set(tokens)))
        if query.truth(set(tokens)):
            ranked.append((-query.score(text, norm), doc_id))
    return [(doc_id, -score) for score, doc_id in sorted(ranked)[:n]]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    texts = {}
    for doc_id in rng.sample(range(500), 90):
        length = rng.choice([0, 1, 3, 12])
        texts[doc_id] = " ".join(rng.choice(WORDS).lower() for _ in range(length))
    rows = [(i, "t", f"u{i}", t) for i, t in texts.items()]
    raw = spark.createDataFrame(rows, "doc_id long, title string, url string, text string")
    documents = build_documents(raw, stop=(), docs_per_block=7)
    path = str(tmp_path_factory.mktemp("index") / "random")
    save_index(documents, path, term_buckets=4, doc_splits=3, docs_per_block=7)
    return texts, load_index(spark, path), index_from_documents(documents, 7)


@pytest.mark.parametrize("n,broadcast", [(1, True), (10, True), (200, True), (4, False)])
def test_batch_against_brute_force(spark, corpus, monkeypatch, n, broadcast):
    texts, stored, in_plan = corpus
    if not broadcast:
        monkeypatch.setattr(session_module, "MAX_BROADCAST_ROWS", 0)
        monkeypatch.setattr(search_module, "MAX_BROADCAST_ROWS", 0)
    rng = random.Random(n)
    lines = [random_query(rng, rng.randint(1, 5)) for _ in range(60)]
    lines.append(" OR ".join(f"w{i}" for i in range(130)) + " OR ab AND NOT zz")
    lines.append("NOT (" + " AND ".join(f"w{i}" for i in range(70)) + ") AND NOT ab")
    lines.append(" OR ".join(["ab", "b", "ñu", "q", "zz", "Ab", "ba", "aba", "a", "yx"]))
    queries = spark.createDataFrame(list(enumerate(lines)), "query_id long, line string")
    expected = {}
    canon = {r["query_id"]: r["canon"] for r in qt.query_table(queries).collect()}
    for i, line in enumerate(lines):
        expected.setdefault(canon[i], [(d, round(s, 9)) for d, s in brute_force(texts, line, n)])
    index = stored if n != 10 else in_plan
    got = {}
    for r in sorted(search_batch(index, queries, n).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query"], []).append((r["doc_id"], round(r["score"], 9)))
    assert got == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("line", ["ab AND NOT (b OR zz)", "NOT ab", "zz OR NOT (q AND ñu) AND a"])
def test_match_one(corpus, line):
    texts, stored, in_plan = corpus
    expected = sorted(d for d, t in texts.items() if Direct(line).truth(set(t.split())))
    for index in (stored, in_plan):
        assert sorted(r["doc_id"] for r in match_one(index, line).collect()) == expected


def valid_by_grammar(kinds):
    """E = X (op X)*, X = [N] (W or L E R)."""

    def operand(i):
        if i < len(kinds) and kinds[i] == "N":
            i += 1
        if i < len(kinds) and kinds[i] == "W":
            return i + 1
        if i < len(kinds) and kinds[i] == "L":
            end = expression(i + 1)
            if end is not None and end < len(kinds) and kinds[end] == "R":
                return end + 1
        return None

    def expression(i):
        i = operand(i)
        while i is not None and i < len(kinds) and kinds[i] in "AO":
            i = operand(i + 1)
        return i

    return expression(0) == len(kinds)


def test_validity_of_all_short_queries(spark):
    texts = {"A": "AND", "O": "OR", "N": "NOT", "L": "(", "R": ")", "W": "w"}
    kinds = ["".join(k) for n in range(6) for k in itertools.product("AONLRW", repeat=n)]
    lines = [(i, " ".join(texts[c] for c in k)) for i, k in enumerate(kinds)]
    rows = qt.query_table(spark.createDataFrame(lines, "query_id long, line string").repartition(8))
    for r in rows.select("query_id", "kinds", "valid", "reason", "canon").collect():
        assert r["kinds"] == kinds[r["query_id"]]
        assert r["valid"] == valid_by_grammar(r["kinds"]), r
        assert (r["reason"] is None) == r["valid"] == (r["canon"] is not None)


def test_query_columns(spark):
    lines = ["mente AND NOT ado OR tion", "((tion) )", "a\tAND(b\nOR NOT c)", "and", "a b", "a ANDb"]
    table = qt.query_table(spark.createDataFrame(list(enumerate(lines)), "query_id long, line string"))
    canon = [r["canon"] for r in table.orderBy("query_id").collect()]
    assert canon == ["((mente AND NOT ado) OR tion)", "tion", "(a AND (b OR NOT c))", "and", None, None]
    assert table.filter("query_id = 2").first()["tokens"] == ["a", "AND", "(", "b", "OR", "NOT", "c", ")"]
    rejects = rejected_queries(table.select("query_id", "line")).collect()
    assert sorted((r["query_id"], r["reason"]) for r in rejects) == [
        (4, "operator missing"), (5, "operator missing")
    ]


def test_expansion_by_grams_against_every_pair(spark, tmp_path):
    rng = random.Random(11)
    drawn = {"".join(rng.choice("abñ") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    drawn |= {"x" * 63 + "ab" + "y" * n for n in (0, 1, 2, 70)} | {"ab" * 40, "b" * 64, "b" * 65, "b" * 66 + "ñ", "1a"}
    raw = spark.createDataFrame([(i, "t", f"u{i}", t) for i, t in enumerate(sorted(drawn))], "doc_id long, title string, url string, text string")
    save_index(build_documents(raw, stop=[]), str(tmp_path / "grams"), 4, 2, 50)
    index = load_index(spark, str(tmp_path / "grams"))
    words = ["a", "A", "ñ", "ab", "AB", "bb", "aba", "abAB", "b" * 30, "xab", "y" * 10, "ab" * 35, "ñb", "1", "none", "bbñ", "x" * 64 + "ab"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    found = rk.expand_by_grams(index, rk.word_grams(index.gram_counts, table)).collect()
    terms = [r["term"] for r in index.vocabulary.collect()]
    assert set(terms) == drawn
    plain = [(t, w, t.count(w.lower()), w in t, w == t) for t in terms for w in words if w.lower() in t]
    assert sorted(tuple(r) for r in found) == sorted(plain)


def test_longer_words_meet_the_terms_of_one_gram(spark, corpus):
    index = corpus[1]
    table = spark.createDataFrame([("ababa",), ("zzz",), ("q",)], "word string")
    rows = rk.word_grams(index.gram_counts, table).collect()
    assert sorted({r["word"] for r in rows if len(r["word"]) > 2}) == ["ababa", "zzz"]
    assert len([r for r in rows if r["word"] == "ababa"]) == 1
