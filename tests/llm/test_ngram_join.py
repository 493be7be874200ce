import random

import numpy as np
import pytest

from acervo.llm import ngram_join


def plain(rows, percent=90):
    """Every pair of texts, by their sets of shingles."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found(df, **options):
    return sorted(map(tuple, ngram_join.join(df, **options).collect()), key=str)


def families(seed, size, words, edits, vocabulary=2000, passage=()):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    rows, doc = [], 0
    while len(rows) < size:
        base = [word() for _ in range(rnd.randint(3, words))] + list(passage) * rnd.randint(0, 1)
        for _ in range(rnd.choice([1, 1, 2, 5, 20])):
            own = list(base)
            for _ in range(rnd.randint(0, edits)):
                own[rnd.randrange(len(own))] = word()
            rows.append((doc, " ".join(own)))
            doc += 7
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, words, edits, vocabulary", [(1, 120, 3, 2000), (2, 60, 2, 8), (3, 400, 14, 500), (4, 12, 1, 3)])
def test_equals_all_pairs(spark, seed, words, edits, vocabulary):
    rows = families(seed, 250, words, edits, vocabulary, passage=[f"common{i}" for i in range(60)])
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_other_thresholds_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(ngram_join, "MOST_SENT", 0)
    rows = families(5, 200, 80, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (60, 80, 100):
        assert found(df, percent=percent) == plain(rows, percent)


def test_whole_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert found(docs) == plain(list(map(tuple, docs.collect())))


def test_large_group_of_near_copies(spark):
    """Each copy has one word of its own: all pairs would be 80,000 links."""
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(base[: i % 100] + [f"own{i}"] + base[i % 100 + 1 :])) for i in range(400)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_unusual_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(None, "a b c d", "p"), (9, "A B  c\td", "q"), (3, None, "r"), (4, "", None), (5, " \n ", "s"), (6, "one", "t"), (7, "ONE", "t")]
    rows += [(8, long, "u"), (2, long + " y", "v"), (2, long + " y", "v"), (1, "é É", "w"), (0, "É É", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string").withColumnRenamed("n", "node")
    assert found(df) == plain([r[:2] for r in rows])
    assert found(df.limit(0)) == []
    only_null = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert found(only_null) == [(None, 1, None), (None, 1, None)]


def test_prefix_of_several_matches_is_safe():
    """Two sets at the threshold share the smaller number of matches within their prefixes."""
    rnd = np.random.default_rng(0)
    for _ in range(500):
        common = rnd.integers(20, 60)
        extra = rnd.integers(0, common // 9 + 1)
        ids = rnd.permutation(1000)
        a, b = set(ids[:common]), set(ids[: common + extra])
        if 100 * len(a & b) < 90 * len(a | b):
            continue
        cut = lambda s, m: set(sorted(s)[: len(s) - -(-90 * len(s) // 100) + m])
        ma, mb = rnd.choice([1, 2, 3, 4, 8], 2)
        assert len(cut(a, ma) & cut(b, mb)) >= min(ma, mb)


def test_longer_prefixes_where_shingles_are_frequent():
    rare, frequent = np.full(40, 2), np.full(40, 5000)
    assert ngram_join.adaptive_matches(frequent, 0, 11, 100) > ngram_join.adaptive_matches(rare, 9, 11, 100)
