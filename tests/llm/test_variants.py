import random
import re
import zlib
from collections import Counter

import pytest

from acervo.llm import variants


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows):
    """The contract, word by word and pair by pair."""
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if distance_one(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return out


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def corpus(seed, letters, size):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(7, 11))) for _ in range(40)]

    def edited(word):
        at = rnd.randrange(len(word))
        return rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice(letters) + word[at:], word[:at] + rnd.choice(letters) + word[at + 1 :]])

    rows = []
    for i in range(size):
        words = []
        for _ in range(40):
            word = base[min(int(rnd.expovariate(0.15)), 39)]
            for _ in range(rnd.choice([0] * 12 + [1, 1, 2])):
                word = edited(word)
            words.append(rnd.choice([word, word.upper(), word.capitalize()]))
        rows.append((i, rnd.choice([" ", ", ", "-"]).join(words)))
    return rows


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnopÀÉÿ"])
def test_equals_the_plain_definition(spark, letters):
    rows = corpus(len(letters), letters, 120)
    expected = plain(rows)
    assert any(form for _, form, *_ in expected)
    assert found(variants.group(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(expected, key=str)


def test_whole_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert found(variants.group(docs)) == sorted(plain(map(tuple, docs.collect())), key=str)


def test_forms_in_chains(spark):
    rows = [(1, " ".join(["karbonade"] * 300 + ["karbonada"] * 20 + ["karbonida"] * 2))]
    got = {w: (form, root) for w, form, root, *_ in found(variants.group(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got["karbonida"] == ("karbonada", "karbonade") and got["karbonada"] == ("karbonade", "karbonade") and got["karbonade"] == (None, "karbonade")


def test_unusual_rows(spark):
    long = "abcdefghij" * 3000
    rows = [(None, "wordlike wordlike", "x"), (1, None, "y"), (2, "", "z"), (3, "1 2 3 --", None), (4, long, "x"), (4, long, "x"), (5, "wordlikes wordlikes ABCDEF×ÿ abcdef×ÿ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    expected = plain([r[:2] for r in rows])
    assert found(variants.group(df)) == sorted(expected, key=str)
    empty = variants.group(df.limit(0))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_pivots_do_not_overlap_and_are_cheapest():
    rnd = random.Random(3)
    for _ in range(300):
        places = sorted(rnd.sample(range(12), rnd.randint(3, 6)))
        prefix = [(p, 0, rnd.randint(1, 9)) for p in places]
        cost = dict((p, c) for p, _, c in prefix)
        a, b = variants.pivots_of(prefix)
        assert b - a >= 2
        assert cost[a] + cost[b] == min(cost[x] + cost[y] for x in places for y in places if y - x >= 2)
