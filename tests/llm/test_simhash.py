import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from acervo.llm import simhash


def plain_fingerprint(text, size=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    grams = [words[i : i + size] for i in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64(b" ".join(g), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(fps, distance):
    """Smallest index of each fingerprint's component, by comparing all pairs."""
    root = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= distance and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


def signed(value):
    return int(np.uint64(value).astype(np.int64))


def clustered(rnd, centres, around):
    out = []
    for _ in range(centres):
        own = rnd.getrandbits(64)
        for _ in range(around):
            out.append(own)
            own ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6)))
    return out


def test_fingerprint_is_the_majority_of_shingle_hashes():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choices(["Ab", "c", "é", "dd\x0be", "f g"], k=n)) for n in (0, 1, 2, 3, 4, 50)] + [None, " \t\n", "A"]
    for text in texts:
        assert simhash.fingerprint(None if text is None else text.encode()) == signed(plain_fingerprint(text))


def test_spark_hash_agrees(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a bb ç")).alias("h")).first()
    assert signed(simhash.digest("a bb ç".encode())) == row["h"]


def test_allocation_covers_every_pair():
    rnd = np.random.default_rng(2)
    costs = [rnd.random((50, 5)) for _ in range(4)]
    units = simhash.allocate(costs)
    assert (units.sum(axis=1) == 4).all()
    at = np.arange(50)
    own = sum(c[at, units[:, i]] for i, c in enumerate(costs))
    for a in range(5):
        for b in range(5 - a):
            for c in range(5 - a - b):
                d = 4 - a - b - c
                assert (own <= costs[0][:, a] + costs[1][:, b] + costs[2][:, c] + costs[3][:, d] + 1e-9).all()


def test_shells_count_values_by_distance():
    rnd = np.random.default_rng(3)
    count = rnd.integers(0, 5, 64).astype(float)
    table = simhash.shells(count, 3)
    for v in range(64):
        for e in range(4):
            assert table[e, v] == sum(count[w] for w in range(64) if (v ^ w).bit_count() == e)


def test_parts_hold_each_bit_once():
    together = np.eye(64) * 50
    for n in (10, 10**7, 10**10):
        parts = simhash.group_bits(n, together, 3)
        assert sorted(b for part in parts for block in part for b in block) == list(range(64))
        assert all(len(block) <= simhash.SUB_BITS for part in parts for block in part)


def links_match(spark, fps, block=simhash.BLOCK):
    fps = sorted({signed(x) for x in fps})
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = simhash.fingerprint_links(frame, 3, block)
    roots = {r["node"]: r["root"] for r in simhash.connect(links).collect()}
    expected = plain_roots([x & (1 << 64) - 1 for x in fps], 3)
    for fp, root in zip(fps, expected):
        assert roots.get(fp, fp) == fps[root]


def test_links_against_all_pairs(spark):
    links_match(spark, clustered(random.Random(4), 12, 12))


def test_crowded_values_are_compared_in_blocks(spark):
    rnd = random.Random(5)
    common = rnd.getrandbits(64)
    links_match(spark, [common ^ sum(1 << b for b in rnd.sample(range(64), 2)) for _ in range(120)], block=16)


def test_wider_parts_find_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "part_count", lambda n, distance: 2)
    links_match(spark, clustered(random.Random(6), 8, 6))


def test_long_chains_become_one_component(spark):
    chain = [0]
    for b in range(60):
        chain.append(chain[-1] | 1 << b)
    links_match(spark, chain)


DOCS = [
    (1, "A b c d e f g", "x"),
    (2, "a B c d e f g", "y"),
    (3, None, "x"),
    (4, "", "x"),
    (None, " \n", "x"),
    (5, "other words are here for sure", "x"),
    (5, "other words are here for sure", "x"),
    (7, "other words are here for sure", None),
    (8, "long " * 20_000 + "end", "x"),
]


def test_documents_of_all_kinds(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, fp string")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    got = sorted((r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in rows)
    texts = [(i or 0, f"{plain_fingerprint(t):016x}") for i, t, _ in DOCS]
    component = {0: 3, 1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 7: 5, 8: 8}
    assert got == sorted((i, fp, component[i]) for i, fp in texts)


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, _k1 string")
    rows = simhash.keep_one(docs)
    assert rows.columns == docs.columns
    assert sorted(r["doc_id"] for r in rows.collect()) == [1, 3, 5, 8]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []


def test_rounds_of_an_ordered_chain_stay_few(spark, monkeypatch):
    rounds = []
    written = simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name, *more: rounds.append(name) or written(df, name, *more))
    chain = spark.createDataFrame([(i, i + 1) for i in range(63)], "a long, b long")
    assert {tuple(r) for r in simhash.connect(chain).collect()} == {(i, 0) for i in range(64)}
    assert len(rounds) <= 12
