import itertools
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from acervo.llm import hmm


def tiny_model(symbols=5, states=3, seed=1):
    rnd = np.random.default_rng(seed)
    start, moves, emits = rnd.random(states), rnd.random((states, states)), rnd.random((symbols, states))
    return hmm.Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def by_paths(model, row):
    """Probability, and expected counts, from all state paths."""
    k = len(model.start)
    total, counts, moves, start = 0.0, np.zeros_like(model.emits), np.zeros_like(model.moves), np.zeros(k)
    for path in itertools.product(range(k), repeat=len(row)):
        p = model.start[path[0]] * np.prod([model.moves[a, b] for a, b in zip(path, path[1:])])
        p *= np.prod([model.emits[s, z] for s, z in zip(row, path)])
        total += p
        start[path[0]] += p
        for s, z in zip(row, path):
            counts[s, z] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
    return total, start / total, moves / total, counts / total


def test_forward_against_all_paths():
    model = tiny_model()
    rows = [np.array(r) for r in ([0], [1, 2], [4, 4, 4], [0, 1, 2, 3, 4, 0])] + [np.array([], dtype=int)]
    got = hmm.forward_log10(model, rows, together=2)
    for row, value in zip(rows, got):
        assert math.isclose(value, math.log10(by_paths(model, row)[0]) if len(row) else 0.0, rel_tol=1e-9)


def test_expected_counts_against_all_paths():
    model = tiny_model()
    rows = [np.array(r) for r in ([0, 1, 2, 3], [3, 0, 3], [4, 4], [1])]
    start, moves, counts, _ = hmm.expected_counts(model, *hmm.padded_in_order(rows))
    for whole, part in zip(hmm.summed_counts(model, iter(rows)), (start, moves, counts)):
        assert np.allclose(whole, part)
    plain = [by_paths(model, r) for r in rows]
    assert np.allclose(start, sum(p[1] for p in plain))
    assert np.allclose(moves, sum(p[2] for p in plain))
    assert np.allclose(counts, sum(p[3] for p in plain))


def test_stretches_go_on_where_the_last_one_ended(monkeypatch):
    monkeypatch.setattr(hmm, "LANES", 3)
    model = tiny_model()
    rnd = np.random.default_rng(4)
    rows = [rnd.integers(0, 5, n) for n in (1, 7, 8, 9, 40, 0, 16, 3, 100)]
    start, moves, counts = hmm.summed_counts(model, iter(rows), stretch=8)
    assert math.isclose(start.sum(), sum(len(r) > 0 for r in rows))
    assert math.isclose(moves.sum(), sum(max(len(r) - 1, 0) for r in rows))
    assert np.allclose(counts.sum(axis=1), np.bincount(np.concatenate(rows), minlength=5))
    # Two stretches by hand: the first knows nothing of the second, which begins with the first one's last shares.
    row = np.array([0, 3, 1, 4])
    first, both = by_paths(model, row[:2]), hmm.summed_counts(model, iter([row]), stretch=2)
    shares = model.start * model.emits[0] @ model.moves * model.emits[3]
    shares = shares / shares.sum()
    joint = np.einsum("i,ij,j,jk,k->ijk", shares, model.moves, model.emits[1], model.moves, model.emits[4])
    joint /= joint.sum()
    assert np.allclose(both[0], first[1])
    assert np.allclose(both[1], first[2] + joint.sum(axis=2) + joint.sum(axis=0))


def test_long_words_are_told_by_a_digest(spark):
    long = "a" * 5000
    assert hmm.tokens_of(b"aB " + long.encode()) != hmm.tokens_of(b"ab " + b"a" * 5001)
    assert max(map(len, hmm.tokens_of(long.encode()))) <= hmm.LONG
    docs = spark.createDataFrame([(1, f"x {long}"), (2, f"{long} {long}b"), (3, f"y {long}")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in hmm.score(docs, held_out=F.col("doc_id") == 3).collect()}
    assert (rows[3]["n_known"], rows[3]["train_tokens"], rows[2]["n_known"]) == (2, 6, 3)


def test_long_texts_are_scored_whole():
    model = tiny_model()
    row = np.random.default_rng(2).integers(0, 5, 5000)
    state, total = model.start * model.emits[row[0]], 0.0
    for s in row[1:]:
        total += math.log10(state.sum())
        state = (state / state.sum()) @ model.moves * model.emits[s]
    assert math.isclose(hmm.forward_log10(model, [row, row[:10]])[0], total + math.log10(state.sum()), rel_tol=1e-9)


def corpus(n=240):
    rnd = random.Random(3)
    tongues = [["le", "la", "un", "chat", "ici"], ["the", "a", "cat", "here", "is"]]
    rows = []
    for i in range(n):
        own = tongues[i % 2]
        rows.append((i, " ".join(rnd.choice(own) if rnd.random() < 0.9 else f"{own[0]}{rnd.randrange(400)}" for _ in range(rnd.randrange(5, 60)))))
    return rows + [(1000, None), (1001, ""), (1002, "\n \t"), (None, "the cat"), (3, "the cat the cat"), (3, "the cat the cat"), (1003, "new words only"), (1004, "the " * 30_000)]


def plain_words(text):
    return (text or "").lower().split() + [""]


def test_contract_columns_against_plain_counts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = hmm.score(docs, rounds=2, own_words=6, counted_words=9).collect()
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 7 == 2
    train = Counter(w for i, t in rows if not held(i) for w in plain_words(t))
    total, distinct = sum(train.values()), len(train)
    plain = Counter()
    for i, t in rows:
        tokens = plain_words(t)
        base = sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in tokens)
        plain[(i, held(i), len(tokens), sum(w in train for w in tokens), total, round(base, 6))] += 1
    seen = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert seen == plain


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    rows = hmm.score(docs, states=3, rounds=6, own_words=12, counted_words=40).filter("held_out and doc_id < 1000").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_of_all_one_word_texts_sum_to_one(spark):
    rows = [(i, f"{'ab'[i % 2]} w{i % 5}") for i in range(40)]
    probe = ["a", "b", *(f"w{i}" for i in range(5))]
    docs = spark.createDataFrame(rows + [(None, w) for w in probe], "doc_id long, text string")
    scored = hmm.score(docs, held_out=F.col("doc_id").isNull(), states=2, rounds=3, own_words=3, counted_words=5)
    total = sum(10 ** r["score"] for r in scored.filter("doc_id is null").collect())
    assert 0 < total < 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert hmm.score(docs).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = hmm.score(one, held_out=F.lit(True)).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 3)
    assert row["base_score"] == 0.0 and math.isfinite(row["score"])
