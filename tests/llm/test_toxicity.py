import random
from zlib import crc32

import numpy as np

from acervo.llm import toxicity as op


def plain_segments(scores):
    """Maximal segments by definition: the best segment, then the same left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 0 and (best is None or (total, -(b - a)) > (best[2], -(best[1] - 1 - best[0]))):
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, total = best
    left, right = plain_segments(scores[:a]), plain_segments(scores[b:])
    return left + [best] + [(x + b, y + b, t) for x, y, t in right]


def test_maximal_segments_against_the_definition():
    rnd = random.Random(1)
    for _ in range(400):
        scores = np.array([rnd.uniform(-3, 2) for _ in range(rnd.randrange(0, 18))])
        got, wanted = op.maximal_segments(scores), plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in wanted]
        assert np.allclose([s for *_, s in got], [s for *_, s in wanted])


def test_decay_of_a_known_law():
    values, share = np.array([1.0, -1.0]), np.array([300, 700])
    law = op.fit_law(share, values, [(3.0, 100.0, 5)])
    assert abs(law.decay - np.log(0.7 / 0.3)) < 1e-6


def test_curve_rises():
    rnd = np.random.default_rng(2)
    evidence = np.arange(40.0)
    weight = rnd.integers(1, 9, 40).astype(float)
    curve = op.fit_curve(evidence, np.minimum(weight, rnd.integers(0, 9, 40)) * (evidence > 20), weight)
    out = curve(np.linspace(-5, 60, 200))
    assert (np.diff(out) >= 0).all() and out.min() >= 0 and out.max() <= 1


def corpus(spark, n=900):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rnd.choice("abcdefghij") * rnd.randrange(1, 5) for _ in range(rnd.randrange(30, 150))]
        if toxic:
            for at in rnd.sample(range(len(words)), 4):
                words[at] = rnd.choice(["awful", "rotten", f"vilest{rnd.randrange(999)}"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    rows += [(5000, None, "x"), (5001, "", "x"), (None, "a bb", "x"), (7, rows[7][1], "y"), (5002, "a " * 40_000 + "awful rotten vilest7 " * 3, "x")]
    labels += [(3, None), (None, 1), (0, 1), (0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxicity string"), spark.createDataFrame(labels, "doc_id long, toxic int"), rows


def test_held_out_texts_and_odd_ones(spark):
    docs, labels, rows = corpus(spark)
    got = op.judged(docs, labels).collect()
    assert len(got) == len(rows)
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 4 == 2
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    own = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    right = sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in own)
    assert right >= 0.95 * len(own)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[5000] == by_id[5001] == min(by_id.values())
    assert by_id[5002] >= 0.3


def test_clean_rows_stay_as_they_are(spark):
    docs, labels, rows = corpus(spark)
    kept = op.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in op.judged(docs, labels).collect()}
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(str(r) for r in rows if not scores[r[0]])


def test_passages_name_the_toxic_words(spark):
    docs, labels, _ = corpus(spark)
    model = op.fit(docs, labels)
    text = "a bb ccc " * 20 + "awful rotten vilest5 " + "dd e " * 20
    probe = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = op.score(probe, model).first()["toxic_passages"]
    assert len(found) == 1 and (found[0]["start"], found[0]["end"]) == (60, 63)


def test_a_repeated_passage_is_found_each_time(spark):
    docs, labels, _ = corpus(spark)
    model = op.fit(docs, labels)
    insult, calm = "awful rotten vilest5 ", "dd e " * 40
    probe = spark.createDataFrame([(1, calm + insult + calm + insult + calm), (2, calm + "awful " * 12 + calm)], "doc_id long, text string")
    found = {r["doc_id"]: [(p["start"], p["end"]) for p in r["toxic_passages"]] for r in op.score(probe, model).collect()}
    assert found == {1: [(80, 83), (163, 166)], 2: [(80, 92)]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert op.judged(none, no_labels).collect() == []
    assert op.without_toxic(some, no_labels).count() == 1
