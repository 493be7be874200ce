import random

import numpy as np
from pyspark.sql import functions as F

from acervo.llm import dual_tree


def plain(rows, k):
    out = []
    own = sorted({(i, tuple(int(np.floor(64 * float(x))) for x in v)) for i, v in rows if i is not None and ok(v)})
    for q, v in own:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in own if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def ok(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def found(spark, rows, k=20):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    return sorted(map(tuple, dual_tree.search(frame, F.col("vec_id") % 20 == 0, k).collect()))


def random_rows(n, size, seed, ids=None):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.3, (5, size))
    values = (centres[rnd.integers(0, 5, n)] + rnd.normal(0, 0.1, (n, size))).astype(np.float32)
    return [(int(i), v.tolist()) for i, v in zip(ids or range(n), values)]


def test_against_all_pairs(spark):
    rows = random_rows(700, 16, 1)
    assert found(spark, rows) == plain(rows, 20)


def test_small_trees_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(dual_tree, "TREE_ROWS", 50)
    monkeypatch.setattr(dual_tree, "QUERY_BLOCK", 7)
    rows = random_rows(400, 8, 2)
    assert found(spark, rows, 5) == plain(rows, 5)


def test_keys_of_several_blocks_and_runs(spark, monkeypatch):
    monkeypatch.setattr(dual_tree, "TREE_ROWS", 30)
    monkeypatch.setattr(dual_tree, "QUERY_BLOCK", 3)
    monkeypatch.setattr(dual_tree, "MEETINGS", 1)
    monkeypatch.setattr(dual_tree, "SIDE", 4)
    rows = random_rows(500, 6, 7) + [(5000 + i, [0.25] * 6) for i in range(100)]
    assert found(spark, rows, 4) == plain(rows, 4)


def test_no_union_per_block(spark, monkeypatch):
    """Many blocks of queries are rows of one stage."""
    monkeypatch.setattr(dual_tree, "QUERY_BLOCK", 1)
    frame = spark.createDataFrame(random_rows(200, 4, 8), "vec_id long, embedding array<float>")
    plan = dual_tree.search(frame, F.col("vec_id") % 20 == 0, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan and "Cartesian" not in plan


def test_ties_copies_and_odd_rows(spark):
    rows = random_rows(90, 4, 3)
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(300)]
    rows += [(2000, None), (2020, [None, 1.0, 1.0, 1.0]), (2040, [float("nan"), 0.0, 0.0, 0.0]), (2060, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), rows[0], rows[0], (0, [1.0, 0.0, 0.0, 0.0]), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3020, []), (3021, [])]
    got = found(spark, rows)
    assert got == plain(rows, 20)
    assert (3000, 1, 3001, 64 * 64 * 4) in got and (3020, 1, 3021, 0) in got


def test_fewer_candidates_than_asked_for(spark):
    rows = random_rows(3, 4, 4)
    assert found(spark, rows) == plain(rows, 20)
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []


def test_tree_covers_its_points():
    points = np.random.default_rng(5).normal(size=(1500, 6))
    tree = dual_tree.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(1500))
    for node, (a, b) in enumerate(tree.spans):
        far = np.sqrt(((points[tree.order[a:b]] - tree.center_rows[node]) ** 2).sum(axis=1)).max()
        assert far <= tree.radius[node] + 1e-9
        if tree.children[node]:
            assert sorted(tree.spans[c] for c in tree.children[node])[0][0] == a
            assert sum(tree.spans[c][1] - tree.spans[c][0] for c in tree.children[node]) == b - a


def test_pruning_happens(monkeypatch):
    rnd = random.Random(6)
    monkeypatch.setattr(dual_tree, "LEAF", 8)
    points = np.array([[rnd.choice([0, 1000]) + rnd.randrange(20) for _ in range(3)] for _ in range(2000)])
    calls = []
    whole = dual_tree.products
    monkeypatch.setattr(dual_tree, "products", lambda a, b, exact: calls.append(len(a) * len(b)) or whole(a, b, exact))
    queries = dual_tree.Queries(np.arange(0, 2000, 20), points[::20], np.full(100, -np.inf))
    dual_tree.visit(queries, dual_tree.Best(queries.bounds, 5), dual_tree.Candidates(np.arange(2000), points, 5))
    assert sum(calls) < 0.5 * 100 * 2000
