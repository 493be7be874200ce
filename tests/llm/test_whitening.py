import math

import numpy as np
import pytest

from acervo.llm import whitening


def plain(rows, most=16):
    """The contract with the dense covariance matrix and another eigensolver."""
    usable = [(i, e) for i, e in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in e]) for i, e in usable]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    out = {}
    for i, v in x:
        z = [n * c - s for c, s in zip(v, sums)]
        w = (np.array(z) / n) @ vectors / np.sqrt(values)
        out.setdefault(i, []).append((sum(c * c for c in z), w))
    return n, values / (centred**2).sum() * n, out


def agrees(df, rows, **options):
    n, explained, expected = plain(rows)
    got = whitening.whiten(df, **options).collect()
    assert len(got) == sum(map(len, expected.values())) * len(explained)
    by = {}
    for row in got:
        by.setdefault((row["vec_id"], row["component"]), []).append(row)
    signs = {}
    for (vec, component), own in by.items():
        for row in own:
            deviation, w = expected[vec][0]
            assert row["n"] == n and row["deviation"] == deviation
            assert abs(row["explained"] / explained[component - 1] - 1) < 1e-10 and row["identity_error"] < 1e-9
            want = w[component - 1]
            sign = signs.setdefault(component, 1 if want * row["whitened"] > 0 else -1) if abs(want) > 0.1 else signs.get(component)
            if sign:
                assert abs(sign * row["whitened"] - want) < 1e-6


def test_given_table_against_dense_matrix(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    agrees(df, [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_copies_nulls_and_clashing_columns(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, (rnd.normal(size=6) * [5, 4, 3, 2, 1, 0.5]).tolist()) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [(3, rows[3][1])]
    odd = [(200, None), (201, [1.0] * 5 + [None]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (204, [1e300] + [0.0] * 5), (205, []), (206, [1.0])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows + odd], "vec_id long, embedding array<double>, whitened double")
    agrees(df, rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_no_variance_gives_no_rows(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert got.collect() == [] and got.columns[0] == "vec_id"


def test_missing_rank_gives_fewer_components(spark):
    rows = [(i, [float(i % 7), float(i % 5), float(i % 7 + i % 5), 1.0]) for i in range(70)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1, 2}


def test_solver_on_close_and_repeated_eigenvalues():
    rnd = np.random.default_rng(5)
    d = 300
    q = np.linalg.qr(rnd.normal(size=(d, d)))[0]
    values = np.sort(np.concatenate([[50, 50, 49.999, 30, 30], np.linspace(20, 0, d - 5)]))[::-1]
    a = (q * values) @ q.T
    passes = []

    def product(u):
        passes.append(u.shape[1])
        return a @ u

    found, vectors = whitening.leading_pairs(product, d, 16)
    assert np.allclose(found, values[:16], rtol=1e-13)
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-11
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12


def test_minres_against_direct_solution():
    rnd = np.random.default_rng(6)
    a = rnd.normal(size=(30, 30))
    a = a + a.T
    b = rnd.normal(size=(30, 3))
    assert np.allclose(whitening.minres(lambda t: a @ t, b, 60, 1e-14), np.linalg.solve(a, b), atol=1e-7)


def test_sums_beyond_a_long(spark):
    rows = [(i, [1e16 * (i % 9 - 4), float(i)]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) >= 40 and all(r["deviation"] is None or r["deviation"] >= 0 for r in got)
