"""Whitening of embeddings by leading covariance eigenvectors from a Jacobi-Davidson solver.

The covariance matrix is never formed. Each product of it with a few vectors is
one distributed pass over the distinct vectors, centred before multiplying; only
the small products reach the driver. The solver keeps a subspace and the products
of its basis. A Rayleigh-Ritz step gives the best pairs in it; pairs whose
residual is at the rounding level are locked. For the others a few steps of
MINRES solve the correction equation, projected against all wanted vectors, and
the corrections widen the subspace. Long subspaces start anew from their best
Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acervo.llm.common import stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
INNER_STEPS = 4  # of MINRES for one correction
OUTER_STEPS = 300
SAFE = 1 << 62  # whole numbers below this are added and multiplied as 64-bit ones

Product = Callable[[np.ndarray], np.ndarray]


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, x)``: usable vectors as whole numbers. All are of the length that most of them have."""
    own = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    # A null vector, and one with an entry that is null, infinite, no number or beyond a long's range.
    bad = F.expr(f"e is null or size(e) = 0 or exists(e, c -> c is null or isnan(c) or abs(c) * {SCALE} >= 9e18)")
    x = F.expr(f"transform(e, c -> floor(c * {SCALE}) + {SHIFT}L)")
    return own.filter(~bad).select("vec_id", x.alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Centre:
    """Size and sums of the fit list: what centring a row takes."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact ``n x - S``, as long or, where that is too short, as Python's whole numbers."""
        if len(x) and self.n * int(max(x.max(), -x.min())) + max(map(abs, self.sums)) >= SAFE:
            return x.astype(object) * self.n - np.array(self.sums, dtype=object)
        return x * self.n - np.array(self.sums, dtype=np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


class Fit:
    """The fit list and products with its covariance."""

    def __init__(self, table: DataFrame, centre: Centre):
        self.table, self.centre = table, centre

    def summed(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over the fit list of a small array that ``of`` makes of some centred rows."""
        centre = self.centre

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in parts:
                for start in range(0, len(batch), 4096):
                    own = of(centre.rows(matrix(batch.column(0).slice(start, 4096)))).ravel()
                    total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

        sums = self.table.select("x").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
        return sums.toPandas().sort_values("place")["value"].to_numpy()

    def covariance_times(self, vectors: np.ndarray) -> np.ndarray:
        return self.summed(lambda rows: rows.T @ (rows @ vectors)).reshape(vectors.shape) / self.centre.n


def sums_of(table: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension of ``table(x)``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in parts:
            if len(batch):
                x = matrix(batch.column(0))
                big = len(x) * int(max(x.max(), -x.min())) >= SAFE
                total = total + (x.astype(object) if big else x).sum(axis=0).astype(object)
                n += len(x)
        if n:
            values = pa.array([str(v) for v in [n, *total]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), values], ["place", "value"])

    parts = table.select("x").mapInArrow(run, "place long, value string")
    found = parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("place").collect()
    values = [int(row["value"]) for row in found]
    return (values[0], values[1:]) if values else (0, [])


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to ``basis``; directions at the rounding level are left out."""
    out = basis
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            column = column - out @ (out.T @ column)
        left = np.linalg.norm(column)
        if size > 0 and left > 1e-10 * size:
            column = column / left
            column = column - out @ (out.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out[:, basis.shape[1] :]


def minres(apply: Product, right: np.ndarray, steps: int, reduction: float = 1e-4) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, by ``steps`` steps of MINRES side by side."""
    beta = np.linalg.norm(right, axis=0)
    beta[beta == 0] = 1.0
    start, v, v_old = beta, right / beta, np.zeros_like(right)
    x, w, w_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, c, c_old, s, s_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        rho = np.sqrt(delta**2 + beta_next**2)
        rho[rho == 0] = 1.0
        w, w_old = (v - (s * alpha + c_old * c * beta) * w - s_old * beta * w_old) / rho, w
        c_old, c, s_old, s = c, delta / rho, s, beta_next / rho
        x = x + c * eta * w
        eta = -s * eta
        v, v_old, beta = np.where(beta_next > 0, p / np.where(beta_next > 0, beta_next, 1.0), 0.0), v, beta_next
        if np.all(np.abs(eta) <= reduction * start):
            break
    return x


def leading_pairs(product: Product, d: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors, of a symmetric operator on d numbers."""
    longest = max(6 * wanted, wanted + 32)
    basis = orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, wanted + 4))), np.zeros((d, 0)))
    images = product(basis)
    for _ in range(OUTER_STEPS):
        small = basis.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        ritz, ritz_images = basis @ turns[:, :wanted], images @ turns[:, :wanted]
        residuals = ritz_images - ritz * values[:wanted]
        level = 8 * np.finfo(float).eps * np.sqrt(d) * max(abs(values[0]), abs(values[-1]))
        unlocked = np.linalg.norm(residuals, axis=0) > level
        if not unlocked.any() or basis.shape[1] == d:
            return values[:wanted], ritz / np.linalg.norm(ritz, axis=0)
        targets = values[:wanted][unlocked]
        project = lambda t: t - ritz @ (ritz.T @ t)
        correction = minres(lambda t: project(product(project(t)) - t * targets), project(-residuals[:, unlocked]), INNER_STEPS)
        if basis.shape[1] + correction.shape[1] > longest:
            keep = turns[:, : 2 * wanted]
            basis, images = basis @ keep, images @ keep
        more = orthonormal(project(correction), basis)
        if not more.shape[1]:  # the corrections are at the rounding level: look elsewhere
            more = orthonormal(np.random.default_rng(seed + basis.shape[1]).standard_normal((d, 1)), basis)
        basis, images = np.column_stack([basis, more]), np.column_stack([images, product(more)])
    raise RuntimeError(f"no convergence after {OUTER_STEPS} steps: residuals {np.linalg.norm(residuals, axis=0)}, wanted {level}")


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each usable row and component.

    Rows whose vector is null, empty, of another length than most, or holds an entry
    that is null, infinite, no number or beyond a long's range take no part. A null id stays
    null, repeated rows give repeated results. Components whose variance is at the
    rounding level are left out, so vectors that are all equal give no rows, like
    an empty table. A ``deviation`` beyond a long is null. Other columns are not
    read, so their names do not matter.
    """
    usable = stored(whole_vectors(vectors, vec_id, embedding), "whitening-rows")
    sizes = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    usable = usable.filter(F.size("x") == d)
    table = stored(usable.select("x").distinct(), "whitening-fit")
    n, sums = sums_of(table)
    centre = Centre(n, sums)
    fit = Fit(table, centre)
    schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = schema.format(usable.schema["vec_id"].dataType.simpleString())
    if n < 2:
        return usable.sparkSession.createDataFrame([], schema)

    trace = float(fit.summed(lambda rows: np.array([np.sum(rows * rows)]))[0]) / n
    wanted = min(components, d)
    values, directions = leading_pairs(fit.covariance_times, d, wanted)
    real = values > 4 * d * np.finfo(float).eps * trace
    values, directions = values[real], directions[:, real]
    k = len(values)
    if not k:
        return usable.sparkSession.createDataFrame([], schema)
    turn = directions / np.sqrt(values)

    def moments(rows: np.ndarray) -> np.ndarray:
        y = rows @ turn
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    found = fit.summed(moments) / n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    identity_error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for start in range(0, len(whole), 2048):
                yield rows_of(whole.slice(start, 2048))

    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(batch.column(1))
        z = centre.deviations(x)
        if z.dtype != object and int(np.abs(z).max()) ** 2 * d >= SAFE:
            z = z.astype(object)
        squares = [int(v) if v < 1 << 63 else None for v in (z * z).sum(axis=1)]
        rows = np.repeat(np.arange(len(x)), k)
        arrays = [
            batch.column(0).take(pa.array(rows)),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            pa.array(np.full(len(rows), n)),
            pa.array(squares, pa.int64()).take(pa.array(rows)),
            pa.array((centre.rows(x) @ turn).ravel()),
            pa.array(np.tile(explained, len(x))),
            pa.array(np.full(len(rows), identity_error)),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(run, schema)
