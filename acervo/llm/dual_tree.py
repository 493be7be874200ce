"""Exact top-k inner products by dual-tree search over cover trees.

Queries and candidates are laid out by the nearest of a few pivots and numbered
in that order; a block of queries and a run of candidates are bounded stretches of
numbers, so that their rows lie near each other. Each gets a cover tree, built and
stored once. Blocks meet runs by keys of a few blocks and a few runs, and each
meeting is a dual-tree search. A pair of a query node and a candidate
node is pruned when the largest product that their centres and covering radii
allow is below the kth score of every query in the node. Near leaves are
visited first, and the scores against a bounded sample of candidates give the
first bounds, so that bounds are tight early. Tasks send at most k rows per
query and key, which are ranked by query. Neither queries nor candidates pass
through the driver, but for the sample.

In a cover tree a node's children cover its points within a fixed share of its
radius and their centres lie further apart than that. Children of few points
are put together in leaves.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from acervo.llm.common import stored
from acervo.operators.index import with_dense_ids

SCALE = 64
K = 20
QUERY_BLOCK = 4096
TREE_ROWS = 8192
SIDE = 8  # blocks and runs that meet under one key
MEETINGS = 64  # a key has fewer while there are not this many meetings
LEAF = 64
SHRINK = 0.7  # a child's radius is at most this share of its parent's
SAMPLE, PIVOTS = 4096, 64
EXACT = 1 << 52  # sums below this are exact in double precision


class Tree:
    """A cover tree; ``order`` lists the points so that every node is a slice of it."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.empty(len(points), dtype=np.int64)
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.centers: list[np.ndarray] = []
        self.radii: list[float] = []
        self.filled = 0
        everything = np.arange(len(points))
        center = points[0]
        self.grow(everything, center, np.sqrt(((points - center) ** 2).sum(axis=1)))
        self.center_rows = np.stack(self.centers)
        self.radius = np.array(self.radii)
        self.norm = np.sqrt((self.center_rows**2).sum(axis=1))
        del self.points, self.centers, self.radii

    def add(self, center: np.ndarray, radius: float) -> int:
        self.centers.append(center)
        self.radii.append(radius)
        self.children.append([])
        self.spans.append((self.filled, self.filled))
        return len(self.radii) - 1

    def leaf(self, members: np.ndarray, center: np.ndarray, radius: float) -> int:
        node = self.add(center, radius)
        end = self.filled + len(members)
        self.order[self.filled : end] = members
        self.spans[node] = (self.filled, end)
        self.filled = end
        return node

    def grow(self, members: np.ndarray, center: np.ndarray, distance: np.ndarray) -> int:
        radius = float(distance.max())
        if len(members) <= LEAF or radius == 0.0:
            return self.leaf(members, center, radius)
        node = self.add(center, radius)
        low = self.filled
        rest, small = members, []
        own = distance  # the first child keeps the node's centre
        middle = center
        while len(rest):
            inside = own <= radius * SHRINK
            group = rest[inside]
            if len(group) > LEAF // 2:
                self.children[node].append(self.grow(group, middle, own[inside]))
            else:
                small.append(group)
            rest = rest[~inside]
            if len(rest):
                middle = self.points[rest[0]]
                own = np.sqrt(((self.points[rest] - middle) ** 2).sum(axis=1))
        if small:
            others = np.concatenate(small)
            for start in range(0, len(others), LEAF):
                part = others[start : start + LEAF]
                mean = self.points[part].mean(axis=0)
                reach = float(np.sqrt(((self.points[part] - mean) ** 2).sum(axis=1)).max())
                self.children[node].append(self.leaf(part, mean, reach))
        self.spans[node] = (low, self.filled)
        return node


class Best:
    """The k best scores of each query so far; ties go to the smaller id."""

    def __init__(self, bounds: np.ndarray, k: int):
        self.k = k
        self.bounds = bounds.astype(np.float64).copy()  # no score below this can be among the k best
        self.scores: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(bounds)
        self.ids: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(bounds)

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], ids])
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[top], ids[top]
        if len(top) == self.k:
            self.bounds[query] = max(self.bounds[query], float(scores[top[-1]]))


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; doubles hold them exactly where sums stay small."""
    if exact:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Queries:
    """A block of queries, ordered by their tree, with first bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bounds: np.ndarray):
        self.tree = Tree(vectors.astype(np.float64))
        order = self.tree.order
        self.ids, self.vectors, self.bounds = ids[order], vectors[order], bounds[order]
        self.rows = order  # numbers that tell queries of one id apart


class Candidates:
    """A run of candidates, ordered by their tree, without copies that cannot be among the ``k`` best."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        keep = first_of_equal(ids, vectors, k + 1)
        ids, vectors = ids[keep], vectors[keep]
        self.tree = Tree(vectors.astype(np.float64))
        self.ids, self.vectors = ids[self.tree.order], vectors[self.tree.order]


def visit(queries: Queries, best: Best, run: Candidates) -> None:
    """Offers every candidate that can be among a query's best."""
    ids, vectors, tree, own = run.ids, run.vectors, run.tree, queries.tree
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries.vectors).max(initial=0)) * vectors.shape[1]
    exact = largest < EXACT
    reach = own.center_rows @ tree.center_rows.T
    reach += own.radius[:, None] * tree.norm[None, :] + own.norm[:, None] * tree.radius[None, :]
    reach += own.radius[:, None] * tree.radius[None, :]
    reach += 1e-9 * np.abs(reach) + 1e-6
    stack = [(0, 0)]
    while stack:
        q, c = stack.pop()
        a, b = own.spans[q]
        if reach[q, c] < best.bounds[a:b].min():
            continue
        mine, theirs = own.children[q], tree.children[c]
        if not mine and not theirs:
            low, high = tree.spans[c]
            scores = products(queries.vectors[a:b], vectors[low:high], exact)
            hit = (scores >= best.bounds[a:b, None]) & (queries.ids[a:b, None] != ids[None, low:high])
            for row in np.flatnonzero(hit.any(axis=1)).tolist():
                best.offer(a + row, scores[row][hit[row]], ids[low:high][hit[row]])
            continue
        if mine and (not theirs or own.radius[q] >= tree.radius[c]):
            pairs = [(x, c) for x in mine]
        else:
            pairs = [(q, x) for x in theirs]
        # The most promising pair comes off the stack first.
        stack += sorted(pairs, key=lambda pair: reach[pair])


def first_of_equal(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` smallest ids of each vector: no other copy can rank."""
    raw = np.ascontiguousarray(vectors.astype(np.int64)).view(np.dtype((np.void, 8 * vectors.shape[1]))).ravel() if vectors.shape[1] else np.zeros(len(ids))
    _, group = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, group))
    sorted_group = group[order]
    first = np.concatenate([[0], np.flatnonzero(sorted_group[1:] != sorted_group[:-1]) + 1])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return np.sort(order[rank < most])


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    wrong = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, wrong)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def sample_of(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of ``SAMPLE`` rows at most, by a hash of the id; they only set pivots and first bounds."""
    total = rows.count()
    share = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < int(1_000_003 * min(1.0, SAMPLE / max(total, 1)))
    table = rows.filter(share).limit(2 * SAMPLE).toArrow()
    ids = table.column("vec_id").to_numpy().astype(np.int64)
    vectors = matrix(table.column("vector").combine_chunks(), size) if len(ids) else np.zeros((0, size), dtype=np.int64)
    return ids, vectors


def laid_out(rows: DataFrame, sample: np.ndarray, size: int) -> DataFrame:
    """``(place, vec_id, vector)``: numbered by nearest pivot and id, stored."""
    pivots = np.unique(sample, axis=0).astype(np.float64)
    pivots = pivots[np.linspace(0, len(pivots) - 1, min(PIVOTS, len(pivots))).astype(int)] if len(pivots) else np.zeros((1, size))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (pivots**2).sum(axis=1) / 2
        for batch in parts:
            own = matrix(batch.column(1), size).astype(np.float64)
            nearest = (own @ pivots.T - half).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(nearest, pa.int64()), *batch.columns], ["pivot", "vec_id", "vector"])

    placed = rows.mapInArrow(run, "pivot long, vec_id long, vector array<bigint>")
    return stored(with_dense_ids(placed, "pivot", "vec_id", name="place").drop("pivot"), "vectors")


def packed(rows: DataFrame, width: int, size: int, build: Callable, name: str) -> DataFrame:
    """``(number, held)``: one row per ``width`` rows by ``place``, with what ``build(ids, vectors)`` makes of them; stored."""

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy().astype(np.int64)
        order = np.argsort(group.column("place").to_numpy())
        vectors = matrix(group.column("vector").combine_chunks(), size)
        held = pickle.dumps(build(ids[order], vectors[order]), protocol=5)
        return pa.table({"number": group.column("number").slice(0, 1), "held": pa.array([held], pa.binary())})

    numbered = rows.withColumn("number", F.call_function("div", F.col("place"), F.lit(width).cast("long")))
    return stored(numbered.groupBy("number").applyInArrow(run, "number long, held binary"), name)


def first_bounds(ids: np.ndarray, vectors: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """The kth score of each query against the sample."""
    out = np.full(len(ids), -np.inf)
    for a in range(0, len(ids), 256) if len(sample_ids) > k else ():
        scores = vectors[a : a + 256].astype(np.float64) @ sample.astype(np.float64).T
        scores[ids[a : a + 256, None] == sample_ids[None, :]] = -np.inf
        out[a : a + 256] = np.partition(scores, -k, axis=1)[:, -k]
    return out - 1e-6 * np.abs(out)


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best candidates of each query, by score and then smaller id.

    Vectors that are null or hold null or non-finite components take no part, nor
    do rows with a null id. Rows that repeat id and vector count once; a query
    never meets rows of its own id. Only vectors of one length meet. Fewer than k
    candidates give fewer rows; other columns are not read.
    """
    source = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("raw"), is_query.alias("is_query"))
    source = source.filter(F.col("vec_id").isNotNull() & usable(F.col("raw")))
    rows = source.select("vec_id", integers(F.col("raw")).alias("vector"), "is_query").distinct()
    rows = stored(rows, "vector-rows")
    out = None
    # One round per length that queries have.
    for found in rows.filter("is_query").select(F.size("vector").alias("size")).distinct().orderBy("size").collect():
        size = found["size"]
        same = rows.filter(F.size("vector") == size)
        part = met(same.filter("is_query").select("vec_id", "vector"), same.select("vec_id", "vector"), size, k)
        part = part.withColumn("size", F.lit(size))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Rows that share an id but not a vector are queries of their own.
    best = Window.partitionBy("query_id", "size", "block", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def met(queries: DataFrame, candidates: DataFrame, size: int, k: int) -> DataFrame:
    """``(block, query_id, query_row, vec_id, score)``: what blocks of queries find in runs of candidates."""
    sample_ids, sample = sample_of(candidates, size)
    shared = candidates.sparkSession.sparkContext.broadcast((sample_ids, sample))
    with_bounds = lambda ids, rows: Queries(ids, rows, first_bounds(ids, rows, *shared.value, k))
    blocks = packed(laid_out(queries, sample, size), QUERY_BLOCK, size, with_bounds, "query-blocks")
    runs = packed(laid_out(candidates, sample, size), TREE_ROWS, size, lambda ids, rows: Candidates(ids, rows, k), "runs")

    n_blocks, n_runs = blocks.count(), runs.count()
    side = max(1, min(SIDE, n_blocks * n_runs // MEETINGS))
    several = lambda column: F.call_function("div", F.col(column), F.lit(side).cast("long"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // side).cast("long")))
    # Every few blocks go to every few runs, so what moves is a share of the meetings.
    left = blocks.select(F.col("number").alias("block"), F.col("held").alias("queries"), several("number").alias("blocks"), each(n_runs).alias("runs"))
    right = runs.select(F.col("held").alias("run"), several("number").alias("runs"), each(n_blocks).alias("blocks"))
    meetings = left.hint("merge").join(right, ["blocks", "runs"]).select("block", "queries", "run")

    def search_each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, best = None, None, None
        for batch in parts:
            for number, blob, run in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if number != block:
                    if held is not None:
                        yield told(block, held, best)
                    block, held = number, pickle.loads(blob.as_buffer())
                    best = Best(held.bounds, k)
                visit(held, best, pickle.loads(run.as_buffer()))
        if held is not None:
            yield told(block, held, best)

    return meetings.mapInArrow(search_each, "block long, query_id long, query_row long, vec_id long, score long")


def told(block: int, queries: Queries, best: Best) -> pa.RecordBatch:
    counts = [len(x) for x in best.ids]
    columns = {
        "block": np.full(sum(counts), block, dtype=np.int64),
        "query_id": np.repeat(queries.ids, counts),
        "query_row": np.repeat(queries.rows, counts),
        "vec_id": np.concatenate(best.ids),
        "score": np.concatenate(best.scores),
    }
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns))
