"""Similarity join of texts by the Jaccard similarity of their word shingles.

A text is the set of its distinct runs of ``shingle`` words (a shorter text is one
run). Two texts are linked when their sets' similarity is ``percent`` or more.
The search follows adaptive prefix filtering with several matches:

* A set of n shingles shares at least ``o = ceil(percent n / 100)`` of them with
  any partner. With shingles in one global order, rare ones first, two partners
  share at least ``l`` of their first ``n - o + l`` shingles, for every ``l``.
* Each text picks its own ``l``: a longer prefix meets more texts, but each
  meeting must then show more shared shingles before the whole sets are
  compared. The choice is the least estimated cost, from the counts of the
  prefix's shingles. Two texts have to share as many as the smaller ``l`` says.

Equal sets are one node throughout, so copies are never paired. Most texts need
no order at all: where a fixed slice of the hash space already holds
``n - o + 1`` shingles of a set that no other set has, these are its prefix, and
it has no partner. The next slices are counted for the other sets only, and each
slice leaves fewer. A shingle lies in one slice, so its count there is the same for
all sets that still matter and serves for the global order.

Prefix shingles with the same smallest member form one meeting place, so two
copies that share a hundred shingles meet once. Members of a place are compared
in blocks of bounded size, first by prefixes, then by whole sets; a block reports
links that connect what is linked in it, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from acervo.llm.common import runs, stored, texts, words
from acervo.llm.simhash import connect, digest
from acervo.session import is_small

SHINGLE = 3
PERCENT = 90
SLICE = 6  # the first slice is one in so many values of the hash; the others part the rest at the half
EDGE = (1 << 64) // SLICE  # hashes are stored as signed numbers, so those from the half on are negative
EXTRA = (1, 2, 3, 4, 6, 8, 12, 16)  # numbers of matches that a text may ask for
CHECK_COST = 1 / 8  # of a comparison of whole sets for each of their shingles, against one meeting
MOST_SENT = 1 << 22  # counts of shingles that are sent to every task: 64 MB
BLOCK_ROWS = 2048  # members that a task compares by prefixes at once
BLOCK_SHINGLES = 1 << 20  # shingles that a task compares at once


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted unsigned 64-bit hashes of the distinct shingles; none for a text without words."""
    tokens = words(text)
    if len(tokens) <= shingle:
        return np.array([digest(b" ".join(tokens))] if tokens else [], dtype=np.uint64)
    parts = zip(*(tokens[i:] for i in range(shingle)))
    return np.unique(np.fromiter(map(digest, map(b" ".join, parts)), np.uint64, len(tokens) - shingle + 1))


def least_overlap(n: Column, percent: int) -> Column:
    """The shingles that a set of n shares with any partner at least."""
    return F.ceil(n * percent / 100)


def sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs(doc_id, t1, t2, text)`` with its set's name, its size and the shingles of the first slice."""
    edge = np.uint64(EDGE)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            names, sizes, low = [], [], []
            for text in texts(batch.column(3)):
                own = shingles(text, shingle)
                names.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                low.append(own[: np.searchsorted(own, edge)].view(np.int64))
            more = [pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), pa.array(low, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *more], ["doc_id", "t1", "t2", "k", "n", "low"])

    schema = docs.select("doc_id", "t1", "t2", F.lit(b"").alias("k"), F.lit(0).cast("long").alias("n"), F.array(F.lit(0).cast("long")).alias("low"))
    return docs.mapInArrow(run, schema.schema)


def whole_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """``(node, n, own)`` of ``rows(node, text)``: the whole set of each node."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            sets = [shingles(text, shingle).view(np.int64) for text in texts(batch.column(1))]
            more = [pa.array(list(map(len, sets)), pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *more], ["node", "n", "own"])

    return rows.select("node", "text").mapInArrow(run, "node long, n long, own array<long>").dropDuplicates(["node"])


def shared_shingles(sets: DataFrame) -> DataFrame:
    """``(token, df)``, stored: the shingles of ``sets(node, n, own)`` that two sets or more hold."""
    tokens = sets.select(F.explode("own").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return stored(tokens.filter("df > 1"), "ngram-shared")


def with_counts(sets: DataFrame) -> DataFrame:
    """``(node, n, size, df, token)``: for each set of ``sets(node, n, own)`` its size and its shared shingles, rare ones first.

    The counts are looked up where they are few enough to be sent to every task, and joined otherwise.
    """
    counts = shared_shingles(sets)
    if counts.count() > MOST_SENT:
        tokens = sets.select("node", F.explode("own").alias("token")).join(counts, "token")
        seen = tokens.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("seen"))
        none = F.array().cast("array<bigint>")
        lists = (F.coalesce(F.col(f"seen.{name}"), none).alias(name) for name in ("df", "token"))
        return sets.join(seen, "node", "left").select("node", "n", F.size("own").cast("long").alias("size"), *lists)
    table = counts.toArrow()
    order = np.argsort(table["token"].to_numpy())
    known = sets.sparkSession.sparkContext.broadcast((table["token"].to_numpy()[order], table["df"].to_numpy()[order]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = known.value
        for batch in parts:
            lists = lists_of(batch.column(2))
            df, token = [], []
            for own in lists:
                at = np.searchsorted(tokens, own)
                at[at == len(tokens)] = 0
                at, own = (at[found], own[found]) if len(tokens) and (found := tokens[at] == own).any() else (at[:0], own[:0])
                order = np.lexsort((own, counts[at]))
                df.append(counts[at][order])
                token.append(own[order])
            arrays = [pa.array(list(map(len, lists)), pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (df, token))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], ["node", "n", "size", "df", "token"])

    return sets.select("node", "n", "own").mapInArrow(run, "node long, n long, size long, df array<long>, token array<long>")


def with_chance(counted: DataFrame, percent: int) -> DataFrame:
    """Rows of ``counted(node, n, size, df, token)`` whose counted shingles do not show a prefix free of shared ones."""
    alone = F.col("size") - F.size("df")
    return counted.filter(alone < F.col("n") - least_overlap(F.col("n"), percent) + 1)


def counted_further(before: DataFrame, sets: DataFrame, part: str, percent: int) -> DataFrame:
    """``before`` with the counts of the shingles of ``sets`` that are in one more slice; only nodes with a chance stay."""
    left = sets.join(before.select("node"), "node", "left_semi")
    more = with_counts(left.select("node", "n", F.expr(f"filter(own, t -> {part})").alias("own"))).drop("n")
    more = more.toDF("node", "more", "more_df", "more_token")
    both = before.join(more, "node").select(
        "node", "n", (F.col("size") + F.col("more")).alias("size"), F.concat("df", "more_df").alias("df"), F.concat("token", "more_token").alias("token")
    )
    return stored(with_chance(both, percent), "ngram-counted")


def prefixes(first: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(node, n, matches, prefix)``: the shared shingles of each adaptive prefix.

    ``first`` has the counts of the first slice; nodes that turn out to have no partner are left out.
    """
    counted = counted_further(first, sets, f"t >= {EDGE}L", percent)
    counted = counted_further(counted, sets, "t < 0", percent)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out: list[tuple] = []
            ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for node, n, df, token in zip(ids, sizes, lists_of(batch.column(2)), lists_of(batch.column(3))):
                order = np.lexsort((token, df))
                df, token = df[order], token[order]
                length = n + (-percent * n // 100) + 1  # for one match; shingles of one set alone come first
                alone = n - len(df)
                matches = adaptive_matches(df, alone, length, n)
                out.append((node, n, matches, token[: length + matches - 1 - alone]))
            if out:
                node, n, matches, prefix = zip(*out)
                more = [pa.array(x, pa.int64()) for x in (node, n, matches)]
                yield pa.RecordBatch.from_arrays([*more, pa.array(prefix, pa.list_(pa.int64()))], ["node", "n", "matches", "prefix"])

    return counted.select("node", "n", "df", "token").mapInArrow(run, "node long, n long, matches long, prefix array<long>")


def adaptive_matches(df: np.ndarray, alone: int, length: int, n: int) -> int:
    """The number of matches with the least estimated cost.

    A prefix meets ``sum(df - 1)`` members; as each candidate takes up ``l`` of
    those meetings, at most an ``l``-th of them are compared in full.
    """
    met = np.cumsum(df - 1)
    options = [m for m in EXTRA if length + m - 1 <= n]
    cost = [met[length + m - 2 - alone] * (1 + CHECK_COST * n / m) for m in options]
    return options[int(np.argmin(cost))]


def hits(flat: np.ndarray, starts: np.ndarray, i: int, stop: int, size: int) -> np.ndarray:
    """How many values of list ``i`` each list holds; the lists' values are ids below ``size``."""
    mark = np.zeros(size, dtype=np.int64)
    mark[flat[starts[i] : stop]] = 1
    return np.add.reduceat(mark[flat], starts)


def numbered(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Lists of values as one flat list of ids, with each list's start and end."""
    values, flat = np.unique(np.concatenate(lists), return_inverse=True)
    ends = np.cumsum(list(map(len, lists)))
    return flat, ends - list(map(len, lists)), ends, len(values)


def lists_of(column: pa.ListArray) -> list[np.ndarray]:
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(at, at[1:])]


def candidates(n: np.ndarray, matches: np.ndarray, prefix: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each member has a candidate: a member of fitting size that shares enough of its prefix."""
    flat, starts, ends, size = numbered(prefix)
    out = np.zeros(len(n), dtype=bool)
    for i in range(len(n)):
        fits = hits(flat, starts, i, ends[i], size) >= np.minimum(matches[i], matches)
        fits &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
        fits[i] = False
        out[i] = fits.any()
    return out


def spanning_links(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what the similar pairs of members connect."""
    flat, starts, ends, size = numbered(sets)
    n = ends - starts
    unseen, out = np.ones(len(nodes), dtype=bool), []
    for root in range(len(nodes)):
        if not unseen[root]:
            continue
        unseen[root] = False
        stack = [root]
        while stack and unseen.any():
            i = stack.pop()
            common = hits(flat, starts, i, ends[i], size)
            near = np.flatnonzero(unseen & (100 * common >= percent * (n + n[i] - common)))
            unseen[near] = False
            out += [(int(nodes[i]), int(nodes[j])) for j in near]
            stack.extend(near.tolist())
    return out


def in_blocks(members: DataFrame, blocks: Column) -> DataFrame:
    """``members(place, node, ...)`` once for every pair of blocks ``(i, j)`` that holds its own block."""
    own = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")
    placed = members.withColumn("_blocks", blocks).withColumn("_own", own).select("*", other)
    return placed.withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")).drop("_blocks", "_own", "_other")


def similar_links(first: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect the similar nodes of ``sets(node, n, own)``."""
    chosen = stored(prefixes(first, sets, percent), "ngram-prefixes")
    tokens = chosen.select("node", F.explode("prefix").alias("token"))
    places = tokens.groupBy("token").agg(F.min("node").alias("place"), F.count(F.lit(1)).alias("df")).filter("df > 1")
    members = stored(tokens.join(places.select("token", "place"), "token").select("place", "node").distinct(), "ngram-members")

    keys = ["place", "i", "j"]
    sizes = members.groupBy("place").agg(F.count(F.lit(1)).alias("size"))
    rows = members.join(sizes, "place").join(chosen, "node")
    rows = in_blocks(rows, F.ceil(F.col("size") / BLOCK_ROWS).cast("long")).select(*keys, "node", "n", "matches", "prefix")

    def by_prefix(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(parts, 3):
            if len(group) > 1:
                has = candidates(group.column(4).to_numpy(), group.column(5).to_numpy(), lists_of(group.column(6)), percent)
                if has.any():
                    kept = group.filter(pa.array(has))
                    yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(3)], ["place", "node"])

    met = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_prefix, "place long, node long").distinct()
    met = stored(met, "ngram-met")
    whole = met.join(sets, "node")
    weights = met.join(sets.select("node", "n"), "node").groupBy("place").agg(F.sum("n").alias("weight"))
    rows = whole.join(weights, "place")
    rows = in_blocks(rows, F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("long")).select(*keys, "node", "own")

    def by_set(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(parts, 3):
            links = spanning_links(group.column(3).to_numpy(), lists_of(group.column(4)), percent) if len(group) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])

    links = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_set, "a long, b long")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id that links reach, the own one included. A
    null, empty or blank text has no shingles and is linked with nothing. A row
    with a null id gets the smallest id of its component (null if there is none).
    Repeated rows give repeated results; other columns are not read, so their names
    do not matter. An empty table gives an empty result.
    """
    content = F.col(f"`{text}`")
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(content).alias("t1"), F.xxhash64(F.lit(1), content).alias("t2"), content.alias("text"))
    rows = stored(sketched(narrow, shingle), "ngram-rows")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t1", "t2")
    nodes = rows.filter("n > 0").groupBy("k").agg(F.min(own).alias("best"), F.first("n").alias("n"), F.first("low").alias("low"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")

    first = with_chance(with_counts(nodes.select("node", "n", F.col("low").alias("own"))), percent)
    first = stored(first, "ngram-counted")
    needed = nodes.join(first.select("node"), "node").select("node", "best.doc_id", "best.t1", "best.t2").toDF("node", "_d", "_t1", "_t2")
    needed = stored(needed, "ngram-needed")
    if is_small(needed):
        needed = F.broadcast(needed)
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    sets = stored(whole_sets(narrow.join(needed, same), shingle), "ngram-sets")
    roots = connect(similar_links(first, sets, percent)).toDF("node", "root")

    named = nodes.select("k", "node", F.col("best.doc_id").alias("first")).join(roots, "node", "left")
    named = stored(named.select("k", "first", F.coalesce("root", "node").alias("root")), "ngram-named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    component = named.join(smallest, "root").select("k", "component_id")
    return (
        rows.select("doc_id", "k", "n")
        .join(component, "k", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )
