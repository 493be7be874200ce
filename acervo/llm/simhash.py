"""SimHash near-duplicates with the generalised pigeonhole principle.

A document's fingerprint has a bit set where over half of its word shingles'
hashes have it set. Two fingerprints are linked when they differ in at most
``distance`` bits, and linked documents form components.

The search for links follows the generalised pigeonhole principle. The 64 bits
are grouped so that correlated bits share a part. Counts of the parts' values
over all fingerprints estimate how many candidates a fingerprint meets in a
part at each radius; for each fingerprint a dynamic program then splits
``distance + 1`` units over the parts (a part with t units is probed at radius
t - 1, one with none is not probed at all) so that the estimated work is least.
Whatever the split, two fingerprints within ``distance`` agree in some part to
the radius given there, so no link is lost. Probes meet the fingerprints that
hold the probed value, and each meeting is verified on all 64 bits.

Equal fingerprints are one node throughout, so copies are never paired.
A meeting point reports links that connect its members, not all pairs. Values
with more than ``BLOCK`` members are verified in blocks, each in its own task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from acervo.llm.common import free_name, row_key, stored, texts, words

SHINGLE = 3
DISTANCE = 3
BITS = 64
SUB_BITS = 16  # count tables cover at most so many bits: 65,536 entries
BLOCK = 4096  # members of a value that one task compares
TARGET = 64  # aimed at: members of an average value
PROBE_COST = 2.0  # a probe row against a comparison

digest = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint; zero for a text without words."""
    tokens = words(text)
    if not tokens:
        return 0
    if len(tokens) <= shingle:
        hashes = np.array([digest(b" ".join(tokens))], dtype=np.uint64)
    else:
        runs = zip(*(tokens[i:] for i in range(shingle)))
        hashes = np.fromiter(map(digest, map(b" ".join, runs)), np.uint64, len(tokens) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all but the text) and ``fp``, one row per row.

    A null text counts as empty and has fingerprint zero.
    """
    kept = [name for name in docs.columns if name != text] if keep is None else keep
    source = docs.select(*(F.col(f"`{name}`") for name in kept), F.col(f"`{text}`").alias("_text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            fps = pa.array([fingerprint(t, shingle) for t in texts(batch.column(len(kept)))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], fps], [*kept, "fp"])

    schema = source.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema
    return source.mapInArrow(run, schema)


def bit_matrix(fps: np.ndarray) -> np.ndarray:
    """One row of 64 bits per fingerprint; column j is the bit of weight 2**j."""
    raw = fps.astype("<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have bits i and j set; 4,096 counts, whatever the input."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((BITS, BITS)), 0
        for batch in parts:
            bits = bit_matrix(batch.column(0).to_numpy()).astype(np.float32)
            total += bits.T @ bits
            seen += len(bits)
        if seen:
            pairs = np.arange(BITS * BITS + 1)
            counts = np.append(total.ravel(), seen).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    rows = distinct.select("fp").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BITS * BITS + 1)
    for row in rows:
        counts[row["pair"]] = row["n"]
    return int(counts[-1]), counts[:-1].reshape(BITS, BITS)


def part_count(n: int, distance: int) -> int:
    """Fewer and wider parts for more fingerprints, so that an average value keeps few members."""
    for parts in range(distance + 1, 2, -1):
        if n <= TARGET << (BITS // parts):
            return parts
    return max(1, min(2, distance + 1))


def group_bits(n: int, together: np.ndarray, distance: int) -> list[list[list[int]]]:
    """Parts of bits, each a list of sub-blocks of at most ``SUB_BITS``; correlated bits share a sub-block."""
    parts = part_count(n, distance)
    widths = [len(x) for x in np.array_split(np.arange(BITS), parts)]
    blocks = [[len(x) for x in np.array_split(np.arange(w), -(-w // SUB_BITS))] for w in widths]
    mean = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    related = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, out = set(range(BITS)), []
    for part in blocks:
        taken: list[int] = []
        for _ in range(sum(part)):
            rest = sorted(free)
            weight = related[np.ix_(rest, taken if taken else rest)].mean(axis=1)
            best = rest[int(np.argmax(weight))]
            taken.append(best)
            free.remove(best)
        edges = np.cumsum([0, *part])
        out.append([taken[a:b] for a, b in zip(edges, edges[1:])])
    return out


def value_of(bits: np.ndarray, chosen: list[int]) -> np.ndarray:
    return bits[:, chosen].astype(np.int64) @ (np.int64(1) << np.arange(len(chosen), dtype=np.int64))


def sub_block_counts(distinct: DataFrame, parts: list[list[list[int]]]) -> list[np.ndarray]:
    """Exact counts of every sub-block's values over all fingerprints.

    At most 65,536 counts for each of the few sub-blocks reach the driver.
    """
    blocks = [block for part in parts for block in part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(block), dtype=np.int64) for block in blocks]
        for batch in batches:
            bits = bit_matrix(batch.column(0).to_numpy())
            for count, block in zip(counts, blocks):
                count += np.bincount(value_of(bits, block), minlength=len(count))
        for k, count in enumerate(counts):
            at = np.flatnonzero(count)
            if len(at):
                arrays = [np.full(len(at), k), at, count[at]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["block", "value", "n"])

    table = distinct.select("fp").mapInArrow(run, "block long, value long, n long")
    table = table.groupBy("block", "value").agg(F.sum("n").alias("n")).toArrow()
    block, value, n = (table.column(i).to_numpy() for i in range(3))
    out = []
    for k, chosen in enumerate(blocks):
        count = np.zeros(1 << len(chosen))
        count[value[block == k]] = n[block == k]
        out.append(count)
    return out


def shells(count: np.ndarray, radius: int) -> np.ndarray:
    """Row e: for each value, how many members lie at distance e exactly."""
    out = np.zeros((radius + 1, len(count)))
    out[0] = count
    at = np.arange(len(count))
    for bit in range(len(count).bit_length() - 1):
        out[1:] += out[:-1][:, at ^ (1 << bit)]
    return out.astype(np.float32)


def estimates(bits: np.ndarray, part: list[list[int]], tables: list[np.ndarray], n: int) -> np.ndarray:
    """Column e: estimated members within distance e of each row's value of the part.

    Exact for a part of one sub-block; sub-blocks of one part count as independent.
    """
    total = None
    for block, table in zip(part, tables):
        own = table[:, value_of(bits, block)].T
        if total is None:
            total = own
        else:
            mixed = np.zeros_like(total)
            for e in range(total.shape[1]):
                for f in range(e + 1):
                    mixed[:, e] += total[:, f] * own[:, e - f] / max(n, 1)
            total = mixed
    return np.cumsum(total, axis=1)


@lru_cache(maxsize=64)
def masks(width: int, radius: int) -> np.ndarray:
    """All changes of at most ``radius`` of ``width`` bits."""
    return np.array(
        [sum(1 << b for b in chosen) for e in range(radius + 1) for chosen in combinations(range(width), e)], dtype=np.int64
    )


def allocate(costs: list[np.ndarray]) -> np.ndarray:
    """Units per row and part with sum ``distance + 1`` at the least cost; costs[i][:, t] is part i's cost of t units."""
    rows, width = costs[0].shape
    best, choice = costs[0].copy(), []
    for cost in costs[1:]:
        after = np.full((rows, width), np.inf)
        pick = np.zeros((rows, width), dtype=np.int8)
        for units in range(width):
            for own in range(units + 1):
                value = best[:, units - own] + cost[:, own]
                better = value < after[:, units]
                after[better, units] = value[better]
                pick[better, units] = own
        best = after
        choice.append(pick)
    left = np.full(rows, width - 1)
    out = np.zeros((rows, len(costs)), dtype=np.int64)
    at = np.arange(rows)
    for i in range(len(costs) - 1, 0, -1):
        out[:, i] = choice[i - 1][at, left]
        left = left - out[:, i]
    out[:, 0] = left
    return out


def probe_rows(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(part, value, query, fp)``: every fingerprint under its own values and under those that it probes."""
    spark = distinct.sparkSession
    n, together = bit_statistics(distinct)
    parts = group_bits(n, together, distance)
    flat = iter(sub_block_counts(distinct, parts))
    tables = [[shells(next(flat), distance) for _ in part] for part in parts]
    shared = spark.sparkContext.broadcast(tables)  # 4 x 65,536 counts for each radius at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy()
            for start in range(0, len(whole), 4096):
                yield from rows_of(whole[start : start + 4096])

    def rows_of(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits, costs, values = bit_matrix(fps), [], []
        for part, table in zip(parts, shared.value):
            chosen = [bit for block in part for bit in block]
            values.append(value_of(bits, chosen))
            near = estimates(bits, part, table, n)
            probes = np.array([PROBE_COST * len(masks(len(chosen), e)) for e in range(distance + 1)])
            costs.append(np.concatenate([np.zeros((len(fps), 1)), near + probes], axis=1))
        units = allocate(costs)
        for i, part in enumerate(parts):
            yield emit(i, values[i], 0, fps)
            width = sum(map(len, part))
            for own in range(1, distance + 2):
                rows = np.flatnonzero(units[:, i] == own)
                if len(rows):
                    change = masks(width, own - 1)
                    step = max(1, 200_000 // len(change))
                    for a in range(0, len(rows), step):
                        some = rows[a : a + step]
                        probed = (values[i][some][:, None] ^ change[None, :]).ravel()
                        yield emit(i, probed, 1, np.repeat(fps[some], len(change)))

    def emit(part: int, value: np.ndarray, query: int, fps: np.ndarray) -> pa.RecordBatch:
        arrays = [np.full(len(fps), part), value, np.full(len(fps), query), fps]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["part", "value", "query", "fp"])

    return distinct.select("fp").mapInArrow(run, "part long, value long, query long, fp long")


def spanning_links(fps: np.ndarray, query: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what verified comparisons of queries with all members connect."""
    queries = np.unique(fps[query == 1])
    others = np.setdiff1d(fps[query == 0], queries, assume_unique=False)
    if not len(queries) or len(queries) + len(others) < 2:
        return []
    nodes = np.concatenate([queries, others])
    raw = nodes.view(np.uint64)  # bits of a negative number are counted as they are
    unseen = np.ones(len(nodes), dtype=bool)
    out = []
    for root in range(len(queries)):
        if not unseen[root]:
            continue
        unseen[root] = False
        stack, members = [root], []
        while stack:
            node = stack.pop()
            reach = len(nodes) if node < len(queries) else len(queries)
            near = np.bitwise_count(raw[:reach] ^ raw[node]) <= distance
            near &= unseen[:reach]
            found = np.flatnonzero(near)
            if len(found):
                unseen[found] = False
                members.append(found)
                stack.extend(found.tolist())
        if members:
            group = nodes[np.concatenate([[root], *members])]
            low = group.min()
            rest = group[group != low]
            out.append((np.full(len(rest), low), rest))
    return out


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` of distinct fingerprints that connect all within ``distance``."""
    rows = stored(probe_rows(distinct, distance), "simhash-probes")
    sizes = rows.groupBy("part", "value").agg(F.sum(1 - F.col("query")).alias("members"), F.sum("query").alias("queries"))
    crowded = sizes.filter((F.col("members") > block) | (F.col("queries") > block)).select(
        "part",
        "value",
        F.ceil(F.col("members") / block).cast("long").alias("member_blocks"),
        F.ceil(F.col("queries") / block).cast("long").alias("query_blocks"),
    )
    one = F.lit(1).cast("long")
    placed = rows.join(crowded, ["part", "value"], "left").select(
        "part",
        "value",
        "query",
        "fp",
        F.coalesce("member_blocks", one).alias("_m"),
        F.coalesce("query_blocks", one).alias("_q"),
    )
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("query") == 1, F.greatest("_q", one)).otherwise(F.greatest("_m", one)))
    other = F.when(F.col("query") == 1, F.greatest("_m", one)).otherwise(F.greatest("_q", one))
    placed = placed.select("part", "value", "query", "fp", own.alias("_own"), F.explode(F.sequence(F.lit(0).cast("long"), other - 1)).alias("_other"))
    is_query = F.col("query") == 1
    placed = placed.select(
        "part",
        "value",
        F.when(is_query, F.col("_own")).otherwise(F.col("_other")).alias("qb"),
        F.when(is_query, F.col("_other")).otherwise(F.col("_own")).alias("mb"),
        "query",
        "fp",
    )
    keys = ["part", "value", "qb", "mb"]
    sorted_rows = placed.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            own = [batch.column(i).to_numpy() for i in range(6)]
            held = own if held is None else [np.concatenate(pair) for pair in zip(held, own)]
            changes = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in held[:4]])) + 1
            if len(changes):
                yield from verify(held, np.concatenate([[0], changes]))
                held = [x[changes[-1] :] for x in held]
        if held is not None and len(held[0]):
            yield from verify(held, np.array([0, len(held[0])]))

    def verify(rows: list[np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        query, fps = rows[4], rows[5]
        starts, end = edges[:-1], edges[-1]
        several = np.minimum.reduceat(fps[:end], starts) != np.maximum.reduceat(fps[:end], starts)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k in np.flatnonzero(several):
            a, b = edges[k], edges[k + 1]
            found += spanning_links(fps[a:b], query[a:b], distance)
        if found:
            pair = [pa.array(np.concatenate(side), pa.int64()) for side in zip(*found)]
            yield pa.RecordBatch.from_arrays(pair, ["a", "b"])

    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def connect(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the component's smallest node.

    Each round points every node to its smallest neighbour if that is smaller. The
    pointers are doubled until each shows the end of its chain, and the links are
    contracted to those ends, so rounds and doublings stay logarithmic even for a
    chain in rising order. All is grouped and joined by key.
    """
    edges, labels = stored(links, "links"), None
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("p")), "parents")
        while True:
            above = parent.toDF("p", "g")
            if not parent.join(above, "p").filter("g <> p").take(1):
                break
            parent = stored(parent.join(above, "p").select("a", F.col("g").alias("p")), "parents")
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            moved = labels.join(parent, F.col("root") == F.col("a"), "left")
            labels = stored(moved.select("node", F.coalesce("p", "root").alias("root")), "labels")
        left, right = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        moved = edges.join(left, "a").join(right, "b").filter("pa <> pb")
        edges = stored(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    return edges.toDF("node", "root") if labels is None else labels


def fingerprint_roots(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(fp, root)`` for the distinct fingerprints of ``fps`` that have a link."""
    distinct = stored(fps.select("fp").distinct(), "simhash-distinct")
    return connect(fingerprint_links(distinct, distance)).toDF("fp", "root")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id that links reach, the own one included.
    A null or empty text has fingerprint zero and is linked like any other. A
    row with a null id gets the smallest id of its component (null if there is
    none). Repeated rows give repeated results; other columns are not read, so
    their names do not matter. An empty table gives an empty result.
    """
    fps = stored(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle=shingle), "simhash")
    roots = fingerprint_roots(fps, distance)
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "simhash-named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    component = named.join(smallest, "root").select("fp", "component_id")
    return fps.join(component, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` but for near copies: of each component the row with the smallest id stays.

    A null id counts as larger than any other; among rows of one id the one with
    the smallest content hash stays, and exact repeats leave one row. A null or empty
    text has fingerprint zero and is linked like any other. All columns are kept,
    whatever their names; an empty table stays empty.
    """
    columns = docs.columns
    k1, k2 = free_name(columns, "_k1"), free_name(columns, "_k2")
    first, second = row_key(docs.schema)
    keyed = docs.select("*", first.alias(k1), second.alias(k2))
    narrow = keyed.select(F.col(f"`{doc_id}`").alias("id"), F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(f"`{text}`").alias("text"))
    fps = stored(fingerprints(narrow, shingle=shingle), "simhash")
    roots = fingerprint_roots(fps, distance)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "k1", "k2")
    best = fps.groupBy("fp").agg(F.min(order).alias("best"))
    best = best.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    stays = best.select(F.col("best.k1").alias(k1), F.col("best.k2").alias(k2)).distinct()
    quoted = [F.col(f"`{name}`") for name in columns]
    return keyed.join(stays, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*quoted)
