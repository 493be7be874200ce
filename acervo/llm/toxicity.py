"""Toxic passages by maximum-scoring segments with extreme-value statistics.

Token log-odds come from labelled texts with Dirichlet priors in a chain: the
class shares of all tokens are the prior of those of a word's first four
characters, these of the first five, these of the word. So an unseen form of a
known stem has odds too. A text's tokens are scored by their log-odds less a
drift that makes clean tokens negative on average, and one linear scan finds
all maximal segments. A segment's significance follows the extreme-value law of
such segments, ``E = K n exp(-lambda S)``: lambda is the positive root of
``mean exp(lambda s) = 1`` over clean tokens, and K is fitted to the best
segments of clean texts. The evidence of a text sums ``-log E`` over its
significant segments, and a monotone curve fitted to labelled texts that the
log-odds did not learn from turns it into a probability.

The learning sample is bounded by ``MAX_ROWS`` labelled rows, chosen by a hash
of the id; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from acervo.llm.common import extended, remainder, texts, through_arrow, words

MAX_ROWS = 60_000  # labelled rows that a fit learns from, on average of the hash
WORD_BITS, STEM_BITS = 20, 18  # sizes of the count tables: 2**20 and 2 x 2**18 entries
STEMS = (4, 5)  # bytes
STRENGTH = 4.0  # pseudocounts of each prior
DRIFT = 0.7  # taken from each token's log-odds
LEAST_ODDS = -1.5  # no token speaks more than this against toxicity
SIGNIFICANT = 1.0  # segments with a smaller E count
THRESHOLD = 0.3
REMEMBERED = 60_000  # words whose scores a worker keeps


def buckets(tokens: list[bytes]) -> tuple[np.ndarray, ...]:
    """Numbers of the tokens' stems and of the tokens themselves in the count tables."""
    n = len(tokens)
    out = []
    for size in STEMS:
        out.append(np.fromiter(map(crc32, [t[:size] for t in tokens]), np.uint32, n) & ((1 << STEM_BITS) - 1))
    out.append(np.fromiter(map(crc32, tokens), np.uint32, n) & ((1 << WORD_BITS) - 1))
    return tuple(out)


def token_counts(labelled: DataFrame) -> list[np.ndarray]:
    """Per table, the texts of each class that hold a bucket; column 1 is the toxic class."""
    sizes = [1 << STEM_BITS] * len(STEMS) + [1 << WORD_BITS]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros((2, size), dtype=np.int64) for size in sizes]
        for batch in parts:
            for value, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                for count, own in zip(counts, buckets(words(value))):
                    count[toxic, np.unique(own)] += 1
        for k, count in enumerate(counts):
            at = np.flatnonzero(count.any(axis=0))
            if len(at):
                arrays = [np.full(len(at), k), at, count[0][at], count[1][at]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["k", "at", "clean", "toxic"])

    table = labelled.mapInArrow(run, "k long, at long, clean long, toxic long")
    table = table.groupBy("k", "at").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    k, at, clean, toxic = (table.column(i).to_numpy() for i in range(4))
    out = []
    for i, size in enumerate(sizes):
        count = np.zeros((size, 2))
        count[at[k == i], 0], count[at[k == i], 1] = clean[k == i], toxic[k == i]
        out.append(count)
    return out


class Odds:
    """Log-odds of tokens from the counts of both classes."""

    def __init__(self, counts: list[np.ndarray]):
        self.counts = [count.astype(np.float32) for count in counts]
        total = counts[0].sum(axis=0) + 1
        self.base = float(total[1] / total.sum())
        self.known: dict[bytes, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def of_words(self, tokens: list[bytes]) -> np.ndarray:
        share = self.base
        for count, own in zip(self.counts, buckets(tokens)):
            seen = count[own]
            share = (seen[:, 1] + STRENGTH * share) / (seen[:, 0] + seen[:, 1] + STRENGTH)
        odds = np.log(share / (1 - share)) - np.log(self.base / (1 - self.base))
        return np.maximum(odds, LEAST_ODDS) - DRIFT

    def scores(self, tokens: list[bytes]) -> np.ndarray:
        """Scores of a text's tokens."""
        get = self.known.get
        found = [get(token) for token in tokens]
        missing = [i for i, score in enumerate(found) if score is None]
        if missing:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for i, score in zip(missing, self.of_words([tokens[i] for i in missing]).tolist()):
                found[i] = score
                if len(tokens[i]) <= 64:
                    self.known[tokens[i]] = score
        return np.array(found, dtype=np.float64)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` in one pass over the scores.

    Neighbouring scores of one sign are taken together first; that changes no segment.
    """
    if not len(scores):
        return []
    positive = scores > 0
    edges = np.concatenate([[0], np.flatnonzero(positive[1:] != positive[:-1]) + 1, [len(scores)]])
    sums = np.add.reduceat(scores.astype(np.float64), edges[:-1])
    after = np.cumsum(sums)
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before it, sum after it
    for k in np.flatnonzero(positive[edges[:-1]]).tolist():
        start, end = int(edges[k]), int(edges[k + 1])
        low, high = float(after[k] - sums[k]), float(after[k])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                found.append((start, end, low, high))
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
    return [(start, end, high - low) for start, end, low, high in found]


class Law:
    """Extreme-value law of segment scores in clean text."""

    def __init__(self, decay: float, size: float):
        self.decay, self.size = decay, size

    def surprise(self, score: float, length: int) -> float:
        """``-ln E`` of a segment in a text of so many tokens."""
        return self.decay * score - float(np.log(self.size * max(length, 1)))


def fit_law(histogram: np.ndarray, values: np.ndarray, best: list[tuple[float, float, int]]) -> Law:
    """Decay from the clean tokens' scores, size from the clean texts' best segments by the law's mean."""
    share = histogram / max(histogram.sum(), 1)
    low, high = 1e-3, 30.0
    mean = lambda x: float((share * np.exp(np.minimum(x * values, 500))).sum())
    if not histogram.any() or mean(high) < 1:
        return Law(1.0, 1.0)
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    decay = high
    # E[max S] = (ln(K n) + 0.5772) / lambda
    logs = [decay * s - 0.5772 - np.log(max(n, 1)) for s, n, _ in best]
    size = np.average(logs, weights=[count for _, _, count in best]) if best else 0.0
    return Law(decay, float(np.exp(np.clip(size, -14, 14))))


def passages(tokens: list[bytes], odds: Odds, law: Law) -> tuple[float, list[tuple[int, int, float]]]:
    """A text's evidence and its significant segments with their ``-ln E``."""
    if not tokens:
        return 0.0, []
    found = []
    for start, end, score in maximal_segments(odds.scores(tokens)):
        surprise = law.surprise(score, len(tokens))
        if surprise > -np.log(SIGNIFICANT):
            found.append((start, end, surprise))
    return float(sum(x for _, _, x in found)), found


class Curve:
    """Monotone steps from evidence to probability."""

    def __init__(self, edges: np.ndarray, shares: np.ndarray):
        self.edges, self.shares = edges, shares

    def __call__(self, evidence: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(evidence, self.edges, self.shares), 0.0, 1.0)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> Curve:
    """Pooled adjacent violators over binned evidence."""
    order = np.argsort(evidence, kind="stable")
    pools: list[list[float]] = []  # evidence x weight, toxic, weight
    for x, y, w in zip(evidence[order], toxic[order], weight[order]):
        pools.append([x * w, y, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([x / w for x, _, w in pools])
    # Half a case of doubt to each side keeps shares apart from 0 and 1, and a last small slope keeps order.
    share = np.array([(y + 0.05) / (w + 0.5) for _, y, w in pools])
    return Curve(at, np.maximum.accumulate(share))


class Model:
    def __init__(self, odds: Odds, law: Law, curve: Curve):
        self.odds, self.law, self.curve = odds, law, curve


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, train: Column, most: int) -> DataFrame:
    """``(text, toxic, fold)`` of at most about ``most`` labelled training rows.

    The ids are a bounded sample by hash, so they are broadcast. An id with
    several labels is toxic if one says so; null labels do not count.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(train)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = known.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = known.filter(place < most / max(held, most)).select(
        F.col("doc_id").alias("_id"), (F.col("toxic") == 1).cast("int").alias("_toxic"), F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)).alias("_fold")
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return rows.join(F.broadcast(chosen), "_id").select("_text", "_toxic", "_fold")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train: Column | None = None, most: int = MAX_ROWS) -> Model:
    """Odds from two thirds of the sample, the law from their clean texts, the curve from the last third."""
    rule = (remainder("doc_id", 4) != 2) if train is None else train
    rows = sample(docs, labels, doc_id, text, rule, most)
    odds = Odds(token_counts(rows.filter("_fold <> 0").drop("_fold")))
    shared = docs.sparkSession.sparkContext.broadcast(odds)
    bins = np.linspace(LEAST_ODDS - DRIFT, 12, 400)

    def clean_scores(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histogram, best = np.zeros(len(bins) + 1, dtype=np.int64), {}
        for batch in parts:
            for value in texts(batch.column(0)):
                tokens = words(value)
                if tokens:
                    scores = shared.value.scores(tokens)
                    histogram += np.bincount(np.digitize(scores, bins), minlength=len(bins) + 1)
                    top = max((s for _, _, s in maximal_segments(scores)), default=0.0)
                    key = (round(top, 1), int(np.log2(len(tokens))))
                    best[key] = best.get(key, 0) + 1
        at = np.flatnonzero(histogram)
        rows = [(0, int(i), 0, int(histogram[i])) for i in at] + [(1, int(round(s * 10)), n, c) for (s, n), c in best.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["kind", "a", "b", "n"])

    clean = rows.filter("_fold = 0 and _toxic = 0").select("_text").mapInArrow(clean_scores, "kind long, a long, b long, n long")
    histogram, best = np.zeros(len(bins) + 1), []
    for row in clean.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # bins only
        if row["kind"] == 0:
            histogram[row["a"]] = row["n"]
        else:
            best.append((row["a"] / 10, 1.5 * 2 ** row["b"], row["n"]))
    law = fit_law(histogram, np.append(bins[0], bins), best)

    def held_evidence(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in parts:
            for value, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                evidence, _ = passages(words(value), shared.value, law)
                key = (int(min(evidence, 200.0) * 10), toxic)
                seen[key] = seen.get(key, 0) + 1
        if seen:
            arrays = [[k[0] for k in seen], [k[1] for k in seen], list(seen.values())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["bin", "toxic", "n"])

    held = rows.filter("_fold = 0").select("_text", "_toxic").mapInArrow(held_evidence, "bin long, toxic long, n long")
    table = held.groupBy("bin").agg(F.sum(F.col("n") * F.col("toxic")).alias("toxic"), F.sum("n").alias("n")).collect()
    if not table:
        return Model(odds, law, Curve(np.array([0.0, 50.0]), np.array([0.1, 0.9])))
    columns = [np.array([float(row[c]) for row in table]) for c in ("bin", "toxic", "n")]
    return Model(odds, law, fit_curve(columns[0] / 10, columns[1], columns[2]))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``toxicity``, ``toxic_evidence`` and ``toxic_passages``.

    A passage is ``(start, end, surprise)`` in words. A null or empty text has
    no evidence and the lowest score. Columns of these names are replaced.
    """
    new = ["toxicity", "toxic_evidence", "toxic_passages"]
    kept = [name for name in docs.columns if name not in new]
    at = kept.index(text)
    source = docs.select(*(F.col(f"`{name}`") for name in kept))
    added = "toxicity double, toxic_evidence double, toxic_passages array<struct<start:int,end:int,surprise:double>>"
    schema = extended(source.schema, added)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("surprise", pa.float64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in parts:
            rows = [passages(words(value), own.odds, own.law) for value in texts(batch.column(at))]
            evidence = np.array([x for x, _ in rows], dtype=np.float64)
            found = [[{"start": a, "end": b, "surprise": s} for a, b, s in spans] for _, spans in rows]
            arrays = [pa.array(own.curve(np.minimum(evidence, 200.0))), pa.array(evidence), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*kept, *new])

    return source.mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    A null or empty text holds no passage, so its score is the model's lowest. Repeated
    rows get repeated results, other columns are not read, an empty table gives an empty result.
    """
    model = fit(docs, labels, doc_id, text)
    scored = score(docs.select(doc_id, text), model, doc_id, text)
    return scored.select(
        F.col(doc_id).alias("doc_id"),
        (remainder(doc_id, 4) == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
        "toxic_evidence",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns; clean rows stay as they are.

    A null or empty text holds no passage, so its score is the model's lowest. Repeated
    rows go or stay together. Columns of any name and type are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text))
    at = docs.columns.index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in parts:
            evidence = [passages(words(value), own.odds, own.law)[0] for value in texts(batch.column(at))]
            yield batch.filter(pa.array(own.curve(np.minimum(np.array(evidence), 200.0)) < THRESHOLD))

    return through_arrow(docs, run, docs.schema)
