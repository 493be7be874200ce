"""Hidden Markov language model: Baum-Welch over all training texts, exact scaled forward scores.

Words are counted over all training texts. The most frequent ones, at most
``OWN_WORDS`` of them and the end of a text, are symbols of their own; each
other word belongs to one of ``CLASSES`` classes, chosen by a hash of its first
characters, and its probability is that of the class times the word's share of
the class, which does not depend on the state. Unknown words are one more word
of every class. So the tables that the states need have a fixed bound, while
the counts of rare words stay in Spark and are joined by word; none of those is
frequent, so that join has no hot key.

Texts are written once as symbol numbers. Each round of Baum-Welch adds the
expected counts of all training texts in their tasks and sums them by symbol. A
text is taken a stretch at a time to bound the tables; the forward state goes on
from one stretch to the next, so each transition counts once and only a text's
beginning counts as a start (what follows a stretch is not looked at from within it).
Scores run the scaled forward recursion over whole texts.

Words of over ``LONG`` bytes are told by a digest, so that neither the table of
frequent words nor a join holds them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acervo.llm.common import extended, remainder, stored, texts, words

STATES = 6
ROUNDS = 4
STRETCH = 128  # symbols whose expected counts are taken together
LANES, LANE_BYTES = 2048, 64 << 20  # texts that are read side by side, and the bytes of their symbols
LONG = 64  # bytes of the longest word that is kept as it is
OWN_WORDS = 20_000  # with the classes below 65,536, so that symbols take two bytes
COUNTED_WORDS = 200_000  # frequent words whose counts every task holds
CLASSES = 512
SEED = 20_240_501
END = b""  # no word is empty, so this is free for the end of a text


def tokens_of(text: bytes | None) -> list[bytes]:
    """A text's words, long ones by their first characters and a digest.

    No word holds a blank, so none can be taken for the digest of another.
    """
    found = words(text)
    if found and max(map(len, found)) > LONG:
        return [w if len(w) <= LONG else w[:4] + b" " + blake2b(w, digest_size=24).digest() for w in found]
    return found


def word_counts(docs: DataFrame, text: str = "text", most: int = 200_000) -> DataFrame:
    """``(word, n)`` over all texts of ``docs``; tasks add up what they have seen in bounded tables."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in parts:
            for value in texts(batch.column(0)):
                counts.update(tokens_of(value))
                counts[END] += 1
                if len(counts) > most:
                    yield flushed(counts)
                    counts = Counter()
        if counts:
            yield flushed(counts)

    def flushed(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    partial = docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def at_most(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, to an eighth of a power of two."""
    step = F.floor(F.log2("n") * 8).cast("long")
    bins = counts.groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("top"), F.min("n").alias("low"))
    least, held = None, 0
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # at most 8 x 63 bins
        held += row["words"]
        if held > most:
            break
        least = row["low"]
    return least if least is not None else 1 << 62


class Vocabulary:
    """Frequent words with their counts, and which symbol a word is."""

    def __init__(self, frequent: list[tuple[bytes, int]], own: int):
        ranked = sorted(frequent, key=lambda x: (-x[1], x[0]))
        self.number = {word: i for i, (word, _) in enumerate(ranked)}
        self.counts = np.array([n for _, n in ranked], dtype=np.float64)
        self.own = min(own, len(ranked))
        first = np.array([word_class(word) for word, _ in ranked], dtype=np.int64) + self.own
        self.symbol = np.where(np.arange(len(ranked)) < self.own, np.arange(len(ranked)), first)
        self.symbols = self.own + CLASSES


def word_class(word: bytes) -> int:
    """Class of a rare word by its first characters, which tell languages apart."""
    return crc32(word[:4]) % CLASSES


def encoded(docs: DataFrame, vocabulary, keep: list[str], text: str) -> DataFrame:
    """The ``keep`` columns with ``n_tokens``, ``symbols``, ``frequent`` (numbers) and ``rare`` (words)."""
    source = docs.select(*(F.col(f"`{name}`") for name in keep), F.col(f"`{text}`").alias("_text"))
    added = "n_tokens long, symbols binary, base_part double, word_part double, n_frequent long, rare array<binary>"
    schema = extended(source.drop("_text").schema, added)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = vocabulary.value
        get, base, share = held.vocabulary.number.get, held.base, held.share
        symbol = np.append(held.vocabulary.symbol, -1).astype(np.int32)
        own = held.vocabulary.own
        for batch in parts:
            columns: list[list] = [[], [], [], [], [], []]
            for value in texts(batch.column(len(keep))):
                tokens = tokens_of(value)
                tokens.append(END)
                found = np.fromiter((get(t, -1) for t in tokens), np.int32, len(tokens))
                symbols = symbol[found]
                missing = np.flatnonzero(found < 0)
                rare = [tokens[i] for i in missing]
                if rare:
                    symbols[missing] = np.fromiter(map(word_class, rare), np.int32, len(rare)) + own
                hit = found[found >= 0]
                row = (len(tokens), symbols.astype(np.uint16).tobytes(), base[hit].sum(), share[hit].sum(), len(hit), rare)
                for column, x in zip(columns, row):
                    column.append(x)
            kinds = (pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()))
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], schema.names)

    return source.mapInArrow(run, schema)


class Shared:
    """What tasks need for encoding, with logarithms of the frequent words' factors."""

    def __init__(self, vocabulary: Vocabulary, n: int, distinct: int, class_words: np.ndarray, class_counts: np.ndarray):
        self.vocabulary = vocabulary
        self.base = np.log10((vocabulary.counts + 1) / (n + distinct + 1))
        at = np.maximum(vocabulary.symbol - vocabulary.own, 0)
        inside = (vocabulary.counts + 1) / (class_counts[at] + class_words[at] + 1)
        self.share = np.where(np.arange(len(at)) < vocabulary.own, 0.0, np.log10(inside))


class Model:
    """Start, transition and emission probabilities of the states."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emits: np.ndarray):
        self.start, self.moves, self.emits = start, moves, emits  # emits: symbol x state


def first_model(symbol_counts: np.ndarray, states: int, seed: int = SEED) -> Model:
    """Symbols' shares with a seeded disturbance; states tend to stay, so that stretches of one kind gather."""
    random = np.random.default_rng(seed)
    emits = (symbol_counts[:, None] + 0.5) * random.uniform(0.4, 1.6, (len(symbol_counts), states))
    moves = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * (0.9 - 0.1 / max(states - 1, 1))
    return Model(np.full(states, 1 / states), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def expected_counts(
    model: Model, stretches: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None, fresh: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, transition and emission counts of padded rows of symbols (one stretch each, longest first).

    Rows that are not ``fresh`` go on from the states' shares ``before`` them. The
    shares at the end of each row come last.
    """
    rows, steps = stretches.shape
    states = len(model.start)
    fresh = np.ones(rows, dtype=bool) if fresh is None else fresh
    live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(steps + 1)]  # rows longer than t
    emits = model.emits
    forward = np.empty((steps, rows, states))
    scale = np.empty((steps, rows))
    for t in range(steps):
        k = live[t]
        if t:
            ahead = forward[t - 1, :k] @ model.moves
        else:
            ahead = np.broadcast_to(model.start, (k, states)) if before is None else np.where(fresh[:, None], model.start, before @ model.moves)
        np.multiply(ahead, emits[stretches[:k, t]], out=forward[t, :k])
        scale[t, :k] = forward[t, :k].sum(axis=1)
        forward[t, :k] /= scale[t, :k, None]
    last = forward[lengths - 1, np.arange(rows)]
    moves = np.zeros((states, states))
    backward = np.ones((rows, states))
    for t in range(steps - 1, 0, -1):
        k = live[t]
        # forward[t] becomes the states' shares at t once what follows is known
        after = backward[:k] * emits[stretches[:k, t]] / scale[t, :k, None]
        moves += forward[t - 1, :k].T @ after
        forward[t, :k] *= backward[:k]
        backward[:k] = after @ model.moves.T
    if before is not None:
        into = backward * emits[stretches[:, 0]] / scale[0][:, None]
        moves += before[~fresh].T @ into[~fresh]
    forward[0] *= backward
    start = forward[0][fresh].sum(axis=0)
    counts = np.zeros((len(emits), states))
    flat = [(stretches[: live[t], t], forward[t, : live[t]]) for t in range(steps)]
    symbols = np.concatenate([s for s, _ in flat])
    shares = np.concatenate([g for _, g in flat])
    for j in range(states):
        counts[:, j] = np.bincount(symbols, weights=shares[:, j], minlength=len(emits))
    return start, moves * model.moves, counts, last


def summed_counts(model: Model, texts: Iterator[np.ndarray], stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, transition and emission counts of whole texts, read side by side a stretch at a time.

    A text that ends makes room for the next one.
    """
    states = len(model.start)
    start, moves, counts = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emits)
    lanes: list[list] = []  # symbols, how many are done, shares of the states there
    held, more = 0, True
    while lanes or more:
        while more and len(lanes) < LANES and held < LANE_BYTES:
            symbols = next(texts, None)
            more = symbols is not None
            if more and len(symbols):
                lanes.append([symbols, 0, None])
                held += symbols.nbytes
        if not lanes:
            continue
        lanes.sort(key=lambda lane: lane[1] - len(lane[0]))
        table, lengths = padded_in_order([symbols[done : done + stretch] for symbols, done, _ in lanes])
        fresh = np.array([done == 0 for _, done, _ in lanes])
        before = np.array([model.start if shares is None else shares for _, _, shares in lanes])
        a, b, c, last = expected_counts(model, table, lengths, before, fresh)
        start += a
        moves += b
        counts += c
        for lane, n, shares in zip(lanes, lengths.tolist(), last):
            lane[1] += n
            lane[2] = shares
        held -= sum(symbols.nbytes for symbols, done, _ in lanes if done == len(symbols))
        lanes = [lane for lane in lanes if lane[1] < len(lane[0])]
    return start, moves, counts


def trained(enc: DataFrame, symbol_counts: np.ndarray, states: int, rounds: int) -> Model:
    """Baum-Welch on the symbols of all rows of ``enc``; counts are summed by symbol in Spark.

    What reaches the driver each round is one row per symbol, a bounded number.
    """
    model = first_model(symbol_counts, states)
    spark = enc.sparkSession
    n_symbols = len(symbol_counts)
    columns = [f"s{j}" for j in range(states)]
    schema = "row long, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values = (x for batch in parts for i in range(0, len(batch), 500) for x in batch.column(0).slice(i, 500).to_pylist())
            start, moves, counts = summed_counts(shared.value, (np.frombuffer(x, dtype=np.uint16) for x in values))
            at = np.flatnonzero(counts.any(axis=1))
            values = np.concatenate([start[None], moves, counts[at]])
            rows = np.concatenate([[-1], -2 - np.arange(states), at])
            yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(values[:, j]) for j in range(states))], ["row", *columns])

        sums = enc.select("symbols").mapInArrow(run, schema).groupBy("row").agg(*(F.sum(c).alias(c) for c in columns))
        table = sums.toArrow()
        shared.destroy()
        row = table.column("row").to_numpy()
        values = np.stack([table.column(c).to_numpy() for c in columns], axis=1)
        if not len(row):
            return model
        start, moves, counts = np.zeros(states), np.zeros((states, states)), np.zeros((n_symbols, states))
        start += values[row == -1].sum(axis=0)
        for j in range(states):
            moves[j] = values[row == -2 - j].sum(axis=0)
        counts[row[row >= 0]] = values[row >= 0]
        # A pseudocount in proportion to a symbol's share keeps every symbol possible in every state.
        prior = (symbol_counts + 0.5) / (symbol_counts + 0.5).sum()
        emits = counts + 200.0 * prior[:, None]
        model = Model((start + 1) / (start + 1).sum(), (moves + 1) / (moves + 1).sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
    return model


def forward_log10(model: Model, rows: list[np.ndarray], together: int = 256) -> np.ndarray:
    """log10 of each symbol sequence's probability, by the scaled forward recursion over its whole length."""
    out = np.zeros(len(rows))
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    emits, moves = model.emits, model.moves
    for begin in range(0, len(order), together):
        chosen = [i for i in order[begin : begin + together] if len(rows[i])]
        if not chosen:
            continue
        lengths = np.array([len(rows[i]) for i in chosen])
        total = np.zeros(len(chosen))
        state = None
        for t0 in range(0, int(lengths[0]), 1024):  # a slice of the longest texts at a time bounds the table
            k0 = int(np.searchsorted(-lengths, -t0, side="left"))
            part = [rows[i][t0 : t0 + 1024] for i in chosen[:k0]]
            table, own = padded_in_order(part)
            scale = np.ones((k0, table.shape[1]))
            for t in range(table.shape[1]):
                k = int(np.searchsorted(-own, -t, side="left"))
                ahead = np.broadcast_to(model.start, (k, len(model.start))) if state is None else state[:k] @ moves
                state = ahead * emits[table[:k, t]]
                sums = state.sum(axis=1)
                state /= sums[:, None]
                scale[:k, t] = sums
            total[:k0] += np.log10(scale).sum(axis=1)
        out[chosen] = total
    return out


def padded_in_order(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of symbols, longest first, as one table, with their lengths."""
    lengths = np.array(list(map(len, rows)))
    out = np.zeros((len(rows), lengths[0]), dtype=np.int32)
    out[np.arange(lengths[0])[None, :] < lengths[:, None]] = np.concatenate(rows)
    return out, lengths


def forward_scores(enc: DataFrame, model: Model) -> DataFrame:
    """``enc`` without its symbols, with ``hmm_part``."""
    shared = enc.sparkSession.sparkContext.broadcast(model)
    kept = [name for name in enc.columns if name not in ("symbols", "rare")]
    source = enc.select(*kept, "symbols")
    schema = extended(enc.select(*kept).schema, "hmm_part double")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = [np.frombuffer(x, dtype=np.uint16) for x in batch.column(len(kept)).to_pylist()]
            out = pa.array(forward_log10(shared.value, rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], out], schema.names)

    return source.mapInArrow(run, schema)


def score(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out=None,
    states: int = STATES,
    rounds: int = ROUNDS,
    own_words: int = OWN_WORDS,
    counted_words: int = COUNTED_WORDS,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs``.

    Rows where ``held_out`` (default: crc32 of the id modulo 7 is 2) is false
    train the model. A null or empty text is its end alone; without any
    training text every word is unknown. Repeated rows count and are scored each.
    Other columns are not read.
    """
    rule = held_out if held_out is not None else remainder(doc_id, 7) == 2
    source = docs.select(F.col(doc_id).alias("doc_id"), rule.alias("held_out"), F.col(text).alias("text"))
    spark = docs.sparkSession
    counts = stored(word_counts(source.filter(~F.col("held_out"))), "hmm-counts", "zstd")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, distinct = totals["n"], totals["v"]
    table = counts.filter(F.col("n") >= at_most(counts, counted_words)).toArrow()
    frequent = list(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
    vocabulary = Vocabulary(frequent, own_words)

    # How many words and tokens each class holds: those that are no symbols of their own.
    klass = F.pmod(F.crc32(F.substring("word", 1, 4)), F.lit(CLASSES))
    per_class = counts.groupBy(klass.alias("class")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()
    class_words, class_counts = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in per_class:
        class_words[row["class"]], class_counts[row["class"]] = row["words"], row["n"]
    own = sorted(frequent, key=lambda x: (-x[1], x[0]))[: vocabulary.own]
    for word, count in own:
        class_words[word_class(word)] -= 1
        class_counts[word_class(word)] -= count
    symbol_counts = np.concatenate([vocabulary.counts[: vocabulary.own], class_counts])

    shared = spark.sparkContext.broadcast(Shared(vocabulary, n, distinct, class_words, class_counts))
    enc = encoded(source.withColumn("row", F.monotonically_increasing_id()), shared, ["row", "doc_id", "held_out"], "text")
    enc = stored(enc, "hmm-symbols", "zstd")
    model = trained(enc.filter(~F.col("held_out")), symbol_counts, states, rounds)
    scored = forward_scores(enc, model)

    # Rare words meet their counts by word; each text's share of them is then summed by row.
    in_class = spark.createDataFrame([(k, float(class_words[k] + class_counts[k] + 1)) for k in range(CLASSES)], "class long, room double")
    rare = enc.select("row", F.explode("rare").alias("word"))
    met = rare.join(counts, "word", "left").withColumn("class", klass).join(F.broadcast(in_class), "class")
    count = F.coalesce("n", F.lit(0))
    tail = met.groupBy("row").agg(
        F.sum(F.log10((count + 1) / F.lit(float(n + distinct + 1)))).alias("base_rare"),
        F.sum(F.log10((count + 1) / F.col("room"))).alias("word_rare"),
        F.sum(F.when(count > 0, 1).otherwise(0)).alias("known_rare"),
    )
    zero = F.lit(0.0)
    return scored.join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce("base_rare", zero)).alias("base_score"),
        (F.col("hmm_part") + F.col("word_part") + F.coalesce("word_rare", zero)).alias("score"),
    )
