"""Spelling variants: words of a corpus at one edit from each other, by pivotal grams.

A word's bigrams are ordered by how rare they are among all words. Its prefix
are the three rarest (with all others of the third one's rank); its pivots are
two of them that do not overlap, chosen by dynamic programming so that the
bigrams are as rare as possible. One edit cannot touch both pivots, so of two
near words the one whose prefix ends at the rarer bigram has a pivot that the
other one holds in its prefix.

Position limits make the index narrow. The edit lies on one side of the shared
pivot, so on the other side the words are equal from the pivot to the end. Where
that side is short, the side with the edit is halved, and one of its halves is
equal too. A key names the side, the equal parts and the pivot; words that share
a key are verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from acervo.llm.common import stored, texts

RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10  # a form is at least so many times as frequent as its variant
DROP = 31  # one in so many runs of a text loses a code point
STRONG = 6  # code points: an equal side of this length needs no half beside it
HELD = 200_000  # words that a task counts before it passes them on


def words_of(doc_id: object, text: bytes, pattern: re.Pattern) -> Iterator[tuple[str, int]]:
    """The words of one text and how often each occurs."""
    base = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    for run, count in Counter(pattern.findall(text.lower().decode())).items():
        h = zlib.crc32(run.encode(), base)
        if h % DROP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            yield run, count


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: all words that occur often enough in ``docs``."""
    # Shorter runs cannot give a word, as a run only loses code points.
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, counts = re.compile(RUN + "{%d,}" % LEAST_LENGTH), Counter()
        for batch in parts:
            for own, value in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                for word, n in words_of(own, value, pattern) if value else ():
                    counts[word] += n
                if len(counts) >= HELD:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank and count of every bigram of the words, rare ones first; the alphabet bounds them to some thousands."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in parts:
            for word in batch.column(0).to_pylist():
                counts.update(map("".join, zip(word, word[1:])))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])

    found = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {row["gram"]: (rank, row["n"]) for rank, row in enumerate(sorted(found, key=lambda r: (r["n"], r["gram"])))}


def prefix_of(word: str, ranks: dict[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(position, rank, count)`` of the three rarest bigrams and of all that rank with the last."""
    grams = [(i, *ranks[word[i : i + 2]]) for i in range(len(word) - 1)]
    last = sorted(rank for _, rank, _ in grams)[2]
    return [gram for gram in grams if gram[1] <= last]


def pivots_of(prefix: list[tuple[int, int, int]], wanted: int = 2) -> list[int]:
    """Positions of ``wanted`` bigrams of a prefix that do not overlap and are least frequent together.

    ``best[k]`` is the cheapest choice of k bigrams among those seen so far; one
    more bigram extends the choices that end before it begins.
    """
    history: list[list[tuple[int, list[int]] | None]] = []
    for place, (at, _, count) in enumerate(prefix):
        before = next((history[j] for j in range(place - 1, -1, -1) if prefix[j][0] <= at - 2), None)
        best = list(history[-1]) if history else [(0, []), *[None] * wanted]
        for k in range(1, wanted + 1):
            shorter = (before[k - 1] if before else (0, [])) if before or k == 1 else None
            if shorter is not None and (best[k] is None or shorter[0] + count < best[k][0]):
                best[k] = (shorter[0] + count, [*shorter[1], at])
        history.append(best)
    return history[-1][wanted][1]


def side_keys(word: str, at: int, lengths: tuple[int, ...]) -> Iterator[str]:
    """Names of what stays equal when one edit lies right or left of the bigram at ``at``.

    ``lengths`` are added to the length of the edited side: 0 for a pivot, every
    length that the other word's side may have for a prefix bigram.
    """
    left, rest = word[: at + 2], word[at + 2 :]
    if len(left) >= STRONG:
        yield f"l {left}"
    else:
        for k in (len(rest) + more for more in lengths):
            if k >= 0:
                head, tail = k // 2, k - k // 2
                yield f"lh {at} {left}{rest[:head]}"
                if tail <= len(rest):
                    yield f"lt {left} {rest[len(rest) - tail :]}"
    rest, right = word[:at], word[at:]
    if len(right) >= STRONG:
        yield f"r {right}"
    else:
        for k in (len(rest) + more for more in lengths):
            if k >= 0:
                head, tail = k // 2, k - k // 2
                if tail <= len(rest):
                    yield f"rt {len(right)} {rest[len(rest) - tail :]}{right}"
                if head <= len(rest):
                    yield f"rh {rest[:head]} {right}"


def index_rows(words: DataFrame, ranks: dict[str, tuple[int, int]], pivots: bool) -> DataFrame:
    """``(key, last, word, n)``: the keys of each word's pivots, or of its prefix, and the rank at which the prefix ends."""
    shared = words.sparkSession.sparkContext.broadcast(ranks)  # bounded by the square of the alphabet

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for start in range(0, len(whole), 2000):
                yield rows(whole.slice(start, 2000))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, lasts, at = [], [], []
        for i, word in enumerate(batch.column(0).to_pylist()):
            prefix = prefix_of(word, shared.value)
            places = pivots_of(prefix) if pivots else [p for p, _, _ in prefix]
            own = {key for p in places for key in side_keys(word, p, (0,) if pivots else (-1, 0, 1))}
            keys += [xxhash.xxh3_64_intdigest(key) - (1 << 63) for key in own]
            lasts += [max(rank for _, rank, _ in prefix)] * len(own)
            at += [i] * len(own)
        taken = batch.take(pa.array(at, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lasts, pa.int64()), *taken.columns], ["key", "last", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, last long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``: all ordered pairs of ``words(word, n)`` at one edit from each other."""
    ranks = gram_ranks(words)
    left = index_rows(words, ranks, pivots=True)
    right = index_rows(words, ranks, pivots=False).toDF("key", "other_last", "other", "other_n")
    gap = F.abs(F.length("word") - F.length("other"))
    one = (F.levenshtein("word", "other", 1) == 1) & (gap <= 1)
    met = left.join(right, "key").filter(F.col("last") <= F.col("other_last")).filter(one).select("word", "n", "other", "other_n")
    turned = met.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return met.unionByName(turned).distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: where following the forms ends, by doubling the steps.

    Each form is far more frequent than its word, so chains are short and never turn back.
    """
    steps = stored(forms.toDF("word", "root"), "variant-steps")
    while True:
        further = steps.toDF("root", "end")
        if not steps.join(further, "root").take(1):
            return steps
        steps = stored(steps.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root")), "variant-steps")


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for all words of the texts.

    A null or empty text has no words, a null id counts as the empty text where a
    run's code point is chosen. Repeated rows count again. Of equally frequent near
    words the smallest in code-point order is the form. Other columns are not read,
    so their names do not matter. An empty table gives an empty result.
    """
    words = stored(vocabulary(docs, doc_id, text), "variant-words")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    joined = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    has_form = F.col("form_n") >= ratio * F.col("n")
    judged = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.other")).alias("form"),
        F.when(has_form, F.col("form_n")).alias("form_n"),
    )
    judged = stored(judged, "variant-judged")
    roots = roots_of(judged.filter("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
