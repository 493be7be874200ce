"""Benchmark passages in documents by the CGK embedding, bit sampling and exact edit verification.

Items and documents are sequences of words (letters and digits, lower case), or
of characters in scripts that write without blanks.
An item is found in a document where some span of it is within
``MAX_EDIT * length`` word edits of the item. The search:

* Windows of an item's length start at every word of a document. A window can
  hold a match only if enough of its word triples occur in the benchmark;
  by the q-gram count, ``length - 2 - 3 * edits`` of an item's triples survive its
  edits. A bitmap of them, of fixed size, leaves few windows.
* The CGK random walk maps a window to a longer sequence: at each step it copies
  the current word and moves on, or not, by a random bit of step and word. Few
  edits between two sequences become few differing positions.
* Each of many repeats samples positions of a walk; windows and items that agree
  on all sampled positions meet. The number of repeats follows from a target
  recall and the share of equal positions expected at the largest distance.
* Every meeting is verified: the least word edits between the item and any span
  near the window.

The benchmark is the query set: it is read in blocks of bounded size, and every
document is compared with each block in the tasks that read it, so documents
are not shuffled. Long items are compared in pieces of at most ``PIECE`` words.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acervo.llm.common import extended, stored, texts, through_arrow

MAX_EDIT = 0.15  # word edits per word of the item
PIECE = 96  # words of an item that are compared as one
BLOCK_ITEMS = 5_000  # items, in pieces, that tasks hold at once
BLOCK_BYTES = 16 << 20  # and bytes of their texts
SAMPLES = 3  # positions that a repeat compares
SHARE = 0.55  # equal positions expected at the largest distance
RECALL = 0.99
MAP_BITS = 22
# ASCII letters and digits and all bytes of other characters stay; the rest parts words.
PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
# White space and CJK punctuation beyond ASCII, and characters of scripts that write without blanks, in UTF-8:
# Thai, Lao, Myanmar, Khmer, kana and ideographs.
BLANKS = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80[\x80-\x84\x88-\x9f]|\xef\xbb\xbf"
    rb"|\xef\xbc[\x81-\x8f\x9a-\xa0\xbb-\xbf]|\xef\xbd[\x80\x9b-\xa5]"
)
ALONE = re.compile(
    rb"\xe0[\xb8-\xbb][\x80-\xbf]|\xe1(?:[\x80\x81][\x80-\xbf]|\x82[\x80-\x9f]|[\x9e\x9f][\x80-\xbf])"
    rb"|\xe3[\x81-\x83\x90-\xbf][\x80-\xbf]|[\xe4-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]|\xf0[\xa0-\xbf][\x80-\xbf]{2}"
)
SEED = 71


def repeats(recall: float = RECALL, share: float = SHARE, samples: int = SAMPLES) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - share**samples))


def tokens(text: bytes | None) -> list[bytes]:
    """Words without ASCII punctuation, with A-Z lower-cased; single characters of scripts that write without blanks."""
    if not text:
        return []
    if not text.isascii():
        text = ALONE.sub(rb" \g<0> ", BLANKS.sub(b" ", text))
    return text.translate(PLAIN).split()


def numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def runs(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each word with the ``size - 1`` next ones."""
    mixed = codes[: len(codes) - size + 1].copy()
    for k in range(1, size):
        mixed = mixed * np.uint32(0x9E3779B1) ^ codes[k : len(codes) - size + 1 + k]
    return (mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - MAP_BITS)


def edits_allowed(length: int, rate: float = MAX_EDIT) -> int:
    return int(length * rate + 1e-9)


class Walks:
    """Random bits of the walks and the positions that repeats sample."""

    def __init__(self, count: int, samples: int, longest: int, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.steps = 3 * longest
        self.salts = random.integers(0, 1 << 32, (count, self.steps), dtype=np.uint32) | np.uint32(1)
        self.samples = random.random((count, samples))
        self.mix = random.integers(1, 1 << 63, samples, dtype=np.uint64) | np.uint64(1)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """A key for each repeat (columns) of each row; all rows have one length."""
        rows, length = windows.shape
        repeats = np.arange(len(self.salts))
        flat = np.concatenate([windows, np.zeros((rows, 1), dtype=np.uint32)], axis=1).ravel()
        # Most walks are inside their window for two steps a word.
        wanted = np.sort((self.samples * 2.0 * length).astype(np.int64), axis=1)
        own = [np.nonzero(wanted == t) for t in range(int(wanted.max()) + 1)]
        base = (np.arange(rows, dtype=np.int32) * (length + 1))[:, None]
        place = np.tile(base, (1, len(repeats)))
        last = base + length
        keys = np.tile((repeats + 1).astype(np.uint64), (rows, 1))
        word = np.empty(place.shape, dtype=np.uint32)
        for t, (repeat, nth) in enumerate(own):
            np.take(flat, place, out=word, mode="clip")
            for k in range(self.samples.shape[1]):  # a repeat may sample one position twice
                some = repeat[nth == k]
                if len(some):
                    key = (keys[:, some] ^ word[:, some]) * self.mix[k]
                    keys[:, some] = key ^ (key >> np.uint64(29))
            word += np.uint32(1)
            word *= self.salts[:, t]
            word >>= np.uint32(31)
            place += word.view(np.int32)
            np.minimum(place, last, out=place)
        return keys


def column_scores(pattern: list[int], text: list[int]) -> list[int]:
    """For each end in ``text`` the least edits between ``pattern`` and a span that ends there.

    The columns of the edit table are kept as bit vectors of their steps, so a
    column costs a few operations on integers of the pattern's length.
    """
    n = len(pattern)
    full, top = (1 << n) - 1, 1 << (n - 1)
    where: dict[int, int] = defaultdict(int)
    for i, word in enumerate(pattern):
        where[word] |= 1 << i
    up, down, score, out = full, 0, n, []
    for word in text:
        same = where.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rise, fall = down | (full & ~(diagonal | up)), up & diagonal
        score += (rise & top > 0) - (fall & top > 0)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~((same | down) | rise)), rise & (same | down)
        out.append(score)
    return out


def least_edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edits between ``item`` and any span of ``text``, with that span; ties to the first end, then the longest."""
    pattern, words = item.tolist(), text.tolist()
    ends = column_scores(pattern, words)
    best = min(ends, default=len(pattern))
    if best >= len(pattern):
        return len(pattern), 0, 0
    end = ends.index(best) + 1
    # Backwards from that end, the scores of all spans that end there.
    starts = column_scores(pattern[::-1], words[:end][::-1])
    begin = max(i for i, score in enumerate(starts) if score == best)
    return best, end - begin - 1, end


class Block:
    """Pieces of benchmark items, their sampled keys by length, and the bitmap of their word pairs."""

    def __init__(self, pieces: list[tuple[int, bytes]], rate: float, recall: float):
        self.rate = rate
        self.pieces = [(item, numbers(tokens(text))) for item, text in pieces]
        self.walks = Walks(repeats(recall), SAMPLES, PIECE)
        self.lengths: dict[int, dict[int, list[int]]] = {}
        self.own_runs: dict[int, np.ndarray] = {}  # triples of the pieces of a length
        self.known = np.zeros(1 << MAP_BITS, dtype=bool)  # triples of all pieces
        by_length = defaultdict(list)
        self.short: dict[int, dict[bytes, list[int]]] = {}  # by length, items too short for an edit by their words
        for k, (_, codes) in enumerate(self.pieces):
            if not edits_allowed(len(codes), rate):
                self.short.setdefault(len(codes), {}).setdefault(b" ".join(tokens(pieces[k][1])), []).append(k)
                continue
            by_length[len(codes)].append(k)
            self.known[runs(codes, 3)] = True
        for length, members in sorted(by_length.items()):
            keys = self.walks.keys(np.stack([self.pieces[k][1] for k in members]))
            table: dict[int, list[int]] = defaultdict(list)
            for k, row in zip(members, keys.tolist()):
                for key in row:
                    table[key].append(k)
            self.lengths[length] = dict(table)
            self.own_runs[length] = np.unique(np.concatenate([runs(self.pieces[k][1], 3) for k in members]))
        self.sorted_keys = {length: np.array(sorted(table), dtype=np.uint64) for length, table in self.lengths.items()}

    def exact(self, words: list[bytes]) -> dict[int, tuple[int, int, int, int]]:
        """The first run of ``words`` that equals each short item, as ``matches`` tells it."""
        out: dict[int, tuple[int, int, int, int]] = {}
        for n, table in self.short.items():
            for a, run in enumerate(map(b" ".join, zip(*(words[i:] for i in range(n))))):
                for piece in table.get(run, ()):
                    out.setdefault(piece, (0, a, a + n, n))
        return out

    def matches(self, texts: list[np.ndarray]) -> list[dict[int, tuple[int, int, int, int]]]:
        """For each text its best match of each piece: ``(edits, start, end, words of the piece)``."""
        out: list[dict[int, tuple[int, int, int, int]]] = [{} for _ in texts]
        if not self.lengths:
            return out
        gap = np.zeros(2 * PIECE, dtype=np.uint32)  # no window reaches from one text into the next
        codes = np.concatenate([part for text in texts for part in (text, gap)] or [gap])
        first = np.concatenate([[0], np.cumsum([len(text) + len(gap) for text in texts])]).astype(np.int64)
        triples = runs(codes, 3)
        near = self.near(np.concatenate([[0], np.cumsum(self.known[triples], dtype=np.int32)]))
        near = near[near < len(triples)]
        if not len(near):
            return out
        own = triples[near]
        for length, table in self.lengths.items():
            edits = edits_allowed(length, self.rate)
            # Runs of places are long enough for the windows that matter; others only add candidates.
            hits = np.concatenate([[0], np.cumsum(np.isin(own, self.own_runs[length])), np.zeros(length, dtype=np.int64)])
            hits[len(own) + 1 :] = hits[len(own)]
            # A window that starts with a match may miss `edits` words at its end.
            need = max(length - 2 - 4 * edits, 1)
            starts = near[hits[length - 2 : length - 2 + len(own)] - hits[: len(own)] >= need]
            starts = starts[starts + length <= len(codes)]
            for a in range(0, len(starts), 2048):
                self.compare(codes, first, starts[a : a + 2048], length, edits, table, out)
        return out

    def near(self, hits: np.ndarray) -> np.ndarray:
        """Places in or close to a stretch that holds as many known triples as a match needs.

        A match of n words and e edits has at least n - 2 - 3 e known triples among at
        most n + e - 2, so one of the stretches that cover it, each as long as the
        shortest piece, has its share of them.
        """
        span = max(min(self.lengths) - 2, 1)
        shares, reach = [], 0
        for n in self.lengths:
            e = edits_allowed(n, self.rate)
            shares.append(-(-(n - 2 - 3 * e) // -(-(n + e - 2) // span)))
            reach = max(reach, n + e)
        if len(hits) <= span:
            return np.empty(0, dtype=np.int64)
        dense = np.flatnonzero(hits[span:] - hits[:-span] >= max(min(shares), 1))
        marks = np.zeros(len(hits) + span + 1, dtype=np.int32)
        np.add.at(marks, np.maximum(dense - reach, 0), 1)
        np.add.at(marks, np.minimum(dense + span + reach, len(hits) + span), -1)
        return np.flatnonzero(np.cumsum(marks)[: len(hits)] > 0)

    def compare(self, codes, first, starts, length, edits, table, out) -> None:
        """Meetings of windows and pieces of one length, each verified once for a stretch of starts."""
        keys = self.walks.keys(codes[starts[:, None] + np.arange(length)[None, :]])
        known = self.sorted_keys[length]
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        meetings = {
            (piece, int(starts[row]) // (edits + 1))
            for row, column in np.argwhere(known[place] == keys).tolist()
            for piece in table[int(keys[row, column])]
        }
        for piece, stretch in sorted(meetings):
            start = stretch * (edits + 1)
            text = int(np.searchsorted(first, start + edits, side="right")) - 1
            if out[text].get(piece, (1,))[0] == 0:
                continue
            low = max(int(first[text]), start - 2 * edits - 1)
            high = min(int(first[text + 1]) - 2 * PIECE, start + length + 3 * edits + 2)
            if high <= low:
                continue
            found, begin, end = least_edits(self.pieces[piece][1], codes[low:high])
            if found <= edits and (piece not in out[text] or found < out[text][piece][0]):
                at = low - int(first[text])
                out[text][piece] = (found, at + begin, at + end, length)


def searched_texts(block: Block, values: list[bytes | None], most: int = 400_000) -> Iterator[dict[int, tuple[int, int, int, int]]]:
    """The best matches of each text in turn; some hundred thousand words are compared together."""
    held: list[tuple[int, int, np.ndarray]] = []  # text, first word, words
    done: dict[int, dict[int, tuple[int, int, int, int]]] = {}
    size = 0

    def compare() -> None:
        for (i, offset, _), found in zip(held, block.matches([codes for _, _, codes in held])):
            own = done.setdefault(i, {})
            for piece, (edits, a, b, n) in found.items():
                if piece not in own or edits < own[piece][0]:
                    own[piece] = (edits, a + offset, b + offset, n)
        held.clear()

    for i, value in enumerate(values):
        for offset, words in windows_of_text(value):
            held.append((i, offset, numbers(words)))
            for piece, (edits, a, b, n) in block.exact(words).items():
                done.setdefault(i, {}).setdefault(piece, (edits, a + offset, b + offset, n))
            size += len(words) + 2 * PIECE
            if size > most:
                compare()
                size = 0
    compare()
    for i in range(len(values)):
        yield done.get(i, {})


def pieces_of(item: int | None, text: bytes | None) -> list[tuple[int | None, bytes]]:
    words = tokens(text)
    if not words:
        return []
    parts = -(-len(words) // PIECE)
    edges = [len(words) * k // parts for k in range(parts + 1)]
    return [(item, b" ".join(words[a:b])) for a, b in zip(edges, edges[1:])]


def item_pieces(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(key, item_id, piece)``, stored: every piece of every item; pieces of the same words share a key."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = [p for item, value in zip(batch.column(0).to_pylist(), texts(batch.column(1))) for p in pieces_of(item, value)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["item_id", "piece"])

    source = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text"))
    return stored(source.mapInArrow(cut, "item_id long, piece binary").select(F.xxhash64("piece").alias("key"), "item_id", "piece"), "benchmark-pieces")


def blocks(pieces: DataFrame, rate: float, recall: float) -> Iterator[Block]:
    """The distinct pieces of the benchmark, under their keys, in blocks of bounded size."""
    rows = pieces.select("key", "piece").distinct()
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row["key"], bytes(row["piece"])))
        size += len(row["piece"])
        if len(held) == BLOCK_ITEMS or size > BLOCK_BYTES:
            yield Block(held, rate, recall)
            held, size = [], 0
    if held:
        yield Block(held, rate, recall)


def place_to_cut(text: bytes, low: int, high: int) -> int:
    """The last ASCII white space from ``low`` and before ``high``, or else the last character that begins there."""
    space = max(text.rfind(bytes([c]), low, high) for c in b" \t\n\v\f\r")
    if space >= 0:
        return space
    while high > low + 1 and 0x80 <= text[high] < 0xC0:
        high -= 1
    return high


def windows_of_text(text: bytes | None, most: int = 4 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Words of a text with the number of the first; very long texts in overlapping stretches."""
    if text is None:
        return
    first, start = 0, 0
    while start < len(text):
        stop = start + most
        if stop < len(text):
            stop = place_to_cut(text, start + most // 2, stop)
        own = tokens(text[start:stop])
        yield first, own
        if stop >= len(text):
            return
        back = place_to_cut(text, start + most // 4, max(start + most // 4 + 1, stop - 64 * PIECE))
        first += len(own) - len(tokens(text[back:stop]))
        start = back


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = MAX_EDIT,
    recall: float = RECALL,
) -> DataFrame:
    """``(doc_id, item_id, start_word, end_word, edits, item_words)``: the best span of each found piece.

    Rows of clean documents give nothing. Null and empty texts match nothing;
    items too short for one edit are found where all their words are. Items that share
    a piece are all reported. Repeated document rows give repeated results.
    Other columns are not read. An empty benchmark gives an empty result.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = extended(source.drop("text").schema, "key long, start_word int, end_word int, edits int, item_words int")
    out = docs.sparkSession.createDataFrame([], schema)
    pieces = item_pieces(benchmark, item_id, item_text)
    for block in blocks(pieces, rate, recall):
        found = searched(source, docs.sparkSession.sparkContext.broadcast(block), schema)
        out = out.unionByName(found)
    members = pieces.select("key", "item_id").distinct()
    return out.join(members, "key").select("doc_id", "item_id", "start_word", "end_word", "edits", "item_words")


def searched(source: DataFrame, shared, schema) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in parts:
            rows = []
            for i, best in enumerate(searched_texts(block, list(texts(batch.column(1))))):
                rows += [(i, block.pieces[piece][0], a, b, edits, n) for piece, (edits, a, b, n) in best.items()]
            if rows:
                at, *rest = zip(*rows)
                kinds = (pa.int64(), *[pa.int32()] * 4)
                arrays = [batch.column(0).take(pa.array(at)), *(pa.array(x, kind) for x, kind in zip(rest, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = MAX_EDIT
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with their columns."""
    at = docs.columns.index(text)
    for block in blocks(item_pieces(benchmark, item_id, item_text), rate, RECALL):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in parts:
                clean = [not found for found in searched_texts(own, list(texts(batch.column(at))))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = through_arrow(docs, run, docs.schema)
    return docs
