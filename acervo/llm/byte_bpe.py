"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file becomes a vocabulary of printable characters, one per byte, and
the list of all merges that give a token, in rank order. A text is cut at
single blanks between other characters, where the split pattern always starts
a new match, so each piece can be encoded by itself. Pieces seen before come
from a bounded memory; the others of a batch go through the library together.

Offsets come from the tokens' byte lengths: a byte offset is a running sum, and
the characters begun before it give the character offset, so a token that ends
inside a character has an offset too. Decoding looks the ids' bytes up and joins
them; characters that tokens split are whole again in the joined bytes.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from acervo.llm.common import extended, free_name, through_arrow

RANKS = "byte_bpe_multi_50k.tiktoken"
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
LOOSE_BLANK = re.compile(r"\s |^ | (?=\s|$)")  # a blank beside white space or at an end
REMEMBERED = 250_000  # pieces in each of the two tables that a worker keeps
MOST_IDS = 4_000_000  # ids in such a table
TOGETHER = 400  # unknown pieces that go through the library as one text


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it has one, else the next from U+0100."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches ``at`` of a flat array, one after the other."""
    own = lengths[at]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[at] - (ends - own), own)]


def spelled_out(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Stretches of ids as decimal numbers, each followed by a comma."""
    text = "".join(map("%d,".__mod__, ids.tolist())).encode()
    digits = 2 + sum(ids >= 10**n for n in range(1, 10))
    at = np.concatenate([[0], np.cumsum(digits)])
    return [text[a:b] for a, b in zip(at[starts].tolist(), at[ends].tolist())]


class TokenBytes:
    """What each id stands for: the tables that decoding needs."""

    def __init__(self, ranks: dict[bytes, int]):
        table = byte_characters()
        # The byte table reversed, over the tokens as the library spells them.
        back = {character: byte for byte, character in enumerate(table)}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = bytes(map(back.__getitem__, map(table.__getitem__, token)))
        self.lengths = np.array(list(map(len, tokens)), dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return gathered(self.bytes, self.starts, self.lengths, ids).tobytes()

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character offsets ``[start, end)`` of each token in the text.

        A token that begins inside a character starts at it, and one that ends
        inside a character ends after it.
        """
        ends = np.cumsum(self.lengths[ids])
        raw = np.frombuffer(self.decode(ids), dtype=np.uint8)
        begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        inner = np.append((raw & 0xC0) == 0x80, False)
        starts = ends - self.lengths[ids]
        return begun[starts] - inner[starts], begun[ends]


def pieces_at_blanks(text: str) -> list[str]:
    return SAFE_CUT.split(text) if LOOSE_BLANK.search(text) else text.split(" ")


class ByteBpe(TokenBytes):
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        super().__init__(ranks)
        table = byte_characters()
        spell = lambda token: "".join(map(table.__getitem__, token))
        merges = [
            (spell(token[:cut]), spell(token[cut:]))
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        vocabulary = {spell(token): rank for token, rank in ranks.items()}
        self.library = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        # Pieces of now and of before: when the first table is full it becomes the second,
        # so what is used again stays.
        self.now, self.before = Pieces(), Pieces()

    def library_ids(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pieces, in any order, their ids, one after the other, and how many each has.

        But for marked ones, pieces are written with a blank before them. Many go through the library
        as one text: a blank between other characters always starts a new match, and the tokens' byte
        lengths show where each piece ends.
        """
        named, flat, lengths = [], [], []
        joined = [p for p in pieces if not p[0].isspace() and not p[-1].isspace()]
        single = [p for p in pieces if p[0].isspace() or p[-1].isspace()]
        chunks = [joined[a : a + TOGETHER] for a in range(0, len(joined), TOGETHER)]
        texts = [" " + " ".join(chunk) for chunk in chunks]
        for chunk, text, encoded in zip(chunks, texts, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoded.ids, dtype=np.int32)
            sizes = map(len, chunk) if text.isascii() else (len(p.encode()) for p in chunk)
            ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum(np.fromiter(sizes, np.int64, len(chunk)) + 1)
            at = np.searchsorted(ends, wanted)
            if (ends[at] == wanted).all():
                named += chunk
                flat.append(ids)
                lengths.append(np.diff(at, prepend=-1))
            else:
                single += chunk
        spelled = [p[1:] if p.startswith(" ") else " " + p for p in single]
        for start in range(0, len(single), 20_000):
            part = [e.ids for e in self.library.encode_batch_fast(spelled[start : start + 20_000], add_special_tokens=False)]
            flat += [np.array(ids, dtype=np.int32) for ids in part]
            lengths.append(np.array(list(map(len, part)), dtype=np.int64))
        none = np.zeros(0, dtype=np.int64)
        return named + single, np.concatenate([none.astype(np.int32), *flat]), np.concatenate([none, *lengths])

    def encode_batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        return (self.now.ids(places) for places in self.places_batch(texts))

    def places_batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The places in the table ``now`` of each text's pieces; a null text counts as empty."""
        cut = [pieces_at_blanks(text) if text else [] for text in texts]
        for pieces in cut:
            # A piece is kept without the blank before it; a first piece, which has none, is marked
            # with one, as no other piece begins with white space.
            if pieces:
                pieces[0] = " " + pieces[0]
        if len(self.now.places) > REMEMBERED or self.now.used > MOST_IDS:
            self.now, self.before = Pieces(), self.now
        unknown = set().union(*cut).difference(self.now.places)
        again = unknown.intersection(self.before.places)
        self.now.add(*self.before.taken(list(again)))
        self.now.add(*self.library_ids(list(unknown.difference(again))))
        place = self.now.places.__getitem__
        for pieces in cut:
            yield np.fromiter(map(place, pieces), np.int64, len(pieces))


class Pieces:
    """Known pieces and their ids, one after the other."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.decimals: list[bytes] = []
        self.used = 0
        self.flat, self.starts, self.lengths = (np.zeros(0, dtype=t) for t in (np.int32, np.int64, np.int64))

    def add(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray, decimals: list[bytes] | None = None) -> None:
        if not pieces:
            return
        count = len(self.places)
        self.places.update(zip(pieces, range(count, count + len(pieces))))
        own_ends = np.cumsum(lengths)
        self.decimals += spelled_out(ids, own_ends - lengths, own_ends) if decimals is None else decimals
        ends = self.used + own_ends
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(int(ends[-1]), dtype=np.int32)])
        self.flat[self.used : ends[-1]] = ids
        self.used = int(ends[-1])
        self.starts, self.lengths = np.concatenate([self.starts, ends - lengths]), np.concatenate([self.lengths, lengths])

    def taken(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, list[bytes]]:
        """What ``add`` of another table needs of known pieces."""
        places = np.fromiter(map(self.places.__getitem__, pieces), np.int64, len(pieces))
        return pieces, self.ids(places), self.lengths[places], list(map(self.decimals.__getitem__, places.tolist()))

    def ids(self, places: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.starts, self.lengths, places)

    def decimal(self, places: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        return b"".join(map(self.decimals.__getitem__, places.tolist()))[:-1]


@lru_cache(maxsize=2)
def token_bytes(path: str) -> TokenBytes:
    """The decoding tables, once per worker process."""
    return TokenBytes(read_ranks(path))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One coder per worker process; the file is read where the task runs."""
    return ByteBpe(path, pattern)


def pieces_of(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with bounded text, so that a batch of long texts is not cut into pieces at once."""
    start, held = 0, 0
    for i, size in enumerate(pa.compute.binary_length(column).fill_null(0).to_pylist()):
        if held and held + size > most_bytes:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(column):
        yield start, len(column)


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None, offsets: bool = True) -> DataFrame:
    """All columns of ``docs`` with ``ids`` and, if wanted, character offsets ``starts`` and ``ends``.

    A null or empty text has no ids. Rows are neither merged nor dropped. If
    ``docs`` has columns of the new names, they are replaced.
    """
    path, pattern = path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    names = ["ids", *(["starts", "ends"] if offsets else [])]
    kept = [name for name in docs.columns if name not in names]
    at = kept.index(text)
    source = docs.select(*(F.col(f"`{name}`") for name in kept))
    schema = extended(source.schema, ", ".join(f"{name} array<int>" for name in names))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for whole in parts:
            for a, b in pieces_of(whole.column(at)):
                batch = whole.slice(a, b - a)
                ids = list(own.encode_batch(batch.column(at).to_pylist()))
                lists = [ids]
                if offsets:
                    lists += list(zip(*map(own.offsets, ids))) or [[], []]
                arrays = [pa.array(x, pa.list_(pa.int32())) for x in lists]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*kept, *names])

    return through_arrow(source, run, schema)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """All columns of ``encoded`` with ``decoded``, the bytes of the ids; null ids count as none."""
    path = path or public_tokenizers.path(RANKS)
    kept = [name for name in encoded.columns if name != "decoded"]
    at = kept.index(ids)
    source = encoded.select(*(F.col(f"`{name}`") for name in kept))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = token_bytes(path)
        for batch in parts:
            column = batch.column(at)
            out = [own.decode(column[i].values.to_numpy().astype(np.int64)) if column[i].is_valid else b"" for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*kept, "decoded"])

    return through_arrow(source, run, extended(source.schema, "decoded binary"))


def round_trips(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """All columns of ``docs`` with ``ids``, ``n_tokens`` and ``round_trip``, whether decoding gives the text again.

    Texts are encoded and decoded in one pass. A null or empty text has no ids and comes
    back as the empty text. Rows are neither merged nor dropped, so repeated ones stay. A
    new column whose name is taken, whatever its case, gets underscores before its name.
    """
    path, pattern = path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    kept = docs.columns
    names = [free_name(kept, name) for name in ("ids", "n_tokens", "round_trip")]
    at = kept.index(text)
    schema = extended(docs.schema, ", ".join(f"`{n}` {t}" for n, t in zip(names, ("array<int>", "bigint", "boolean"))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for whole in parts:
            for a, b in pieces_of(whole.column(at)):
                batch = whole.slice(a, b - a)
                values = batch.column(at).to_pylist()
                ids = list(own.encode_batch(values))
                same = [own.decode(x) == (value or "").encode() for x, value in zip(ids, values)]
                more = [pa.array(ids, pa.list_(pa.int32())), pa.array(list(map(len, ids)), pa.int64()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*kept, *names])

    return through_arrow(docs, run, schema)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: texts encoded, decoded and digested in one pass.

    A null or empty text has no ids. Rows are neither merged nor dropped; other columns are not read.
    """
    path, pattern = path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for whole in parts:
            for a, b in pieces_of(whole.column(1)):
                batch = whole.slice(a, b - a)
                sizes, ids_digests, text_digests = [], [], []
                for places in own.places_batch(batch.column(1).to_pylist()):
                    ids = own.now.ids(places)
                    sizes.append(len(ids))
                    ids_digests.append(sha256(own.now.decimal(places)).hexdigest())
                    text_digests.append(sha256(own.decode(ids)).hexdigest())
                more = [pa.array(sizes, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *more], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = extended(source.select("doc_id").schema, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return source.mapInArrow(run, schema)
