import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from acervo.llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.RANKS)
ODD = [
    "a  b", " a", "a ", "\n\n x", "x\u00a0y z", "it's we'll I'd'd", "é" * 50, "\U0001f600\U0001f468\u200d\U0001f469", "123 4567", "a\x1c b \x85c",
    "<|endoftext|> hi", "   ", "\t", "!!! ???", "end.\n Next", "'s 't", "ß\u0301 \u0301", "\u2028 x", "a" * 3000, "aaa " * 300, "\x00 \x7f", "a \x00b \x00", " \x00a b", "ÀÉ œuvre",
]


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples():
    rnd = random.Random(1)
    alphabet = "ab eé\n'sll!?  12\u00a0\U0001f600ñß.,"
    return ODD + ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 120))) for _ in range(600)]


def test_same_ids_as_the_other_library(known):
    coder = byte_bpe.coder(PATH, public_tokenizers.PATTERN)
    for _ in range(2):  # new pieces first, remembered ones then
        for text, ids in zip(samples(), coder.encode_batch(samples())):
            assert ids.tolist() == known.encode_ordinary(text)
            assert coder.decode(ids) == text.encode()


def test_offsets_cover_split_characters():
    coder = byte_bpe.coder(PATH, public_tokenizers.PATTERN)
    for text, ids in zip(samples(), coder.encode_batch(samples())):
        starts, ends = coder.offsets(ids)
        raw, at = text.encode(), 0
        for token, a, b in zip(ids, starts, ends):
            own = coder.bytes[coder.starts[token] : coder.starts[token] + coder.lengths[token]].tobytes()
            assert own in text[a:b].encode() and raw[at : at + len(own)] == own
            at += len(own)
        assert at == len(raw)


def test_memory_stays_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    coder = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    for start in range(0, 600, 100):
        texts = samples()[start : start + 100]
        assert [coder.decode(ids).decode() for ids in coder.encode_batch(texts)] == texts
        assert len(coder.before.places) <= 50 + len({p for t in texts for p in t.split(" ")}) * 2


def test_many_unknown_pieces_at_once(known):
    """Unknown pieces that go through the library together, and those that cannot."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefgh'é1\n.", k=rnd.randrange(1, 9)))
    texts = [" ".join(word() for _ in range(900)) for _ in range(20)] + [" x  y \n z " + word(), "\n" + word() + " ", " "]
    coder = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    for text, ids in zip(texts, coder.encode_batch(texts)):
        assert ids.tolist() == known.encode_ordinary(text)


def test_rows_of_all_kinds(spark, known):
    rows = [(i, t, "x") for i, t in enumerate(samples())] + [(None, None, None), (7, "", "x"), (7, "", "x"), (8, "word " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    encoded = byte_bpe.encode(docs)
    assert encoded.columns == ["doc_id", "text", "decoded", "ids", "starts", "ends"]
    got = sorted(map(str, map(tuple, byte_bpe.digests(docs).collect())))
    wanted = []
    for i, t, _ in rows:
        ids = known.encode_ordinary(t or "")
        told = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((i, len(ids), told, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(map(str, wanted))


def test_any_ids_decode(spark):
    frame = spark.createDataFrame([([0, 255, 300],), (None,), ([],)], "ids array<int>")
    rows = byte_bpe.decode(frame).collect()
    coder = byte_bpe.coder(PATH, public_tokenizers.PATTERN)
    assert [bytes(r["decoded"]) for r in rows] == [coder.decode(np.array([0, 255, 300])), b"", b""]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digests(docs).collect() == [] and byte_bpe.encode(docs).collect() == [] and byte_bpe.round_trips(docs).collect() == []


def test_round_trips_beside_columns_of_the_new_names(spark):
    docs = spark.createDataFrame([(1, "a b", [9], 5, "x"), (2, None, None, None, None)], "doc_id long, text string, ids array<int>, N_TOKENS int, `a.b` string")
    out = byte_bpe.round_trips(docs)
    assert out.columns == [*docs.columns, "_ids", "_n_tokens", "round_trip"]
    assert [tuple(r)[2:5] for r in out.orderBy("doc_id").collect()] == [([9], 5, "x"), (None, None, None)]
    assert [r["round_trip"] for r in out.collect()] == [True, True]


def test_known_pieces_move_together(monkeypatch, known):
    """Pieces of the older table are taken over in one step, and their ids and decimals stay theirs."""
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    coder = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    texts = [" ".join(f"w{i}é{k}" for i in range(40)) for k in range(5)]
    calls = []
    gathered = byte_bpe.gathered
    for turn in range(3):
        monkeypatch.setattr(byte_bpe, "gathered", lambda *args: calls.append(turn) or gathered(*args))
        places = list(coder.places_batch([*texts, "", None]))
        monkeypatch.setattr(byte_bpe, "gathered", gathered)
        for text, own in zip([*texts, "", ""], places):
            ids = known.encode_ordinary(text)
            assert coder.now.ids(own).tolist() == ids and coder.now.decimal(own).decode() == ",".join(map(str, ids))
    assert coder.before.places and len(calls) <= 3
