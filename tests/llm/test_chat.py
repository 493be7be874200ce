import hashlib
import random

import pytest

from acervo.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\0\\1<s>[ROLE]x[/ROLE]", "", None, "a\nb", "é < [ \\", "word " * 40, "\U0001f600" * 5]


def conversations():
    rnd = random.Random(1)
    rows = []
    for conv in range(12):
        for turn in range(rnd.randrange(1, 30)):
            role = "system" if turn == 0 and conv % 2 else rnd.choice(["user", "assistant", "system", None, "to[ol"])
            text = rnd.choice(NASTY) if rnd.random() < 0.4 else " ".join(rnd.choices(["aa", "b", "cçc"], k=rnd.randrange(0, 60)))
            rows.append((conv, turn * rnd.choice([1, 3]) if conv != 3 else turn, role, text, "x"))
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", f"turn {t}", "x") for t in range(700)]
    rows += [(51, 0, "user", "twice", "x"), (51, 0, "user", "twice", "x"), (51, None, "assistant", "no number", "x"), (None, 1, "assistant", "no conversation", "x")]
    rows += [(52, 0, "system", "only", "x"), (53, 0, "assistant", "long " * 5000, "x"), (53, 1, "assistant", "short", "x")]
    return rows


def in_order(rows):
    out = {}
    for conv, turn, role, text, _ in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(t)] for c, t in out.items()}


@pytest.fixture(scope="module")
def formatted(spark):
    frame = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string, window string")
    return chat.windows(frame, budget=200, history=40).cache()


def test_texts_are_read_back(formatted):
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    chars = {}
    for r in formatted.collect():
        chars[r["conv_id"]] = chars.get(r["conv_id"], 0) + len(r["formatted"])
    turns = in_order(conversations())
    assert set(got) == set(turns)
    for conv, own in turns.items():
        told = "".join(f"{role}\n{text}\n" for role, text in own)
        target = "".join(text for role, text in own if role == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(own)
        assert row["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(target), hashlib.sha256(target.encode()).hexdigest())
        assert row["formatted_chars"] == chars[conv]


def cost(turn):
    return len(turn[1].split()) + chat.TURN_COST


def test_windows_keep_their_budget(formatted):
    """The windows by a plain walk over each conversation."""
    got = {}
    for r in formatted.collect():
        got.setdefault(r["conv_id"], []).append((r["window"], r["repeated"], r["own_turns"], r["formatted"]))
    unit, history = 80, 40
    show = lambda t: f"<s>[ROLE]{esc(t[0])}[/ROLE]{esc(t[1])}</s>"
    esc = lambda x: x.replace("\\", "\\0").replace("<", "\\1").replace("[", "\\2")
    for conv, turns in in_order(conversations()).items():
        lead = next((i for i, t in enumerate(turns) if t[0] != "system"), len(turns))
        before, spans = 0, {}
        for t in turns[lead:]:
            spans.setdefault(before // unit, []).append((before, t))
            before += cost(t)
        spans.setdefault(0, [])
        wanted, last = [], []
        for n, (window, own) in enumerate(sorted(spans.items())):
            again = [t for at, t in last if own and own[0][0] - at <= history]
            new = [t for _, t in own]
            repeated = len(again) + (lead if window else 0)
            text = "".join(map(show, [*turns[:lead], *again, *new]))
            wanted.append((window, repeated, len(new) + (0 if window else lead), text))
            last = own
            assert sum(map(cost, again + new)) <= 200 or any(cost(t) > unit for t in new)
        assert sorted(got[conv]) == wanted


def test_escapes_are_reversible(spark):
    rows = spark.createDataFrame([(x,) for x in NASTY if x is not None], "t string")
    from pyspark.sql import functions as F

    for r in rows.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert r["t"] == r["u"] and "<" not in r["e"] and "[" not in r["e"]


def test_no_python_on_the_path(formatted):
    plan = chat.read_back(formatted)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.windows(frame)).collect() == []
