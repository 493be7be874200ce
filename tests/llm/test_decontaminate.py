import random

import numpy as np

from acervo.llm import decontaminate as op


def table_edits(pattern, text):
    """Least edits between a pattern and any span, from the whole table."""
    last = list(range(len(pattern) + 1))
    best = last[-1]
    for word in text:
        row = [0]
        for i, own in enumerate(pattern):
            row.append(min(last[i] + (own != word), last[i + 1] + 1, row[i] + 1))
        last = row
        best = min(best, row[-1])
    return best


def test_least_edits_against_the_table():
    rnd = random.Random(1)
    for _ in range(1500):
        pattern = [rnd.randrange(4) for _ in range(rnd.randrange(1, 12))]
        text = [rnd.randrange(4) for _ in range(rnd.randrange(0, 25))]
        edits, a, b = op.least_edits(np.array(pattern), np.array(text, dtype=int))
        assert edits == table_edits(pattern, text)
        if edits < len(pattern):
            assert table_edits(pattern, text[a:b]) == edits


def words(rnd, n):
    return ["".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 7))) for _ in range(n)]


def edited(rnd, item, edits):
    out = [[w] for w in item]
    for at in rnd.sample(range(len(item)), edits):
        out[at] = rnd.choice([[], ["changed"], [item[at], "more"]])
    return [w for part in out for w in part]


def test_recall_at_the_largest_distance():
    rnd = random.Random(2)
    items = [words(rnd, n) for n in range(10, 90, 2)]
    block = op.Block([p for k, i in enumerate(items) for p in op.pieces_of(k, " ".join(i).encode())], op.MAX_EDIT, op.RECALL)
    texts, wanted = [], []
    for k, item in enumerate(items * 5):
        inside = edited(rnd, item, op.edits_allowed(len(item)))
        texts.append(" ".join(words(rnd, 40) + inside + words(rnd, 40)).encode())
        wanted.append(k % len(items))
    found = [{block.pieces[p][0] for p in row} for row in op.searched_texts(block, texts)]
    hit = sum(k in own for k, own in zip(wanted, found))
    assert hit >= 0.97 * len(wanted)
    assert all(own <= {k} for k, own in zip(wanted, found))


def rows(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["item_id"]) for r in df.collect())


def test_documents_of_all_kinds(spark):
    rnd = random.Random(3)
    item, other, long_item = " ".join(words(rnd, 20)), " ".join(words(rnd, 30)), " ".join(words(rnd, 250))
    text = " ".join(words(rnd, 50))
    docs = spark.createDataFrame(
        [
            (1, item, 0),
            (2, text + " " + item.upper().replace(" ", ", ") + " " + text, 0),
            (3, text, 0),
            (4, None, 0),
            (5, "", 0),
            (None, text + " " + other, 0),
            (6, " ".join(words(rnd, 30_000)) + " " + other, 0),
            (7, long_item, 0),
            (7, long_item, 0),
        ],
        "doc_id long, text string, item_id int",
    )
    benchmark = spark.createDataFrame([(10, item), (11, other), (12, None), (13, ""), (14, "two words"), (15, long_item), (16, item)], "item_id long, text string")
    assert rows(op.contaminated(docs, benchmark)) == sorted([(-1, 11), (1, 10), (1, 16), (2, 10), (2, 16), (6, 11)] + [(7, 15)] * 6)
    kept = op.without_benchmark(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rnd = random.Random(4)
    items = [" ".join(words(rnd, 25)) for _ in range(9)]
    docs = spark.createDataFrame([(i, " ".join(words(rnd, 20)) + " " + t) for i, t in enumerate(items)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    whole = rows(op.contaminated(docs, benchmark))
    monkeypatch.setattr(op, "BLOCK_ITEMS", 4)
    assert rows(op.contaminated(docs, benchmark)) == whole == [(i, i) for i in range(9)]


def least_distance(item, text):
    """Least number of word edits between an item and any run of a text's words."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[j - 1] + 1))
    return min(row)


def test_all_items_against_all_documents(spark):
    """Every pair within the limit by a plain distance is found, and no other is reported."""
    rnd = random.Random(8)
    items = [" ".join(words(rnd, n)) for n in (7, 7, 8, 9, 12, 20, 31, 60, 90, 5, 3)]
    items += [items[0], items[3]]
    docs = []
    for i in range(60):
        own = items[i % len(items)].split()
        for _ in range(rnd.randint(0, 1 + len(own) // 6)):
            own[rnd.randrange(len(own))] = rnd.choice(words(rnd, 1))
        docs.append((i, " ".join(words(rnd, rnd.randint(0, 40)) + own + words(rnd, rnd.randint(0, 40)))))
    bench = [(100 + k, text) for k, text in enumerate(items)]
    got = set(rows(op.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))))
    near = {
        (d, k) for d, text in docs for k, item in bench if least_distance(item.split(), text.split()) <= op.edits_allowed(len(item.split()))
    }
    assert got <= near and len(got) >= 0.97 * len(near) and any(k in (100, 111) for _, k in got)


def test_an_edit_in_an_item_of_seven_words(spark):
    docs = spark.createDataFrame([(1, "tell me what is the capital town of france please")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "what is the capital city of france"), (6, "the capital city of france")], "item_id long, text string")
    assert rows(op.contaminated(docs, bench)) == [(1, 5)]


def test_stretches_of_a_long_text_overlap():
    rnd = random.Random(5)
    tokens = [w.encode() for w in words(rnd, 60_000)]
    seen = {}
    for first, own in op.windows_of_text(b" ".join(tokens), 100_000):
        assert own == tokens[first : first + len(own)]
        seen.update(dict.fromkeys(range(first, first + len(own))))
    assert len(seen) == len(tokens)


def test_short_items_and_scripts_without_blanks(spark):
    rnd = random.Random(6)
    text = " ".join(words(rnd, 40))
    chinese = "长江发源于青藏高原的唐古拉山脉，流经十一个省区市后注入东海。"
    thai = "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"
    spaced = "one\u3000two three\u00a0four five six seven eight nine ten"
    rows_ = [
        (1, text + " What is the capital of France? " + text),
        (2, text + " what is the old capital of France " + text),
        (3, "前文很长" + chinese + "后文"),
        (4, thai + "ครับ"),
        (5, text + " " + spaced.replace("\u3000", " ").replace("\u00a0", "  ")),
        (6, "前文" + chinese.replace("十一", "十二") + "后文"),
        (7, "full text " + "东京" + text),
    ]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "What is the capital of France?"), (2, chinese), (3, thai), (4, spaced), (5, "东京")], "item_id long, text string")
    assert rows(op.contaminated(docs, benchmark)) == [(1, 1), (3, 2), (4, 3), (5, 4), (6, 2), (7, 5)]
    assert [r["doc_id"] for r in op.without_benchmark(docs, benchmark).collect()] == [2]


def test_stretches_of_texts_without_blanks_overlap():
    rnd = random.Random(7)
    for text in ("".join(rnd.choices("长江发源于青藏高原", k=60_000)), "\n".join(words(rnd, 40_000)), "\t".join(words(rnd, 40_000))):
        whole, last = op.tokens(text.encode()), None
        for first, own in op.windows_of_text(text.encode(), 60_000):
            assert own == whole[first : first + len(own)]
            assert last is None or last - first > 2 * op.PIECE
            last = first + len(own)
        assert last == len(whole)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id long, text string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert op.contaminated(some, benchmark).collect() == []
    assert op.contaminated(docs, full).collect() == []
    assert op.without_benchmark(some, benchmark).count() == 1
