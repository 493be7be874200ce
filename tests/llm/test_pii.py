import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from acervo.llm import pii

KEY = "k"


def luhn(number):
    own = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(own)) % 10


def mod97(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def changed(spark, texts, key=KEY):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["text"] for r in pii.pseudonymise(frame, key).orderBy("i").collect()]


def shape(text):
    return re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "9", text)))


VALUES = {
    "email": ["bosbt.42@mail8.example.com", "A.b-C+9@x.org", "x@y.zz", "1@y.zz"],
    "phone": ["+1 (988) 555-2485", "+1 (456) 555-2186", "+44 20 7946 0958", "(415) 555-0100", "212-555-0199", "+1 (056) 555-2186", "+1 (456) 055-2186"],
    "ipv4": ["42.144.35.254", "0.0.0.0", "255.255.255.255"],
    "date": ["1999-12-31", "2024/02/29", "01.02.2003", "31/12/1999", "12/31/1999", "1.2.2003"],
    "ssn": ["123-45-6789", "899-99-9999", "001-01-0001"],
    "card": ["4041894974608795", "4111 1111 1111 1111", "3782-822463-10005"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
}
STAY = [
    "300.1.2.3", "1.2.3.4.5", "2023-02-30", "31.02.2003", "666-12-3456", "000-12-3456", "123-00-4567", "4041894974608796", "12345", "version 1.2.3",
    "DE89370400440532013001", "a@b", "plain words, no data", "1999-12-3", "4.0.", "password=e3b3ed3cc8548923d6", "", None,
]


def test_formats_stay_and_values_move(spark):
    flat = [v for own in VALUES.values() for v in own]
    out = changed(spark, flat)
    moved = dict(zip(flat, out))
    for old, new in moved.items():
        if "@" in old:
            assert shape(old) == shape(new) and old.split("@")[1] == new.split("@")[1]
        elif old not in VALUES["ipv4"] and old != "1.2.2003":
            assert shape(old) == shape(new)
    assert sum(a == b for a, b in moved.items()) == 0
    assert all(luhn(moved[c]) == 0 for c in VALUES["card"])
    assert all(mod97(moved[i]) == 1 for i in VALUES["iban"])
    assert all(all(0 <= int(x) <= 255 for x in moved[i].split(".")) for i in VALUES["ipv4"])
    for d in VALUES["date"]:
        parts = [int(x) for x in re.split(r"[./-]", moved[d])]
        year = parts[0] if parts[0] > 31 else parts[2]
        assert 1900 <= year <= 2099
    datetime.date.fromisoformat(moved["1999-12-31"])
    for n in VALUES["ssn"]:
        a, g, s = map(int, moved[n].split("-"))
        assert 1 <= a <= 899 and a != 666 and g >= 1 and s >= 1
    assert moved["+1 (988) 555-2485"].startswith("+1 (") and moved["+44 20 7946 0958"].startswith("+44 ")


def test_unchecked_values_and_other_text_stay(spark):
    assert changed(spark, STAY) == STAY


def test_equal_values_are_linked_across_texts(spark):
    rnd = random.Random(1)
    flat = [v for own in VALUES.values() for v in own]
    alone = dict(zip(flat, changed(spark, flat)))
    texts, wanted = [], []
    for _ in range(60):
        own = rnd.choices(flat, k=rnd.randrange(1, 5))
        frame = [rnd.choice(["Call ", "x, ", "né ", "(see) ", "\n", "end: "]) for _ in own]
        texts.append("".join(a + v + " " for a, v in zip(frame, own)))
        wanted.append("".join(a + alone[v] + " " for a, v in zip(frame, own)))
    assert changed(spark, texts) == wanted
    assert changed(spark, flat, "other key") != changed(spark, flat)


BESIDE = [
    ("{}", "4111 1111 1111 1111", " 12/27"), ("{}", "4111 1111 1111 1111", " 123"), ("order 77 {}", "4111 1111 1111 1111", ""), ("no 77123 {}", "4111 1111 1111 1111", " 12 345"),
    ("77-12 {}", "3782 822463 10005", " 1234"), ("id 5512 {}", "4041894974608795", " 987"), ("{}", "DE89370400440532013000", " BIC X"), ("{}", "GB82 WEST 1234 5698 7654 32", " OR CALL 12"),
    ("XX12 ABCD {}", "4111 1111 1111 1111", ""), ("at {}", "2024-05-01", "T12:00:00Z"), ("{}", "4111 1111 1111 1111", " x2"), ("4 {}", "2024-05-01", "T12:00 and 123456789"),
]


def test_values_beside_digits_and_capitals(spark):
    values = [v for _, v, _ in BESIDE]
    alone = changed(spark, values)
    assert not set(values) & set(alone)
    out = changed(spark, [a.format(v) + b for a, v, b in BESIDE])
    assert out == [a.format(v) + b for (a, _, b), v in zip(BESIDE, alone)]


def test_several_values_in_a_run(spark):
    card, other, iban, day = "4111 1111 1111 1111", "3782-822463-10005", "DE89370400440532013000", "2024-05-01"
    new = dict(zip([card, other, iban, day], changed(spark, [card, other, iban, day])))
    form = "{} 12 {} 7 {} 31 {} {}"
    own = (card, other, card, day, card)
    assert changed(spark, [form.format(*own), iban + " " + card]) == [form.format(*(new[v] for v in own)), new[iban] + " " + new[card]]
    numbers = "4041894974608796 12 and " + "12 " * 3000 + "9" * 40
    assert changed(spark, [numbers]) == [numbers]


@pytest.mark.parametrize("kind,moduli", [("a", (3, 4)), ("b", (2, 2, 5)), ("c", (7,))])
def test_network_is_a_permutation(spark, kind, moduli):
    space = 1
    for m in moduli:
        space *= m
    rows = spark.range(space)
    rest, symbols = F.col("id"), []
    for m in moduli:
        symbols.append((rest % m).cast("int"))
        rest = F.floor(rest / m)
    out = rows.select(pii.permuted(F.array(*symbols), pii.fixed(moduli), KEY, kind).alias("v")).collect()
    values = {tuple(r["v"]) for r in out}
    assert len(values) == space and all(0 <= v < m for own in values for v, m in zip(own, moduli))


def test_every_date_of_two_centuries_has_one_pseudonym_among_them(spark):
    days = spark.range(73_049).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"))
    for key in (KEY, "public test key"):
        out = pii.pseudonymise(days, key).agg(F.countDistinct("text"), F.min("text"), F.max("text"), F.count("text")).first()
        assert tuple(out) == (73_049, "1900-01-01", "2099-12-31", 73_049)


def test_columns_and_long_texts(spark):
    long = "word " * 60_000 + VALUES["email"][0] + " " + "x" * 200_000 + " " + "9" * 50_000
    rows = [(1, long, "found"), (1, long, "found"), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = pii.pseudonymise(frame, KEY)
    assert out.columns == frame.columns and out.count() == 3
    assert VALUES["email"][0] not in out.filter("doc_id = 1").first()["text"]
    assert pii.pseudonymise(frame.filter("false"), KEY).collect() == []


def test_no_python_on_the_path(spark):
    plan = pii.pseudonymise(spark.createDataFrame([(1, "a")], "doc_id long, text string"), KEY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
