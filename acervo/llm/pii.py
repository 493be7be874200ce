"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

A pattern finds e-mail addresses, telephone numbers, IPv4 addresses, dates,
social security numbers, payment cards and IBANs. A find that passes its
check (real date, octets up to 255, check digits) is replaced by another value
of the same format: its symbols, as numbers below their moduli, go through a
keyed Feistel network, each round adding a hash of one half to the other half.
That is a permutation of the format's values, so equal values get equal
pseudonyms in every document and different values different ones. Check digits
are computed anew. Cards and IBANs are also found beside other digits and
capitals. Finds that fail their check, and all other text, stay.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)"
LOCAL_PHONE = r"(?<![\w+.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
ISO_DATE = r"(?<![\w.-])\d{4}([-/])\d{2}\1\d{2}(?:(?![\w-])|(?=[Tt]\d{2}:?\d{2}))"  # a time may follow
DAY_DATE = r"(?<![\w.-])\d{1,2}([./-])\d{1,2}\2\d{4}(?![\w-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
# A run of digit groups that ends before other kinds of values; ``card`` looks for cards in it.
OTHERS = "|".join([r"\d{4}(?:-\d{2}-|/\d{2}/)\d{2}(?!\d|-)", r"\d{1,2}(?:\.\d{1,2}\.|/\d{1,2}/|-\d{1,2}-)\d{4}(?![\w-])", IPV4, SSN, LOCAL_PHONE, EMAIL])
GROUP = r"\d++(?!\w|-(?!\d))"
CARD = rf"(?<![\w.-])(?=\d(?:[ -]?\d){{12}}){GROUP}(?:(?:-| (?!{OTHERS})){GROUP})*+"
# Usual groups of a card's digits by their number, the likely ones first.
CARD_GROUPS = {
    4: r"\d{4}(?:[ -]\d{4}){3}",
    3: r"\d{4}[ -](?:\d{6}[ -]\d{4,5}|\d{4}[ -]\d{5})",
    2: r"\d{6}[ -](?:\d{10}|\d{13})|\d{8}[ -]\d{8}",
    1: r"\d{13,19}",
    5: r"\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}",
}
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
KNOWN_IBAN = "|".join(rf"(?:{codes.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
IBAN = rf"(?<!\w)(?=[A-Z]{{2}}\d{{2}})(?:(?:{KNOWN_IBAN})(?!\w)|[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{1,4}}){{3,8}}(?!\w))"
PATTERN = "|".join([EMAIL, PHONE, LOCAL_PHONE, IPV4, ISO_DATE, DAY_DATE, SSN, CARD, IBAN])

FIRST_DAY, DAYS = "1900-01-01", 73_049  # 1900 to 2099
DAY_MODULI = (319, 229)  # 319 * 229 = DAYS + 2; the two numbers beyond the last day are walked over
PHONE_MODULI = (800, 800, 10_000)  # area and exchange from 200 on, line
SSN_MODULI = (898, 99, 9_999)  # areas 001 to 899 but for 666, groups and serials from 1 on


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def digits(text: Column) -> Column:
    return chars(F.regexp_replace(text, r"\D", "")).cast("array<int>")


def spell(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), "")


def permuted(values: Column, moduli: Column, key: str, kind: str) -> Column:
    """The symbols after a keyed permutation of all arrays with these moduli."""

    def moved(own: Column, other: Column, number: Column) -> Column:
        def add(symbol: Column, at: Column) -> Column:
            told = F.concat_ws("|", F.lit(key), F.lit(kind), number, at, F.concat_ws(",", other["value"].cast("array<string>")))
            shift = F.conv(F.substring(F.sha2(told, 256), 1, 12), 16, 10).cast("long")
            return F.struct(((symbol["value"] + shift) % symbol["modulus"]).cast("int").alias("value"), symbol["modulus"].alias("modulus"))

        return F.transform(own, add)

    def run(symbols: Column) -> Column:
        half = F.floor(F.size(symbols) / 2).cast("int")
        start = F.struct(F.slice(symbols, F.lit(1), half).alias("own"), F.slice(symbols, half + 1, F.size(symbols) - half).alias("other"))
        # Each round changes one half by the other and swaps them; their number is even.
        step = lambda s, n: F.struct(s["other"].alias("own"), moved(s["own"], s["other"], n).alias("other"))
        rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(rounds, start, step, lambda s: F.concat(s["own"]["value"], s["other"]["value"]))

    return let(F.zip_with(values, moduli, lambda v, m: F.struct(v.cast("int").alias("value"), m.alias("modulus"))), run)


def same(values: Column, modulus: int) -> Column:
    return F.transform(values, lambda _: F.lit(modulus))


def permuted_alike(values: Column, modulus: int, key: str, kind: str) -> Column:
    return let(values, lambda v: permuted(v, same(v, modulus), key, kind))


def fixed(moduli: tuple[int, ...]) -> Column:
    return F.array(*(F.lit(m) for m in moduli))


def fill(form: Column, symbols: Column, place: str) -> Column:
    """``form`` with the characters that match the class ``place`` replaced by ``symbols`` in turn."""

    def filled(both: Column) -> Column:
        def step(state: Column, c: Column) -> Column:
            hit = c.rlike(f"[{place}]")
            own = F.when(hit, F.element_at(both["symbols"], state["at"])).otherwise(c)
            return F.struct((state["at"] + F.when(hit, 1).otherwise(0)).alias("at"), F.concat(state["text"], own).alias("text"))

        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))
        return F.aggregate(chars(both["form"]), start, step, lambda s: s["text"])

    return let(F.struct(form.alias("form"), symbols.cast("array<string>").alias("symbols")), filled)


def email(found: Column, key: str) -> Column:
    """Letters of the local part among letters of their case, digits among digits; the domain stays."""

    def local_part(local: Column) -> Column:
        numbers = F.transform(chars(F.regexp_replace(F.lower(local), "[^a-z]", "")), lambda c: F.ascii(c) - 97)
        letters = F.transform(permuted_alike(numbers, 26, key, "letters"), lambda n: F.char(n.cast("long") + 97))
        plain = fill(fill(F.lower(local), letters, "a-z"), permuted_alike(digits(local), 10, key, "digits"), "0-9")
        cased = F.zip_with(chars(local), chars(plain), lambda old, new: F.when(old.rlike("[A-Z]"), F.upper(new)).otherwise(new))
        return F.array_join(cased, "")

    domain = F.substring(found, F.instr(found, "@"), F.length(found))
    return F.concat(let(F.substring_index(found, "@", 1), local_part), domain)


def phone(found: Column, key: str) -> Column:
    """The country code stays. North American numbers stay such; others keep their number of digits."""
    code = F.regexp_extract(found, r"^\+\d{1,3}(?=\D)", 0)
    home = code.isin("+1", "")

    def subscriber(own: Column) -> Column:
        number = lambda a, n: spell(F.slice(own, a, n)).cast("int")
        american = home & (F.size(own) == 10) & (number(1, 3) >= 200) & (number(4, 3) >= 200)
        moved = let(
            permuted(F.array(number(1, 3) - 200, number(4, 3) - 200, number(7, 4)), fixed(PHONE_MODULI), key, "american"),
            lambda n: chars(F.concat((n[0] + 200).cast("string"), (n[1] + 200).cast("string"), F.lpad(n[2].cast("string"), 4, "0"))),
        )
        # What is no such number must not become one: the digits that make it none stay.
        fixed_digits = F.when(home & (F.size(own) == 10), F.when(number(1, 3) < 200, 1).otherwise(4)).otherwise(0)
        other = let(
            fixed_digits,
            lambda n: F.concat(F.slice(own, F.lit(1), n), permuted_alike(F.slice(own, n + 1, F.size(own)), 10, key, "phone")),
        )
        return F.when(american, moved).otherwise(other.cast("array<string>"))

    rest = F.substring(found, F.length(code) + 1, F.length(found))
    return F.concat(code, let(rest, lambda r: fill(r, let(digits(r), subscriber), "0-9")))


def ipv4(found: Column, key: str) -> Column:
    def moved(own: Column) -> Column:
        new = F.array_join(permuted_alike(own, 256, key, "ipv4").cast("array<string>"), ".")
        return F.when(F.forall(own, lambda n: n <= 255), new).otherwise(found)

    return let(F.split(found, r"\.").cast("array<int>"), moved)


def moved_day(day: Column, key: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")

    def step(n: Column) -> Column:
        pair = F.array(F.floor(n / DAY_MODULI[1]).cast("int"), (n % DAY_MODULI[1]).cast("int"))
        return let(permuted(pair, fixed(DAY_MODULI), key, "day"), lambda p: p[0] * DAY_MODULI[1] + p[1])

    # A cycle of the permutation can pass both numbers that are no day before it comes to one.
    beyond = range(math.prod(DAY_MODULI) - DAYS)
    walked = F.aggregate(F.array(*map(F.lit, beyond)), step(F.date_diff(day, first)), lambda n, _: F.when(n < DAYS, n).otherwise(step(n)))
    return F.date_add(first, walked)


def in_range(day: Column) -> Column:
    return F.coalesce(F.year(day).between(1900, 2099), F.lit(False))


def made_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if there is none."""
    return F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def iso_date(found: Column, key: str) -> Column:
    mark = F.substring(found, 5, 1)

    def moved(day: Column) -> Column:
        return F.when(in_range(day), F.replace(moved_day(day, key).cast("string"), F.lit("-"), mark)).otherwise(found)

    return let(made_date(F.substring(found, 1, 4), F.substring(found, 6, 2), F.substring(found, 9, 2)), moved)


def day_date(found: Column, key: str) -> Column:
    """Day or month first: the order that gives a date, day first where both do; two digits each in ten characters."""
    mark = F.regexp_extract(found, r"[./-]", 0)

    def told(day_first: bool, day: Column) -> Column:
        def written(new: Column) -> Column:
            parts = [F.dayofmonth(new).cast("string"), F.month(new).cast("string")]
            parts = [F.when(F.length(found) == 10, F.lpad(part, 2, "0")).otherwise(part) for part in parts]
            first, second = parts if day_first else parts[::-1]
            return F.concat(first, mark, second, mark, F.year(new).cast("string"))

        return let(moved_day(day, key), written)

    def moved(parts: Column) -> Column:
        first, second = made_date(parts[2], parts[1], parts[0]), made_date(parts[2], parts[0], parts[1])
        return F.when(in_range(first), told(True, first)).when(in_range(second), told(False, second)).otherwise(found)

    return let(F.split(found, r"[./-]"), moved)


def ssn(found: Column, key: str) -> Column:
    def moved(parts: Column) -> Column:
        area, group, serial = parts[0], parts[1], parts[2]
        valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
        place = area - F.when(area > 666, 2).otherwise(1)
        new = let(
            permuted(F.array(place, group - 1, serial - 1), fixed(SSN_MODULI), key, "ssn"),
            lambda n: F.concat_ws(
                "-",
                F.lpad((n[0] + F.when(n[0] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                F.lpad((n[1] + 1).cast("string"), 2, "0"),
                F.lpad((n[2] + 1).cast("string"), 4, "0"),
            ),
        )
        return F.when(valid, new).otherwise(found)

    return let(F.split(found, "-").cast("array<int>"), moved)


def luhn(values: Column) -> Column:
    """The Luhn sum of digits with their check digit, modulo 10."""
    weighed = F.transform(F.reverse(values), lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10


def card_number(found: Column, key: str) -> Column:
    """All digits but the check digit move; that is computed anew."""

    def moved(own: Column) -> Column:
        new = let(
            permuted_alike(F.slice(own, F.lit(1), F.size(own) - 1), 10, key, "card"),
            lambda n: F.concat(n, F.array((10 - luhn(F.concat(n, F.array(F.lit(0))))) % 10)),
        )
        return fill(found, new, "0-9")

    return let(digits(found), moved)


def card(found: Column, key: str) -> Column:
    """Card numbers in usual groups anywhere in the run of digits, or else the run as a whole; other numbers beside them stay."""

    def groups_from(parts: Column, at: Column) -> Column:
        """How many groups from one on are a card that passes its check, or 0."""
        held = F.lit(0)
        for n, form in reversed(CARD_GROUPS.items()):
            own = F.array_join(F.slice(parts, at + 1, F.lit(n)), "")
            held = F.when(own.rlike(f"^[ -]?(?:{form})$") & let(own, lambda x: luhn(digits(x)) == 0), n).otherwise(held)
        return held

    def mark(state: Column, groups: Column) -> Column:
        own = F.when(state["left"] > 0, -1).otherwise(groups)
        left = F.when(state["left"] > 0, state["left"] - 1).when(groups > 0, groups - 1).otherwise(0)
        return F.struct(left.cast("int").alias("left"), F.concat(state["marks"], F.array(own.cast("int"))).alias("marks"))

    def written(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("left"), F.array().cast("array<int>").alias("marks"))
        marks = F.aggregate(F.transform(parts, lambda _, i: groups_from(parts, i)), start, mark, lambda state: state["marks"])

        def pieces(marks: Column) -> Column:
            # Of (text, whether it is a card): each card as one, a card's later groups as nothing.
            one = lambda p, i: let(
                F.element_at(marks, i + 1),
                lambda m: F.struct(
                    F.when(m < 0, "").when(m == 0, p).otherwise(F.array_join(F.slice(parts, i + 1, F.greatest(m, F.lit(1))), "")).alias("text"), (m > 0).alias("card")
                ),
            )
            whole = let(digits(found), lambda own: F.size(own).between(13, 19) & (luhn(own) == 0))
            alone = F.array(F.struct(found.alias("text"), whole.alias("card")))
            return F.when(F.exists(marks, lambda m: m > 0), F.transform(parts, one)).otherwise(alone)

        return F.array_join(F.transform(let(marks, pieces), lambda x: F.when(x["card"], card_number(x["text"], key)).otherwise(x["text"])), "")

    return let(F.regexp_extract_all(found, F.lit(r"[ -]?\d+"), F.lit(0)), written)


def mod97(text: Column) -> Column:
    """Remainder of an IBAN's characters, moved and spelled as numbers, without blanks."""
    turned = let(text, lambda t: F.concat(F.substring(t, F.lit(5), F.length(t)), F.substring(t, 1, 4)))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    values = F.transform(chars(turned), value)
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def iban(found: Column, key: str) -> Column:
    """Digits of the account part among digits, with new check digits; letters stay.

    The longest start of the find, up to a blank or its end, that passes the check is
    the IBAN. Cards are looked for in what is behind it, or in all if there is none.
    """

    def moved(own: Column) -> Column:
        def renewed(plain: Column) -> Column:
            body = F.substring(plain, F.lit(5), F.length(plain))
            new = let(
                let(body, lambda b: fill(b, permuted_alike(digits(b), 10, key, "iban"), "0-9")),
                lambda b: let(
                    F.substring(plain, 1, 2),
                    lambda head: F.concat(head, F.lpad((98 - mod97(F.concat(head, F.lit("00"), b))).cast("string"), 2, "0"), b),
                ),
            )
            return fill(own, chars(new), "A-Z0-9")

        return F.when(own == "", "").otherwise(let(F.replace(own, F.lit(" "), F.lit("")), renewed))

    def valid(start: Column) -> Column:
        return let(F.replace(start, F.lit(" "), F.lit("")), lambda plain: F.length(plain).between(15, 34) & (mod97(plain) == 1))

    def written(own: Column) -> Column:
        rest = F.substring(found, F.length(own) + 1, F.length(found))
        return F.concat(moved(own), let(rest, lambda r: with_cards(r, key)))

    words = F.split(found, " ")
    starts = F.transform(words, lambda _, i: F.array_join(F.slice(words, F.lit(1), F.size(words) - i), " "))
    return let(F.coalesce(F.get(F.filter(starts, valid), F.lit(0)), F.lit("")), written)


def with_cards(text: Column, key: str) -> Column:
    found, gaps = F.regexp_extract_all(text, F.lit(CARD), F.lit(0)), F.split(text, CARD, -1)
    new = F.zip_with(gaps, F.transform(found, lambda x: card(x, key)), lambda gap, own: F.concat(gap, F.coalesce(own, F.lit(""))))
    return F.when(text.rlike(CARD), F.array_join(new, "")).otherwise(text)


KINDS: list[tuple[str, Callable[[Column, str], Column]]] = [
    (EMAIL, email),
    (IPV4, ipv4),
    (ISO_DATE, iso_date),
    (DAY_DATE.replace(r"\2", r"\1"), day_date),
    (SSN, ssn),
    (PHONE, phone),
    (LOCAL_PHONE, phone),
    (CARD, card),
    (IBAN, iban),
]


def replacement(found: Column, key: str) -> Column:
    out = None
    for pattern, change in KINDS:
        is_kind = found.rlike(f"^(?:{pattern})$")
        out = F.when(is_kind, change(found, key)) if out is None else out.when(is_kind, change(found, key))
    return out.otherwise(found)


def pseudonymised(text: Column, key: str) -> Column:
    """The text with pseudonyms for its personal data; null stays null."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    gaps = F.split(text, PATTERN, -1)
    new = F.zip_with(gaps, F.transform(found, lambda x: replacement(x, key)), lambda gap, own: F.concat(gap, F.coalesce(own, F.lit(""))))
    return F.when(text.rlike(PATTERN), F.array_join(new, "")).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` pseudonymised under ``key``; all rows and other columns stay as they are.

    Null and empty texts stay. Repeated rows get repeated results.
    """
    return docs.select(*(pseudonymised(F.col(f"`{name}`"), key).alias(name) if name == text else F.col(f"`{name}`") for name in docs.columns))
