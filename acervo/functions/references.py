"""Character references in attribute values, decoded in the JVM."""

from __future__ import annotations

import html

from pyspark.sql import Column, functions as F

# What a reference to no character gives, and the numbers that
# browsers read as windows-1252.
NO_CHARACTER = "�"
C1_NUMBERS = range(0x80, 0xA0)
# Up to twelve digits and no more are read as the number; what follows them only counts as too large.
NUMBER = r"^#(?:[xX]0*+([0-9A-Fa-f]{0,12})[0-9A-Fa-f]*+|0*+([0-9]{0,12})[0-9]*+);?"


def _lookup(pairs: dict[str, str]) -> Column:
    """A constant map; no key and no value has a blank in it."""
    return F.map_from_arrays(F.split(F.lit(" ".join(pairs)), " "), F.split(F.lit(" ".join(pairs.values())), " "))


def _odd_numbers() -> dict[str, str]:
    """Characters of the numbers that do not stand for themselves."""
    found = {"0": NO_CHARACTER}
    for n in C1_NUMBERS:
        character = bytes([n]).decode("cp1252", errors="ignore")
        if character:
            found[str(n)] = character
    return found


def _bound(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _character(number: Column) -> Column:
    own = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    plain = F.when(valid, own).otherwise(F.lit(NO_CHARACTER))
    return F.coalesce(F.try_element_at(_lookup(_odd_numbers()), number.cast("string")), plain)


def _after_ampersand(piece: Column) -> Column:
    hexadecimal, decimal = F.regexp_extract(piece, NUMBER, 1), F.regexp_extract(piece, NUMBER, 2)
    is_hex = piece.rlike("^#[xX]")
    digits = F.when(is_hex, F.conv(hexadecimal, 16, 10)).otherwise(decimal)
    number = F.coalesce(F.when(digits != "", digits).try_cast("bigint"), F.lit(0).cast("bigint"))
    rest = F.substring(piece, F.length(F.regexp_extract(piece, NUMBER, 0)) + 1, F.length(piece))
    numeric = F.concat(_bound(number, _character), rest)

    def named(name: Column) -> Column:
        after = F.substring(piece, F.length(name) + 1, F.length(piece))
        counts = F.endswith(name, F.lit(";")) | ~F.startswith(after, F.lit("="))
        return F.concat(F.when(counts, F.try_element_at(_lookup(html.entities.html5), name)), after)

    by_name = _bound(F.regexp_extract(piece, "^[A-Za-z0-9]+;?", 0), named)
    is_number = piece.rlike("^#(?:[0-9]|[xX][0-9A-Fa-f])")
    return F.when(is_number, numeric).otherwise(F.coalesce(by_name, F.concat(F.lit("&"), piece)))


def decoded(value: Column) -> Column:
    """An attribute value with its character references replaced.

    A name is the whole run of letters and digits after the ampersand. One without a
    semicolon counts only if it is among the old names and no equals sign follows, so
    that the parameters of a URL stay. Numbers may lack the semicolon; a number of no
    character gives the replacement character. Each reference is decoded once, in one
    pass over the pieces between ampersands.
    """
    pieces = F.transform(F.split(value, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(_after_ampersand(p)))
    return F.when(F.contains(value, F.lit("&")), F.array_join(pieces, "")).otherwise(value)
