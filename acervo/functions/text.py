"""Text normalisation: columns in, columns out, all evaluated in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from itertools import filterfalse
from pathlib import Path

from pyspark.sql import Column, functions as F

# Separator characters, deleted punctuation, Unicode whitespace.
SPLIT_SYMBOLS = "\n\t\r"
PUNCTUATION = "<>¿?,;:.()[]\"'¡!"
WHITESPACE = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = "[" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "]+"
SNIPPET_LENGTH = 120
DEFAULT_LANGUAGE = "spanish"


@lru_cache(maxsize=None)
def stopwords(language: str = DEFAULT_LANGUAGE) -> tuple[str, ...]:
    """The stop list for ``language``: Spanish from this package, others as Spark ships them."""
    if language == DEFAULT_LANGUAGE:
        lines = Path(__file__).with_name("spanish_stop_words.txt").read_text(encoding="utf-8").splitlines()
        return tuple(line for line in lines if not line.startswith("#"))
    from pyspark.ml.feature import StopWordsRemover  # needs a running JVM

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def spaces_for_split_symbols(text: Column) -> Column:
    return F.translate(text, SPLIT_SYMBOLS, " " * len(SPLIT_SYMBOLS))


def without_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def single_spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WHITESPACE_RUN), lambda w: w != "")


# The expressions below are written as SQL text: a stop list of hundreds of
# literals built through the Column API costs a driver call per literal.


def _quoted(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


def _not_stopped(word: str, stop: Sequence[str] | None) -> str:
    stop = stopwords() if stop is None else stop
    if not stop:
        return "true"
    return f"{word} NOT IN ({', '.join(_quoted(w) for w in stop)})"


def without_stopwords_sql(tokens: str, stop: Sequence[str] | None = None) -> str:
    return f"filter({tokens}, w -> {_not_stopped('w', stop)})"


def index_tokens_sql(text: str, stop: Sequence[str] | None = None) -> str:
    """All five steps in one scan of the characters.

    One ``translate`` maps every whitespace character to a space and deletes
    the punctuation, so the split needs no regular expression.
    """
    spaced = (
        f"translate({text}, {_quoted(WHITESPACE + PUNCTUATION)}, {_quoted(' ' * len(WHITESPACE))})"
    )
    return f"filter(split(lower({spaced}), ' '), w -> w <> '' AND {_not_stopped('w', stop)})"


_assigned: set[str] = set()  # characters that were looked up before


def all_assigned(text: str) -> bool:
    """Whether Python's tables have all characters of the text."""
    if text.isascii():
        return True
    new = set(text).difference(_assigned)
    if any(unicodedata.category(c) == "Cn" for c in new):
        return False
    _assigned.update(new)
    return True


def clean_words(text: str, stop: frozenset[str]) -> list[str]:
    """The tokens of ``index_tokens`` of one text.

    Python's ``split`` without an argument cuts at the characters of ``WHITESPACE``. No rule for
    lower case looks beyond a space, so it does not matter that this comes before the split.
    """
    for mark in PUNCTUATION:
        text = text.replace(mark, "")
    return list(filterfalse(stop.__contains__, text.lower().split()))


def clean_text(text: str, stop: frozenset[str]) -> str:
    """The tokens joined by single spaces."""
    return " ".join(clean_words(text, stop))


def term_counts_sql(tokens: str) -> str:
    """``array<struct<term, tf>>`` of one document, without a shuffle.

    A document is one row, so its counts are run lengths of its own sorted
    tokens; grouping the exploded tokens would move every posting through an
    exchange only to find all of them in the task they came from.

    Intermediate arrays are bound as lambda variables: the optimizer may merge
    projections and copy an expression into a lambda, where it would run again
    for every element.
    """
    starts = (
        "filter(if(size(s) > 0, sequence(0, size(s) - 1), cast(array() as array<int>)), "
        "i -> i = 0 OR get(s, i) <> get(s, i - 1))"
    )
    runs = (
        "transform(b, (p, j) -> named_struct('term', get(s, p), "
        "'tf', cast(coalesce(get(b, j + 1), size(s)) - p as bigint)))"
    )
    with_starts = f"get(transform(array({starts}), b -> {runs}), 0)"
    return f"get(transform(array(sort_array({tokens})), s -> {with_starts}), 0)"


def norm_sql(counts: str) -> str:
    """Square root of the summed squared frequencies; 0.0 without tokens."""
    total = f"aggregate({counts}, 0L, (acc, c) -> acc + c.tf * c.tf)"
    return f"sqrt(cast({total} as double))"


def without_stopwords(tokens: str, stop: Sequence[str] | None = None) -> Column:
    return F.expr(without_stopwords_sql(tokens, stop))


def index_tokens(text: str, stop: Sequence[str] | None = None) -> Column:
    return F.expr(index_tokens_sql(text, stop))


def term_counts(tokens: str) -> Column:
    return F.expr(term_counts_sql(tokens))


def norm(tokens: str) -> Column:
    return F.expr(norm_sql(term_counts_sql(tokens)))


def joined(tokens: str) -> Column:
    return F.array_join(tokens, " ")


def snippet(text: Column) -> Column:
    return F.concat(F.substring(text, 1, SNIPPET_LENGTH), F.lit("..."))
