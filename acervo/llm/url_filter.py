"""Allow and block rules for URLs in a trie over reversed host labels and path segments.

A rule's host is walked from its last label to its first; the node reached
holds a second trie over the rule's whole path segments, and there the rest of
its path, which a URL may go on from anywhere. The rests of a node are looked up by
the beginnings of the URL's segment that have a rest's length, longest first. A URL
is walked the same way, so that each label and segment is looked at once, however
many rules a host has, and the longest rule met decides: the longest host first,
then the longest path.

Rules are shipped to tasks in tries of at most ``TRIE_RULES`` rules and
``TRIE_BYTES`` bytes; more rules make more tries, each applied in turn.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TRIE_RULES, TRIE_BYTES = 200_000, 16 << 20
DEFAULT = "allow"

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Rules by reversed host labels, then by path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            *segments, rest = path.split("/")
            node = node.setdefault("/", {})  # no label holds a slash
            for segment in segments:
                node = node.setdefault(segment, {})
            ends, sizes = node.setdefault("/", ({}, []))
            at = bisect_left(sizes, len(rest))
            if at == len(sizes) or sizes[at] != len(rest):
                sizes.insert(at, len(rest))
            # Of rules with one host and path, block wins.
            if ends.get(rest, (None,))[0] != "block":
                ends[rest] = (verdict, host.lower() + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Verdict and rule of the longest match."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if "/" in node:
                best = self.longest(node["/"], path) or best
        return best

    def longest(self, node: dict, path: str) -> tuple[str, str] | None:
        best, start = None, 0
        while True:
            ends, sizes = node.get("/", ((), ()))
            stop = path.find("/", start)
            own = path[start:] if stop < 0 else path[start:stop]
            for size in reversed(sizes):
                if size <= len(own) and own[:size] in ends:
                    best = ends[own[:size]]
                    break
            if stop < 0:
                return best
            node = node.get(own)
            if node is None:
                return best
            start = stop + 1


def in_tries(rules: Iterable[Rule]) -> Iterator[Trie]:
    held, size = [], 0
    for rule in rules:
        held.append(rule)
        size += sum(map(len, rule))
        if len(held) == TRIE_RULES or size > TRIE_BYTES:
            yield Trie(held)
            held, size = [], 0
    if held:
        yield Trie(held)


def judge(urls: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = DEFAULT) -> DataFrame:
    """All columns of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    A null URL, or one without ``://``, has an empty host and path, which no
    rule fits, and gets the default verdict, as all URLs without a rule do. Of equally
    long rules the blocking one decides. Without rules all get the default. Repeated
    rows are judged each, URLs of any length by all of their labels and segments; an
    empty table gives an empty one.
    """
    new = ["host", "path", "rule", "verdict"]
    kept = [name for name in urls.columns if name not in new]
    quoted = [F.col(f"`{name}`") for name in kept]
    source = F.col(f"`{url}`")
    out = urls.select(*quoted, host_of(source).alias("host"), path_of(source).alias("path"))
    out = out.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string"))
    for trie in in_tries(rules):
        out = applied(out, urls.sparkSession.sparkContext.broadcast(trie))
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def applied(judged: DataFrame, shared) -> DataFrame:
    """``judged`` with the rules of one more trie."""
    n = len(judged.columns)

    def longer(new: tuple[str, str], old: tuple[str | None, str | None]) -> bool:
        if old[1] is None:
            return True
        size = lambda rule: (len(rule.split("/", 1)[0]), len(rule))
        return (size(new[1]), new[0] == "block") > (size(old[1]), old[0] == "block")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.find
        for batch in parts:
            host, path, rule, verdict = (batch.column(n - 4 + i).to_pylist() for i in range(4))
            for i, found in enumerate(map(find, host, path)):
                if found and longer(found, (verdict[i], rule[i])):
                    verdict[i], rule[i] = found
            yield pa.RecordBatch.from_arrays([*batch.columns[: n - 2], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], batch.schema.names)

    return judged.mapInArrow(run, judged.schema)
