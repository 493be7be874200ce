"""HTML columns: title by pattern, and a per-row reader for pages.

The reader is a small helper on the standard-library tokenizer; Spark decides
where and on how many rows it runs (``mapInPandas`` over the pages table).
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Workers get this module with the task, so they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
NO_SINGLE_STRING = "None"
CONTAINER_TAG = "div"
CONTAINER_CLASS = "page"
TEXT_TAGS = ("h1", "h2", "h3", "b", "i", "p", "a")
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
SPECIAL_TEXT_TAGS = frozenset(("rp", "rt", "script", "style", "template"))
PREFORMATTED_TAGS = frozenset(("pre", "textarea"))
ASCII_SPACES = " \n\t\f\r"
PAGES_PER_FRAME = 64
TITLE_PATTERN = r"(?is)<title[^>]*>([^<]*)</title>"
TITLE_TAG_PATTERN = r"(?i)<title[\s>]"


def html_title(html: Column) -> Column:
    """Raw title: ``''`` without the tag, ``'None'`` when it has no single string."""
    found = F.regexp_extract(html, TITLE_PATTERN, 1)
    return (
        F.when(found != "", found)
        .when(html.rlike(TITLE_TAG_PATTERN), F.lit(NO_SINGLE_STRING))
        .otherwise(F.lit(""))
    )


class PageReader(HTMLParser):
    """Collects title, main-block text and link targets in one pass.

    Tags never close each other: an end tag closes everything up to the
    nearest open tag of its name, and is ignored when there is none.
    """

    def __init__(self, tag: str, css_class: str, text_tags: Sequence[str]):
        super().__init__(convert_charrefs=False)
        self._wanted = (tag, css_class)
        self._text_tags = frozenset(text_tags)
        self._open: list[tuple[str, int | None]] = []
        self._depths: Counter[str] = Counter()
        self._pending: list[str] = []
        self._void_closed: set[str] = set()
        self._inside = None  # depth of the container while it is open
        self._container_seen = False
        self._strings: list[str] = []
        self._spans: list[list[int]] = []
        self._title_depth = None
        self._title_children: list | None = None
        self._title_stack: list[list] = []
        self.hrefs: list[str] = []

    def read(self, html: str) -> tuple[str, str, list[str]]:
        self.feed(html)
        self.close()
        self._flush()
        self._close_down_to(0)
        body = " ".join("".join(self._strings[a:b]) for a, b in self._spans)
        return self._title(), body, self.hrefs

    # -- text ----------------------------------------------------------------
    def _flush(self, counts_as_text: bool = True) -> None:
        if not self._pending:
            return
        data = "".join(self._pending)
        self._pending.clear()
        if not data.strip(ASCII_SPACES) and not any(self._depths[t] for t in PREFORMATTED_TAGS):
            data = "\n" if "\n" in data else " "
        if self._title_stack:
            self._title_stack[-1].append(data)
        if self._inside is not None and counts_as_text:
            if not any(self._depths[t] for t in SPECIAL_TEXT_TAGS):
                self._strings.append(data)

    def handle_data(self, data: str) -> None:
        self._pending.append(data)

    def handle_charref(self, name: str) -> None:
        # Numbers are read as the HTML standard says, byte values of old pages included.
        self._pending.append(unescape(f"&#{name};"))

    def handle_entityref(self, name: str) -> None:
        self._pending.append(html5.get(name + ";") or html5.get(name) or "&" + name)

    def _special(self, data: str, counts_as_text: bool = False) -> None:
        self._flush()
        self._pending.append(data)
        self._flush(counts_as_text)

    def handle_comment(self, data: str) -> None:
        self._special(data)

    def handle_decl(self, decl: str) -> None:
        self._special(decl)

    def handle_pi(self, data: str) -> None:
        self._special(data)

    def unknown_decl(self, data: str) -> None:
        if data.upper().startswith("CDATA["):
            self._special(data[len("CDATA["):], counts_as_text=True)
        else:
            self._special(data)

    # -- tags ----------------------------------------------------------------
    def handle_starttag(self, tag, attrs) -> None:
        self._start(tag, attrs)
        if tag in VOID_TAGS:
            self._end(tag)
            self._void_closed.add(tag)

    def handle_startendtag(self, tag, attrs) -> None:
        self._start(tag, attrs)
        self._end(tag)

    def handle_endtag(self, tag) -> None:
        if tag in self._void_closed:
            self._void_closed.discard(tag)
        else:
            self._end(tag)

    def _start(self, tag, attrs) -> None:
        self._flush()
        values = {name: value or "" for name, value in attrs}
        if tag == "a" and "href" in values:
            self.hrefs.append(values["href"])
        if self._title_stack:
            self._title_stack[-1].append([])
            self._title_stack.append(self._title_stack[-1][-1])
        elif tag == "title" and self._title_children is None:
            self._title_depth = len(self._open)
            self._title_children = []
            self._title_stack.append(self._title_children)
        span = None
        if self._inside is not None and tag in self._text_tags:
            span = len(self._spans)
            self._spans.append([len(self._strings), len(self._strings)])
        self._open.append((tag, span))
        self._depths[tag] += 1
        if not self._container_seen and tag == self._wanted[0]:
            classes = values.get("class", "")
            wanted = self._wanted[1]
            if not wanted or wanted == classes or wanted in classes.split():
                self._container_seen = True
                self._inside = len(self._open) - 1

    def _end(self, tag) -> None:
        self._flush()
        if not self._depths[tag]:
            return
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == tag:
                self._close_down_to(depth)
                return

    def _close_down_to(self, depth: int) -> None:
        while len(self._open) > depth:
            name, span = self._open.pop()
            self._depths[name] -= 1
            if span is not None:
                self._spans[span][1] = len(self._strings)
            if self._title_stack:
                self._title_stack.pop()
            if self._inside == len(self._open):
                self._inside = None

    def _title(self) -> str:
        node = self._title_children
        if node is None:
            return ""
        while len(node) == 1 and isinstance(node[0], list):
            node = node[0]
        return node[0] if len(node) == 1 else NO_SINGLE_STRING


def read_pages(
    pages: DataFrame,
    html: str = "text",
    container_tag: str = CONTAINER_TAG,
    container_class: str = CONTAINER_CLASS,
    text_tags: Sequence[str] = TEXT_TAGS,
) -> DataFrame:
    """``pages`` with ``html`` replaced by ``title, body, hrefs``; no shuffle."""
    kept = [f for f in pages.schema.fields if f.name != html]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    names = [f.name for f in kept]
    schema = f"{columns}, title string, body string, hrefs array<string>"

    def read(batch: pd.DataFrame) -> pd.DataFrame:
        found = [
            PageReader(container_tag, container_class, text_tags).read(page or "")
            for page in batch[html]
        ]
        out = batch[names].copy()
        out["title"] = [f[0] for f in found]
        out["body"] = [f[1] for f in found]
        out["hrefs"] = [f[2] for f in found]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Badly nested pages repeat their text many times over, so results go
        # back in frames of few pages.
        for batch in batches:
            for start in range(0, len(batch), PAGES_PER_FRAME):
                yield read(batch.iloc[start : start + PAGES_PER_FRAME])

    return pages.select(*names, html).mapInPandas(run, schema)
