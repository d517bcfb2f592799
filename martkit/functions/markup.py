"""Pages written in full: every element with its end tag, every attribute in double quotes.

HTML lets ``</li>``, ``</p>``, ``</td>`` and others be left out.  Columns find pages that do so, and only those go
through a parser with a stack of open elements, in Arrow batches; what it writes is read by the same columns.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions.text import let

# --- fixed values: elements without content, elements whose end may be left out, and what ends them -----------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPTIONAL = "li p tr td th dt dd option optgroup thead tbody tfoot".split()
_CELLS, _PARTS = {"td", "th"}, {"thead", "tbody", "tfoot"}
#: A start tag ends the open elements of the first set, looked for up to an element of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": (_CELLS, {"tr", "table"}),
    "th": (_CELLS, {"tr", "table"}),
    "tr": (_CELLS | {"tr"}, {"table"}),
    "thead": (_CELLS | _PARTS | {"tr"}, {"table"}),
    "tbody": (_CELLS | _PARTS | {"tr"}, {"table"}),
    "tfoot": (_CELLS | _PARTS | {"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
#: Blocks end an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split())
# --- end of fixed values --------------------------------------------------------------------------------------
_PARAGRAPH = ({"p"}, {"table", "td", "th", "caption", "button", "object"})
#: An end tag does not reach out of a cell or table, but for those of tables themselves.
_TABLE = _CELLS | _PARTS | {"tr", "table", "caption"}


class _Writer(HTMLParser):
    """Writes what it reads with all end tags.  References stay as they are: the caller hides ``&``."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out: list[str] = []
        self.open: list[str] = []

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.out.append(f"</{self.open.pop()}>")

    def _end_open(self, ended: set[str], border: set[str]) -> None:
        at = len(self.open)
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] in border:
                break
            if self.open[k] in ended:
                at = k
        self._close_to(at)

    def _start(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_open(*_PARAGRAPH)
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        seen = {}
        for name, value in attrs:
            seen.setdefault(name, value)
        written = "".join(f" {n}" if v is None else ' {}="{}"'.format(
            n, v.replace('"', "&quot;").replace("<", "&lt;").replace(">", "&gt;")) for n, v in seen.items())
        self.out.append(f"<{tag}{written}>")

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs)
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        if tag not in VOID:
            self.out.append(f"</{tag}>")

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] == tag:
                self._close_to(k)
                return
            if self.open[k] == "table" or (self.open[k] in _CELLS and tag not in _TABLE):
                return  # of nothing that is open here

    def handle_data(self, data):
        self.out.append(data)

    def handle_decl(self, decl):
        self.out.append(f"<!{decl}>")


def close_elements(page: str) -> str:
    """One page with every element closed where HTML closes it; end tags of nothing go."""
    hidden = next((c for c in map(chr, range(0xFDD0, 0xFDF0)) if c not in page), "﷐")
    writer = _Writer()
    writer.feed(re.sub(r"(?s)<!\[.*?>|<\?.*?>", "", page).replace("&", hidden))
    writer.close()
    writer._close_to(0)
    return "".join(writer.out).replace(hidden, "&")


def leaves_open(page: Column) -> Column:
    """Whether a page has other start than end tags of an element that may be left open, or a ``<`` in an attribute."""
    tags = F.regexp_extract_all(page, F.lit(rf"(?i)<(/?(?:{'|'.join(OPTIONAL)}))(?=[\s>/])"), F.lit(1))
    ends = let(F.transform(tags, F.lower), lambda names: F.array_sort(F.filter(names, lambda t: ~t.startswith("/"))) != F.array_sort(
        F.transform(F.filter(names, lambda t: t.startswith("/")), lambda t: F.substr(t, F.lit(2)))))
    return ends | page.rlike(r"""=\s*(?:"[^"<>]*<|'[^'<>]*<)""")


def closed_markup(pages: DataFrame, column: str) -> DataFrame:
    """The pages with ``column`` written in full where it leaves elements open; all other pages stay in the JVM as they are."""
    @F.arrow_udf("string")
    def closed(page: pa.Array) -> pa.Array:
        return pa.array([None if p is None else close_elements(p) for p in page.to_pylist()], pa.string())
    page = F.col(column)
    return pages.withColumn(column, F.coalesce(closed(F.when(leaves_open(page), page)), page))
