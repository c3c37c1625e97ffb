"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines: a block element ends a line, and each border of a sectioning element
leaves an empty one, as in a page written with one tag a line. Text lengths are summed over windows
of ``WINDOW`` lines that slide down the page. Text surges where a window holds at least ``SURGE``
characters and dives where a window is empty; what lies between is main text.

Lines that cannot be main text have no length: scripts, styles, comments, the head, menus, headers,
footers, side bars, notices, adverts, forms and reader comments, known by element, role or class.
Where a page names its article or main element, lines outside of it have no length either, and
as nothing else is left there, any text in it makes a surge; so no short paragraph of an article
is lost. Elsewhere lines that are links alone have no length.

A page is one row and read in one pass; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW, SURGE = 3, 80

# Elements of HTML by what they do to lines.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr !doctype".split()
)
SECTIONING = frozenset(
    "html head body div section article main nav aside header footer form fieldset dialog "
    "menu figure details center frameset".split()
)
BLOCKS = SECTIONING | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote "
    "pre address hr figcaption summary hgroup option legend".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(["article", "main"])
FURNITURE = RAW | frozenset(
    "head nav aside header footer form button select option input label dialog menu object svg "
    "canvas audio video math".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar".split()
)
# Words of a class or an id that name furniture.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription paywall sidebar rail widget widgets nav navbar "
    "navigation menu menus breadcrumb breadcrumbs pagination pager toolbar header masthead footer "
    "copyright comment comments commentlist disqus replies respond related recommended "
    "recommendations share sharing social login signup search skip hidden".split()
)
# Those that tell an article element from the article; words that turn a name around.
REPLIES = frozenset("comment comments reply replies related recommended teaser promo".split())
TURNING = frozenset("no not has with without is".split())
HEADERS = frozenset(["header", "masthead"])

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote matters after an equals sign alone, and only if there is another one.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?![\w-])"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.I,
)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Line:
    """Text of a line, how many of its characters are links, and whether the article holds it."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    main: bool = False

    @cached_property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class Open:
    """An open element: whether it is furniture, the article, or a heading kept in a header."""

    name: str
    furniture: bool = False
    header: bool = False
    main: bool = False
    kept: bool = False


def named(attributes: str) -> set[str]:
    """Words of class, id, role and of what hides an element."""
    words: set[str] = set()
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value.strip() == "true"):
            words.add("hidden")
        elif key == "role":
            words |= {"hidden"} if value.strip() in ROLES else set()
        elif key in ("class", "id"):
            for token in map(_WORDS.findall, value.split()):
                if token and token[0] not in TURNING:
                    words.update(token)
    return words


def opened(name: str, attributes: str) -> Open:
    """An element as its name and attributes make it."""
    words = named(attributes) if attributes else set()
    if name in MAIN:
        furniture = not REPLIES.isdisjoint(words)
        return Open(name, furniture, main=not furniture)
    if name in ("html", "body"):
        return Open(name)
    found = words & NAMES
    header = (name == "header" or bool(found)) and found <= HEADERS
    return Open(name, name in FURNITURE or bool(found), header)


class Reader:
    """Turns a page into lines; furniture leaves no text, only the borders around it."""

    def __init__(self, page: str):
        self.page = page
        self.lines = [Line()]
        self.stack: list[Open] = []
        self.hidden = self.inside = self.links = self.kept = 0

    def read(self) -> list[Line]:
        at = 0
        for begin, end, closing, name, attributes in tags(self.page):
            if begin > at:
                self.put(self.page[at:begin])
            at = end
            if name == "br":
                self.put(" ")
            elif name and closing:
                self.close(name)
            elif name:
                self.open(name, attributes)
        self.put(self.page[at:])
        return self.lines

    def put(self, text: str) -> None:
        if self.hidden and not self.kept:
            return
        text = unescape(text)
        line = self.lines[-1]
        line.parts.append(text)
        line.main = line.main or self.inside > 0
        if self.links:
            line.linked += len("".join(text.split()))

    def end_line(self, border: bool = False) -> None:
        if self.lines[-1].parts:
            self.lines.append(Line())
        if border and not self.hidden:
            self.lines.append(Line())

    def open(self, name: str, attributes: str) -> None:
        if name in MAIN and self.hidden:
            self.leave_unclosed()
        if name in BLOCKS:
            self.end_line(name in SECTIONING)
        if name == "p" or name in HEADINGS:
            self.leave_paragraph()
        if name in VOID or attributes.endswith("/"):
            return
        element = opened(name, attributes)
        element.main = element.main and not self.hidden
        element.kept = name in HEADINGS and self.inside > 0 and all(
            e.header for e in self.stack if e.furniture
        )
        self.stack.append(element)
        self.count(element, 1)

    def close(self, name: str) -> None:
        if name in BLOCKS:
            self.end_line()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].name == name:
                self.leave(k)
                if name in SECTIONING:
                    self.end_line(True)
                return

    def leave(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.count(self.stack.pop(), -1)

    def count(self, element: Open, by: int) -> None:
        self.hidden += by * element.furniture
        self.inside += by * element.main
        self.kept += by * element.kept
        self.links += by * (element.name == "a")

    def leave_paragraph(self) -> None:
        """A paragraph left open ends where the next begins, with the inline elements in it."""
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k].name
            if name == "p" or name in HEADINGS:
                return self.leave(k)
            if name in BLOCKS:
                return None

    def leave_unclosed(self) -> None:
        """Furniture that is never closed ends where the article begins."""
        k = next(i for i, e in enumerate(self.stack) if e.furniture)
        starts, ends = self.borders.get(self.stack[k].name, (0, 0))
        if starts > ends:
            self.end_line()
            self.leave(k)

    @cached_property
    def borders(self) -> dict[str, tuple[int, int]]:
        """How many start and end tags each element has."""
        counts: dict[str, tuple[int, int]] = {}
        for _, _, closing, name, _ in tags(self.page):
            starts, ends = counts.get(name, (0, 0))
            counts[name] = (starts + (not closing), ends + closing)
        return counts


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """``begin, end, closing, name, attributes`` of all markup; comments have no name.

    The content of scripts, styles and the like belongs to their markup.
    """
    at, size = 0, len(page)
    while (begin := page.find("<", at)) >= 0:
        found = _TAG.match(page, begin)
        if found is None:
            at = begin + 1
            continue
        at = found.end()
        name = (found.group(2) or "").lower()
        closing = found.group(1) == "/"
        if name in RAW and not closing and not found.group(3).endswith("/"):
            stop = _raw_end(name).search(page, at)
            at, name = stop.end() if stop else size, ""
        yield begin, at, closing, name, found.group(3) or ""


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?![\w-])[^>]*(?:>|\Z)", re.I)


def main_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """Lines between the points where text surges and where it dives.

    A page whose fullest window stays below ``surge`` has its surges there.
    """
    article = any(line.main and line.text for line in lines)
    lengths = [
        len(line.text) if (line.main if article else line.linked < _solid(line.text)) else 0
        for line in lines
    ]
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    least = max(1, min(1 if article else surge, max(sums)))
    kept, at = [], 0
    while at < len(sums):
        if sums[at] < least:
            at += 1
            continue
        first = last = at
        # The text that leads up to the surge belongs to it.
        while first and sums[first - 1]:
            first -= 1
        while last < len(sums) and sums[last]:
            last += 1
        kept += [lines[k].text for k in range(first, last) if lengths[k]]
        at = last
    return kept


def _solid(text: str) -> int:
    """Characters that are not white space."""
    return len(text) - text.count(" ")


def extract(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Main text of a page, one line a block; empty where there is none."""
    return "\n".join(main_lines(Reader(page).read(), window, surge)) if page else ""


def main_text(pages: DataFrame, window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page.

    A null or empty page has an empty text. Every row gives one row, also where ids are
    missing or repeat; other columns are ignored. Whole pages are read, whatever their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), window, surge) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html")
    return narrow.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
