"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams over the page; block elements cut its text into lines. A line's
ratio is its characters over the tags seen with it. Ratios are smoothed with a Gaussian and split in
two clusters; lines of the upper one are content. The content region starts at the smallest element that
holds most of their text. If an article or main element is around it, that is the region (of several articles with
content, the main element around them or the smallest with all content), else the
smallest element with all content, and from there outwards, below the body, while what is added is mostly
text outside links. All lines of the region belong to the article, short ones too, except those in
elements that never hold article text: menus, headers, footers, sidebars, scripts, styles. Forms, dialogs
and elements named as notices, adverts or comments, wholly or in part, are doubted: they are left out unless
hardly any text lies outside doubted elements, as where a form or a ``has-sidebar`` is around the whole page; then the
outermost ones with most of the content stay. Comments stay only if there is nothing else. Whatever cannot stand in a
head ends it.

Elements are numbered as they open, so those inside another are a run of numbers: time and memory grow with the
page, however deep its elements nest. A null or empty page, or one without text, gives an empty text. Unclosed elements
and cut pages are read as far as they go. Repeated rows get equal results, an empty table an empty result. Other
columns are kept; the new one avoids their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from glebe.llm.tables import apart

#: Elements that cut text into lines
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without article text
OUTSIDE = frozenset("nav header footer aside script style noscript template head title iframe svg select menu textarea canvas".split())
#: Elements that seldom hold article text
DOUBTED = frozenset("button dialog form object".split())
#: Elements without an end tag
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that name parts outside the article
NAMED = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form header "
    "login masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted recommended related replies reply respond "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Those of them that name what readers wrote, unless behind one of the words after
READERS = frozenset("comment comments disqus replies reply respond".split())
LAYOUT = frozenset("has no with without".split())
#: Elements that may stand in a head
IN_HEAD = frozenset("base link meta noscript script style template title".split())
_CLOSES_P = BLOCKS - {"html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend", "summary"}
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Line:
    __slots__ = ("text", "tags", "node", "linked")

    def __init__(self, node: int):
        self.text: list[str] = []
        self.tags = 0
        self.node = node  # the innermost element around it
        self.linked = 0  # characters in links


class Page(HTMLParser):
    """Lines of a page outside the excluded elements, and its elements, numbered as they open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.at: dict[str, list[int]] = {}  # places of each tag's open elements
        self.outside = 0  # number of the outermost excluded element, 0 if none
        self.parent, self.last, self.kind = [0], [0], [""]  # of each element; the last one opened inside it
        self.doubted: dict[int, bool] = {}  # elements that may be excluded, and whether they are readers' comments
        self.lines: list[Line] = []
        self.line = Line(0)

    def cut(self) -> None:
        if self.line.text:
            self.lines.append(self.line)
        self.line = Line(self.open[-1][1] if self.open else 0)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in IN_HEAD and self.open and self.open[-1][0] == "head":
            self.handle_endtag("head")
        if tag in _CLOSES_P and self.at.get("p"):
            self.handle_endtag("p")
        elif tag == "li" and self._place("li") > max(self._place(t) for t in ("ul", "ol", "menu")):
            self.handle_endtag("li")
        block = tag in BLOCKS
        if block:
            self.cut()
        self.line.tags += 1
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        me = len(self.kind)
        self.parent.append(self.open[-1][1] if self.open else 0)
        self.last.append(me)
        self.kind.append("main" if ("role", "main") in attrs else tag)
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, me))
        named = self._named(tag, attrs)
        if not self.outside and tag in OUTSIDE:
            self.outside = me
        elif named or tag in DOUBTED:
            self.doubted[me] = named == "readers"
        if block:
            self.line.node = me

    def _place(self, tag: str) -> int:
        places = self.at.get(tag)
        return places[-1] if places else -1

    def _named(self, tag: str, attrs: list) -> str:
        """Whether a class, id or role names what readers wrote, another excluded part, or none."""
        if tag in ("html", "body", "article", "main"):
            return ""
        said = " ".join(v for k, v in attrs if k in ("class", "id", "role", "aria-label") and v).lower()
        names = [[w for w in _SPLIT.split(name) if w] for name in said.split()]
        if any(not READERS.isdisjoint(name) and LAYOUT.isdisjoint(name) for name in names):
            return "readers"
        return "part" if any(not NAMED.isdisjoint(name) for name in names) else ""

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        at = self._place(tag)
        if at < 0:
            return
        if any(self.open[i][0] in BLOCKS for i in range(at, len(self.open))):
            self.cut()
        if self.outside and self.open[at][1] <= self.outside:
            self.outside = 0
        for name, node in reversed(self.open[at:]):
            self.at[name].pop()
            self.last[node] = len(self.kind) - 1
        del self.open[at:]
        if not self.line.text:
            self.line.node = self.open[-1][1] if self.open else 0

    def handle_data(self, data: str) -> None:
        if not self.outside and data:
            self.line.text.append(data)
            if self.at.get("a"):
                self.line.linked += len(data.strip())

    def done(self) -> list[Line]:
        self.close()
        self.cut()
        for _, node in self.open:
            self.last[node] = len(self.kind) - 1
        return self.lines

    def holds(self, node: int, line: Line) -> bool:
        return node <= line.node <= self.last[node]


def _content(ratio: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Which lines stand in the upper of two clusters of the smoothed ratios."""
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * sigma**2))
    smooth = np.convolve(ratio, kernel, "full")[3:-3] / np.convolve(np.ones(ratio.size), kernel, "full")[3:-3]
    low, high = smooth.min(), smooth.max()
    for _ in range(20):
        upper = smooth >= (low + high) / 2
        if upper.all():
            break
        new = smooth[~upper].mean(), smooth[upper].mean()
        if new == (low, high):
            break
        low, high = new
    return smooth >= (low + high) / 2


Text = tuple[Line, str]


def _weights(page: Page, lines: list[Text]) -> tuple[np.ndarray, list[float]]:
    """Content characters of each line and of each element."""
    length = np.array([len(t) for _, t in lines], float)
    weight = np.where(_content(length / np.array([max(1, line.tags) for line, _ in lines])), length, 0.0)
    return weight, _inside(page, lines, weight)


def _inside(page: Page, lines: list[Text], value) -> list[float]:
    """Sum of the lines' values in each element."""
    held = [0.0] * len(page.kind)
    for (line, _), v in zip(lines, value):
        held[line.node] += v
    for n in range(len(held) - 1, 0, -1):
        held[page.parent[n]] += held[n]
    return held


def _undoubted(page: Page, lines: list[Text], most: float) -> list[Text]:
    """The lines outside doubted elements, after the doubt is lifted from what encloses the content."""
    weight, held = _weights(page, lines)
    plain = [max(0, len(t) - line.linked) for line, t in lines]  # characters outside links
    doubted = dict(page.doubted)
    while doubted:
        free = [not inside for inside in _marked(page, lines, doubted)]
        clear = sum(n for n, f in zip(plain, free) if f) / max(1, sum(plain))
        lifted = [n for n, readers in doubted.items() if held[n] > most * weight.sum() and clear < (0.05 if readers else 0.2)]
        if not lifted:
            return [line for line, f in zip(lines, free) if f]
        del doubted[min(lifted)]
    return lines


def _marked(page: Page, lines: list[Text], nodes) -> list[bool]:
    """Whether each line stands in one of the elements."""
    inside = [False] * len(page.kind)
    for n in range(1, len(inside)):
        inside[n] = n in nodes or inside[page.parent[n]]
    return [inside[line.node] for line, _ in lines]


def main_text(html: str | None, most: float = 0.5) -> str:
    """The article's blocks, parted by an empty line."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    lines = [(line, text) for line in page.done() if (text := _SPACE.sub(" ", "".join(line.text)).strip())]
    lines = _undoubted(page, lines, most) if lines else []
    if not lines:
        return ""
    weight, held = _weights(page, lines)
    several = _inside(page, lines, [1] * len(lines))
    # elements with most of the content, but for lone paragraphs
    blocks = {line.node for line, _ in lines}
    inner = [n for n in range(1, len(held)) if held[n] > most * weight.sum() and (n not in blocks or several[n] > 1)] or [0]
    whole = [n for n in inner if held[n] >= weight.sum() - 0.5]
    region = _climb(page, lines, max(inner), max(whole, default=0))
    return "\n\n".join(t for line, t in lines if region == 0 or page.holds(region, line))


def _climb(page: Page, lines: list[Text], dense: int, region: int) -> int:
    """The article around the densest element; ``region`` is the smallest element with all content."""
    around = [dense]
    while around[-1]:
        around.append(page.parent[around[-1]])
    chars = _inside(page, lines, [len(t) for _, t in lines])
    articles = [n for n in range(1, len(chars)) if page.kind[n] == "article" and 4 * chars[n] >= chars[dense]]
    beside, end = 0, 0  # articles with content that lie in no other
    for n in articles:
        if n > end:
            beside, end = beside + 1, page.last[n]
    if beside < 2:
        for n in reversed(around):
            if n and page.kind[n] == "article":
                return n
    for n in reversed(around):
        if n and page.kind[n] == "main":
            return n
    above = []
    n = page.parent[region]
    while region and n:
        above.append(n)
        n = page.parent[n]
    for n in above:
        if page.kind[n] in ("html", "body"):
            break
        added = [(line.linked, len(t)) for line, t in lines if page.holds(n, line) and not page.holds(region, line)]
        if 2 * sum(a for a, _ in added) > sum(b for _, b in added):
            break
        region = n
    return region


def _extract(batches: Iterator[pa.RecordBatch], html: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(v.as_py()) for v in batch.column(html)], pa.string())
        kept = [c for c in batch.schema.names if c != html]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], [*kept, name])


def extract(pages: DataFrame, html: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with the main text in the place of the html; returns the name of the new column."""
    name, = apart(pages, "text")
    fields = [f for f in pages.schema.fields if f.name != html]
    return pages.mapInArrow(partial(_extract, html=html, name=name), T.StructType([*fields, T.StructField(name, T.StringType())])), name
