"""Main text of web pages: streaming parser events, smoothed text-to-tag ratios, clustered content regions.

The standard library's parser streams a page's events into lines, one for each block of text. Each line has a
text-to-tag ratio; the ratios are smoothed by a Gaussian and split into two clusters by a threshold, and the upper
one is content. The clusters choose the region: the article with most content and every other one whose text is mostly
content, or else the main elements by the same rule, or else the innermost container that holds nearly all content, less its
parts that are links and mostly no content. All lines of the region are kept, also short ones, but for those within elements that
are never article text: menus, headers, footers, sidebars, notices, adverts, forms and comments. An element whose
compound name only mentions such a part ("article-share-wrap") is one unless it holds most of the page's content, and a
name that says what the element has ("has-sidebar") marks nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepared

#: Elements that begin a new line, hold other elements, or never hold article text.
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote br caption dd details dialog dir dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr legend li menu nav ol optgroup option p pre summary tfoot th thead title ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("aside button dialog footer form head header iframe menu nav noscript object script select style svg template textarea title".split())
#: Words of class, id or role that mark such parts in pages without the elements.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies dialog disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification pager pagination popup promo promotion related search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe toolbar widget".split()
)
#: Reader comments, which may outweigh the article, and words before the name of what an element has or lacks.
COMMENTS = frozenset("comment comments disqus".split())
HAVING = frozenset("has have no show hide with without".split())
TOKENS = re.compile(r"[a-z]+")
#: Standard deviation of the smoothing in lines, the share of all content a container must hold, and the one beyond which a compound name is overruled.
SIGMA, SHARE, MOST = 1.5, 0.9, 0.5


@dataclass
class Line:
    text: str
    tags: int
    links: int  # characters inside links
    never: bool
    path: tuple[int, ...]  # open containers, outermost first
    doubtful: tuple[int, ...] = ()  # open elements with a compound name that mentions such a part


def marked(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether class, id or role name a part that is never article text: for sure, and possibly."""
    if tag in ("html", "body", "main"):
        return False, False
    doubtful = False
    for name in " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower().split():
        parts = TOKENS.findall(name)
        if not parts or parts[0] in HAVING:
            continue
        marks = (COMMENTS if tag == "article" else MARKS).intersection(parts)
        if marks and (len(parts) == 1 or not COMMENTS.isdisjoint(marks)):
            return True, False
        doubtful = doubtful or bool(marks)
    return False, doubtful


class Lines(HTMLParser):
    """Turns parser events into lines; unclosed and stray tags are tolerated."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.kinds: dict[int, str] = {}  # containers by number
        self.stack: list[tuple[str, int, bool, int]] = []  # open elements: tag, container number or -1, never, doubt's number or -1
        self.doubts = 0
        self.never = self.inside_link = self.tags = self.link_chars = 0
        self.parts: list[str] = []

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = tuple(n for _, n, _, _ in self.stack if n >= 0)
            doubtful = tuple(d for _, _, _, d in self.stack if d >= 0)
            self.lines.append(Line(text, self.tags, self.link_chars, self.never > 0, path, doubtful))
            self.tags = self.link_chars = 0
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
        if tag in VOID:
            return
        if tag == "a":
            self.inside_link += 1
        elif tag in BLOCKS or tag in NEVER:
            if tag in ("p", "li", "option", "dt", "dd") and self.stack and self.stack[-1][0] == tag:
                self._close(tag)
            never, doubtful = (True, False) if tag in NEVER else marked(tag, attrs)
            self.never += never
            self.doubts += doubtful
            number = -1
            if tag in CONTAINERS:
                number = len(self.kinds)
                self.kinds[number] = "main" if ("role", "main") in attrs else tag
            self.stack.append((tag, number, never, self.doubts if doubtful else -1))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in CONTAINERS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.inside_link = max(0, self.inside_link - 1)
        elif tag in BLOCKS or tag in NEVER:
            if tag in BLOCKS:
                self.cut()
            if any(t == tag for t, _, _, _ in self.stack):
                self._close(tag)

    def _close(self, tag: str) -> None:
        while self.stack:
            own, _, never, _ = self.stack.pop()
            self.never -= never
            if own == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.never and self.stack and self.stack[-1][0] in ("script", "style"):
            return
        self.parts.append(data)
        if self.inside_link:
            self.link_chars += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean of each ratio and its neighbours; weights beyond the ends are left out."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    size = len(ratios)
    total = np.convolve(ratios, kernel)[reach : reach + size]
    return total / np.convolve(np.ones(size), kernel)[reach : reach + size]


def threshold(values: np.ndarray) -> float:
    """Where two clusters of numbers meet, by the means of either side until they settle."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            return cut
        moved = (float(low.mean()) + float(high.mean())) / 2
        if abs(moved - cut) < 1e-9:
            break
        cut = moved
    return cut


def main_lines(html: str) -> list[str]:
    """The lines of the main text in page order, none if the page has no content."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    lines = parser.lines
    if not lines:
        return []
    ratios = np.array([(len(x.text) - min(x.links, len(x.text))) / max(1, x.tags) for x in lines])
    values = smoothed(ratios)
    content = [len(x.text) * bool(inside) for x, inside in zip(lines, values >= threshold(values))]
    _settle(lines, content)
    mass: dict[int, int] = {}
    raw: dict[int, int] = {}
    for x, chars in zip(lines, content):
        if not x.never:
            for n in x.path:
                raw[n] = raw.get(n, 0) + len(x.text)
                mass[n] = mass.get(n, 0) + chars
    for kind in ("article", "main"):
        # the outermost ones; what lies within them is theirs
        own = {next((n for n in x.path if parser.kinds[n] == kind), None) for x in lines if not x.never} - {None}
        if own:
            # most content; of equals most text, then the first
            best = max(own, key=lambda n: (mass[n], raw[n], -n))
            chosen = {best} | {n for n in own if 2 * mass[n] > raw[n]}
            return [x.text for x in lines if not x.never and not chosen.isdisjoint(x.path)]
    if not raw:
        return [x.text for x in lines if not x.never]
    weight = mass if max(mass.values()) else raw
    most = max(weight.values())
    region = max(n for n in weight if weight[n] >= SHARE * most)
    linked: dict[int, int] = {}
    inner = [next((m for n, m in zip(x.path, x.path[1:]) if n == region), None) for x in lines]
    for x, m in zip(lines, inner):
        if not x.never and m is not None:
            linked[m] = linked.get(m, 0) + min(x.links, len(x.text))
    menus = {m for m, links in linked.items() if 2 * mass[m] <= raw[m] and 2 * links > raw[m]}
    return [x.text for x, m in zip(lines, inner) if not x.never and region in x.path and m not in menus]


def _settle(lines: list[Line], content: list[int]) -> None:
    """Decide doubtful elements: those that hold most of the content that may be article text are no such part."""
    held: dict[int, int] = {}
    total = 0
    for x, chars in zip(lines, content):
        if not x.never:
            total += chars
            for d in x.doubtful:
                held[d] = held.get(d, 0) + chars
    for x in lines:
        x.never = x.never or any(held.get(d, 0) <= MOST * total for d in x.doubtful)


def main_text(html: str | None) -> str:
    """Blocks of the main text, joined by one space; empty for a null or empty page."""
    return " ".join(main_lines(html)) if html else ""


def with_main_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Add each page's main text.

    A null or empty page, and one without article text, gives an empty text; a page is read whole, however long it is. Rows
    that repeat get equal texts, an empty table stays empty, and a column that has the new one's name is replaced.
    """
    prepared(pages.sparkSession)

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(h) for h in batch.to_pylist()], pa.string())

    return pages.withColumn(name, extracted(F.col(html)))
