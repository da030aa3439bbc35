"""Main text of web pages from text-to-tag ratios.

The standard library's streaming parser turns a page into lines: one per block
element, with the text inside and the number of tags met. A line's ratio of
characters to tags is smoothed with a Gaussian over its neighbours, and two
clusters (centres moved until they are stable) give the threshold between
content and the rest. Elements that are never part of an article (menus,
footers, forms, adverts, comments ...) yield lines that carry no text but keep
their tags, so they press the ratio of their surroundings down. The content
lines then choose the region: from the smallest element that holds most of their
text up to the article or main element around it, and further to the smallest that
holds all content lines inside such elements (all content lines of the page, if
nothing of the kind is around it). Every line of that region counts, a short one too.

Defined results: a null or empty page, and one with no text outside the
excluded elements, gives an empty text. Rows that repeat a page_id are
extracted one by one, null ids included. An empty table gives no rows; extra
columns are ignored. Markup that is cut off in the middle, and openings that
nothing closes, are text as far as the parser reads them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import pieces

SMOOTHING = 1.0
REGION_SHARE = 0.7

_RAW = frozenset("script style noscript template svg math iframe object canvas title".split())
_NEVER = _RAW | frozenset("nav footer aside form head button select textarea dialog menu".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_REGION = frozenset("article main section div body td".split())
_WHOLE = frozenset("article main".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split()
)
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|nav(?:igation|bar)?|menu|breadcrumbs?|"
    r"sidebar|footer|masthead|site-?header|page-?header|cookies?|consent|notice|popup|modal|newsletter|subscribe|"
    r"share|social|related|recommended|comments?|commentlist|disqus|respond|login|search|pagination|skip-link)"
    r"(?:$|[\s_-])",
    re.I,
)
# Closing one of these by opening another of the same set.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = _BLOCK - {"br"}


class _Lines(HTMLParser):
    """Lines of a page: text, tags met, and the path of open regions."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # name, excluded from here on, region
        self.names: Counter = Counter()  # of the open elements
        self.skipping = 0
        self.regions: list[int] = [-1]  # parent of each region
        self.own: list[int] = [-1]  # the article or main that each region is or lies in
        self.region = 0
        self.text: list[str] = []
        self.tags = 0
        self.lines: list[tuple[str, int, int]] = []

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text or self.tags:
            self.lines.append((text, self.tags, self.region))
        self.text, self.tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK:
            self.cut()
        self.tags += 1
        if tag in _ENDS_P:
            self._close_all(_CLOSES.get(tag, {"p"}))
        if tag in _VOID:
            return
        excluded = self._excluded(tag, attrs)
        self.skipping += excluded
        self.names[tag] += 1
        if tag in _REGION and not self.skipping:
            self.regions.append(self.region)
            self.region = len(self.regions) - 1
            self.own.append(self.region if tag in _WHOLE else self.own[self.regions[-1]])
            self.open.append((tag, excluded, self.regions[-1]))
        else:
            self.open.append((tag, excluded, -1))

    def _excluded(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in _NEVER:
            return True
        if tag == "header":  # a page's, not an article's
            return not (self.names["article"] or self.names["main"])
        if tag in ("article", "main", "body", "html"):
            return False
        for key, value in attrs:
            value = value or ""
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if key == "role" and value in _ROLES or key in ("class", "id") and _NAMES.search(value):
                return True
        return False

    def _close_all(self, names: set[str]) -> None:
        """Implied end tags inside the innermost block."""
        while self.open and (self.open[-1][0] in names or self.open[-1][0] not in _BLOCK and any(
            name in names for name, _, _ in self.open[-3:]
        )):
            self._pop()

    def _pop(self) -> str:
        name, excluded, parent = self.open.pop()
        self.names[name] -= 1
        self.skipping -= excluded
        if parent >= 0:
            self.region = parent
        return name

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self.cut()
        self.tags += 1
        if self.names[tag]:
            while self._pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.text.append(data)

    def handle_decl(self, decl: str) -> None:
        self.tags += 1

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Broken marked sections are comments up to the next ``>``, as browsers read them."""
        return self.parse_bogus_comment(i)


def _smoothed(ratio: np.ndarray) -> np.ndarray:
    radius = int(np.ceil(3 * SMOOTHING))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / SMOOTHING) ** 2)
    weights = np.convolve(np.ones(len(ratio)), kernel, mode="full")[radius:-radius]
    return np.convolve(ratio, kernel, mode="full")[radius:-radius] / weights


def _threshold(values: np.ndarray) -> float:
    """Middle between the centres of two clusters."""
    low, high = values.min(), values.max()
    for _ in range(50):
        middle = (low + high) / 2
        below, above = values[values <= middle], values[values > middle]
        if not len(above):
            break
        now = below.mean(), above.mean()
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def _closable(html: str) -> str:
    """The page with openings that nothing closes made text, but for the last one.

    The parser looks for the end of each of them anew, which takes the square
    of their number.
    """
    at = html.rfind("-->") + 1
    html = html[:at] + html[at:].replace("<!--", "&lt;!--")
    at = html.rfind(">") + 1
    last = max(html.rfind("<"), at)
    return html[:at] + html[at:last].replace("<", "&lt;") + html[last:]


def _add_to_parents(values: list, parents: list[int]) -> None:
    """Sums over each region and all inside it; parents have smaller numbers, so one pass from the last is enough."""
    for i in range(len(values) - 1, 0, -1):
        values[parents[i]] += values[i]


def main_text(html: str) -> str:
    """The article of a page as one line of text."""
    parser = _Lines()
    parser.feed(_closable(html))
    parser.close()
    parser.cut()
    lines = parser.lines
    if not any(text for text, _, _ in lines):
        return ""
    sizes = np.fromiter((len(text) for text, _, _ in lines), np.float64, len(lines))
    tags = np.fromiter((n for _, n, _ in lines), np.float64, len(lines))
    ratio = np.log1p(sizes / np.maximum(tags, 1))
    smooth = _smoothed(ratio)
    content = (smooth >= _threshold(smooth)) & (sizes > 0)
    if not content.any():
        content = sizes > 0
    inside = [0.0] * len(parser.regions)
    for (_, _, region), size, good in zip(lines, sizes, content, strict=True):
        if good:
            inside[region] += size
    _add_to_parents(inside, parser.regions)
    enough = REGION_SHARE * inside[0]
    chosen = max(i for i, size in enumerate(inside) if size >= enough)
    around = parser.own[chosen]
    if around >= 0:
        chosen = around
    # The last region that holds it and all content lines is the smallest one.
    wanted = [0] * len(inside)
    wanted[chosen] = 1
    for (_, _, region), good in zip(lines, content, strict=True):
        if good and (around < 0 or parser.own[region] >= 0):
            wanted[region] += 1
    everything = sum(wanted)
    _add_to_parents(wanted, parser.regions)
    chosen = max(i for i, n in enumerate(wanted) if n == everything)
    within = [i == chosen for i in range(len(inside))]
    for i in range(chosen + 1, len(inside)):
        within[i] = within[parser.regions[i]]
    return " ".join(text for text, _, region in lines if text and within[region])


def extracted(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): one row per page."""

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, htmls in pieces(batches, "html"):
            texts = [main_text(x) for x in htmls]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    read = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type = read.schema["page_id"].dataType.simpleString()
    return read.mapInArrow(texts_of, f"page_id {id_type}, url string, text string, n_chars bigint")
