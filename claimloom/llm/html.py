"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page into lines (one per block element). Lines inside page furniture
(menus, headers, footers, sidebars, adverts, forms, comments) are marked by their elements; a mark that only
part of a name suggests is dropped again where the element holds the article or most of the text. The ratio of text to
tags of all other lines is smoothed over their neighbours. Lines above the threshold form clusters, and the clusters with most
text are the content. Article elements weigh: their lines count double, and a chosen cluster in one takes in its other lines.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import fresh, text_groups

SIGMA = 1.5
#: Content lines reach this share of the largest smoothed ratio.
THRESHOLD = 0.1
#: Lines without content that a cluster may still bridge.
BRIDGE = 3
#: Clusters with this share of the largest one's text are content, too.
CLUSTER_SHARE = 0.25
#: What lines in an article element count in comparison with others.
ARTICLE_WEIGHT = 2.0
#: A weak mark goes where the element holds more than this share of the text.
MOST_TEXT = 0.5
_GROUP_CHARS = 2_000_000

#: HTML's own vocabulary and usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
FURNITURE = frozenset(
    "nav header footer aside form script style noscript template menu button select textarea iframe object svg canvas "
    "audio video dialog head title".split()
)
#: Blocks of running text, which part of a name does not mark.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption td th".split())
ARTICLE = frozenset("article main".split())
#: A block that starts closes these open elements, whose end tags are optional.
CLOSES = {
    "li": ("li", "p"),
    "dd": ("dd", "dt", "p"),
    "dt": ("dd", "dt", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
    "option": ("option",),
}
_FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner sponsored sponsor promo promotion nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs sidebar side-bar rail header masthead footer cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations trending comment comments commentlist respond replies disqus widget widgets "
    "pagination pager skip toolbar copyright tags hidden paywall".split()
)
_LAST_PARTS = frozenset("ad ads comment comments sidebar nav menu banner footer".split())
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
_ARTICLE_NAMES = frozenset("article-body article-content post-content entry-content post-body main-content".split())
_NAME = re.compile(r"[\s]+")
_PART = re.compile(r"[-_]+")
_SPACE = re.compile(r"\s+")
#: What is left of a tag where a page was cut off.
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")


def furniture_mark(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """0 for no furniture, 2 for what element, role or a whole name say, 1 for a form and what part of a name suggests."""
    mark = 0
    if tag in FURNITURE:
        if tag != "form":
            return 2
        mark = 1
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return 2
        if name == "role" and value and value.strip().lower() in _FURNITURE_ROLES:
            return 2
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return 2
        if name in ("class", "id") and value and tag not in ("body", "html", "main"):
            for word in _NAME.split(value.strip().lower()):
                if word in _FURNITURE_NAMES:
                    return 2
                if tag not in TEXT_BLOCKS:
                    parts = _PART.split(word)
                    if parts[0] in _FURNITURE_NAMES or parts[-1] in _LAST_PARTS:
                        mark = 1
    return mark


def _is_article(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in ARTICLE:
        return True
    return any(
        name in ("class", "id", "itemprop", "role")
        and value
        and any(w in _ARTICLE_NAMES or w in ("articlebody", "main") and name != "class" for w in value.lower().split())
        for name, value in attrs
    )


class Lines(HTMLParser):
    """A page's lines in order: text, tags since the line before, number of the outermost article element (0 outside),
    furniture or not.

    Every event costs the same however the page is nested: an end tag is looked for only if one is open, and what is
    looked through is closed.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.article: list[int] = []
        self.furniture: list[bool] = []
        self._open: list[tuple[str, int, bool]] = []  # tag, mark, article
        self._names: dict[str, int] = {}  # how many of each tag are open
        self._strong = self._article = self._articles = 0
        self._parts: list[str] = []
        self._tags = 0
        self._chars = 0  # of the lines that no strong mark covers
        # Weak marks: the one around each, where it began and ended in characters, whether it holds an article.
        self._weak: list[list[int]] = [[0, 0, 0, 0]]
        self._inner = 0
        self._line_weak: list[int] = []

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self._parts)).strip()
        if text:
            self.texts.append(text)
            self.tags.append(self._tags)
            self.article.append(self._articles if self._article else 0)
            self.furniture.append(self._strong > 0)
            self._line_weak.append(self._inner)
            self._chars += 0 if self._strong else len(text)
            self._tags = 0
        self._parts = []

    def _pop(self) -> None:
        tag, mark, article = self._open.pop()
        self._names[tag] -= 1
        self._strong -= mark == 2
        self._article -= article
        if mark == 1:
            own = self._weak[self._inner]
            own[2] = self._chars
            self._inner = own[0]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self._parts.append(" ")
        mark, article = furniture_mark(tag, attrs), _is_article(tag, attrs)
        if tag in BLOCKS or mark or article:
            self._end_line()
            for closed in CLOSES.get(tag, ("p",)):
                if self._open and self._open[-1][0] == closed:
                    self._pop()
        self._tags += 1
        if tag not in VOID:
            self._open.append((tag, mark, article))
            self._names[tag] = self._names.get(tag, 0) + 1
            self._strong += mark == 2
            if mark == 1:
                self._weak.append([self._inner, self._chars, self._chars, 0])
                self._inner = len(self._weak) - 1
            if article and not self._article:
                self._articles += 1
                if not self._strong:
                    self._weak[self._inner][3] = 1
            self._article += article

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do: the slash means nothing on an HTML element

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if not self._names.get(tag):
            if tag in BLOCKS:
                self._end_line()
            return
        ends = tag in BLOCKS
        at = len(self._open) - 1
        while True:
            name, mark, article = self._open[at]
            ends = ends or mark > 0 or article
            if name == tag:
                break
            at -= 1
        if ends:
            self._end_line()
        while len(self._open) > at:
            self._pop()

    def handle_data(self, data: str) -> None:
        self._parts.append(data)

    def close(self) -> None:
        super().close()
        self._end_line()
        while self._open:
            self._pop()
        # Marks inside first: what holds an article, its surroundings hold as well.
        for around, _, _, holds in reversed(self._weak[1:]):
            self._weak[around][3] |= holds
        covers = [False]
        for around, start, end, holds in self._weak[1:]:
            covers.append(covers[around] or not (holds or end - start > MOST_TEXT * self._chars))
        self.furniture = [f or covers[w] for f, w in zip(self.furniture, self._line_weak, strict=True)]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian mean of every line and its neighbours; lines beyond the ends do not count."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def content_lines(page: Lines) -> np.ndarray:
    """Which lines are content.

    Lines that are not furniture count with their ratio, furniture with 0. Lines whose smoothed ratio reaches a share of the
    largest form clusters, which may bridge a few lines but not the edge of an article element. The cluster with most text
    (weighted by its article) and those not much smaller on its side, in or out of articles, are content; in an article
    the element's other lines are, too.
    """
    chosen = np.zeros(len(page.texts), bool)
    article = np.array(page.article, np.int64)
    allowed = ~np.array(page.furniture, bool)
    if not allowed.any():
        return chosen
    sizes = np.array([len(t) for t in page.texts], float)
    weights = np.where(article > 0, ARTICLE_WEIGHT, 1.0)
    smooth = smoothed(np.where(allowed, sizes / (1 + np.array(page.tags)), 0.0)) * weights
    strong = np.flatnonzero(allowed & (smooth >= THRESHOLD * smooth[allowed].max()))
    if not len(strong):
        return chosen
    apart = (np.diff(strong) > BRIDGE + 1) | (np.diff(article[strong]) != 0)
    clusters = [
        (at[0], at[-1] + 1, article[at[0]], (sizes * weights * allowed)[at[0] : at[-1] + 1].sum())
        for at in np.split(strong, np.flatnonzero(apart) + 1)
    ]
    _, _, best, most = max(clusters, key=lambda c: c[3])
    for start, end, of, mass in clusters:
        if (of > 0) == (best > 0) and mass >= CLUSTER_SHARE * most:
            chosen[start:end] = True
            if of:
                chosen |= article == of
    return chosen & allowed


def main_text(html: str) -> list[str]:
    """The blocks of a page's main text, in page order."""
    page = Lines()
    page.feed(_CUT_TAG.sub("", html))
    page.close()
    return [t for t, content in zip(page.texts, content_lines(page), strict=True) if content]


def extract(pages: DataFrame, *, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns and ``text``: the main text's blocks joined by two line breaks; empty if there is none.

    Null and empty pages, and pages of furniture alone, have an empty text. A page of any length is read whole, in time that
    grows with its length, whatever is left open or closed twice in it; a task holds about ``_GROUP_CHARS`` of pages, or one
    longer page. Repeated rows are extracted each; an empty table gives no rows. One pass without a shuffle; columns not
    in ``keep`` are not read.
    """
    read = fresh(pages, "html_read")
    source = pages.select(*keep, F.col(html).alias(read))
    schema = pages.select(*keep).schema.add("text", "string")

    def texts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in text_groups(batches, read, _GROUP_CHARS):
            texts = ["\n\n".join(main_text(one)) for one in sources]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(keep)], pa.array(texts, pa.string())], names=schema.names
            )

    return source.mapInArrow(texts_of, schema)
