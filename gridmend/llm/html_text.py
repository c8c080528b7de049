"""The main text of web pages: text-to-tag ratios by line, smoothed and clustered by a threshold.

One pass of the standard library's parser turns a page into lines, the texts of its blocks, with the tags and
linked characters of each and the elements around it. The ratio of text to tags, smoothed over neighbouring
lines, parts content from the rest at the threshold that separates the two classes best. Content lines vote
for their containers, and a chosen container gives all its lines that are not boilerplate themselves, so
short lines of an article are not lost.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.shipping import ship

VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements that never hold text of the article, whatever their names.
DROPPED = frozenset(
    "head title script style noscript template svg math canvas iframe object audio video map nav aside form button select "
    "datalist textarea input dialog menu footer".split()
)
#: Elements that end a line at either tag.
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table caption tbody thead tfoot tr ul head title "
    "script style noscript template iframe object audio video select textarea button legend search".split()
)
#: Elements that a region may be.
CONTAINERS = frozenset("html body article main section div td center blockquote".split())
ARTICLES = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: Start tags that end an open element: the element closed, and the elements that keep it open.
PARAGRAPH_ENDS = BLOCKS - frozenset(["html", "body", "head", "title", "script", "style", "noscript", "template", "iframe", "object", "audio", "video", "select", "textarea", "button"])
SIBLINGS = {
    "li": (["li"], frozenset(["ul", "ol", "menu"])), "dt": (["dt", "dd"], frozenset(["dl"])), "dd": (["dt", "dd"], frozenset(["dl"])),
    "tr": (["tr", "td", "th"], frozenset(["table", "tbody", "thead", "tfoot"])), "td": (["td", "th"], frozenset(["tr", "table"])),
    "th": (["td", "th"], frozenset(["tr", "table"])), "option": (["option"], frozenset(["select"])),
}
#: Words of class, id and role that name what is not the article.
BOILERPLATE = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promotion promoted banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sitemap skip header masthead topbar footer "
    "colophon copyright legal sidebar side aside rail widget widgets related recommended recommendations recirc trending popular "
    "teaser notice notices alert cookie cookies consent gdpr privacy disclaimer popup modal overlay lightbox toast paywall "
    "newsletter subscribe subscription signup login share sharing social comment comments commentlist disqus respond replies "
    "reply responses discussion feedback complementary contentinfo search form hidden".split()
)
#: Words that name the article itself; on one element they outweigh those of TITLE_WORDS, as in ``entry-header``.
ARTICLE_WORDS = frozenset("article articlebody post postbody entry story".split())
TITLE_WORDS = frozenset(["header", "masthead"])
#: Words that say what a page's layout has, not what the element is.
LAYOUT_WORDS = frozenset("has with no without wrapper layout grid row container".split())
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
SPACE = re.compile(r"\s+")
#: Standard deviation, in lines, of the Gaussian that smooths the ratios, and where its kernel ends.
SIGMA, REACH = 1.0, 3
#: Share of the content's text that a region holds at least where no element is named the article.
REGION_SHARE = 0.9
MENU_LINES, LINKED = 3, 0.8
BATCH_BYTES = 8 << 20


class Line(NamedTuple):
    text: str
    tags: int
    linked: int  # characters of the text within links
    path: tuple[int, ...]  # the containers around it, outermost first
    article: int  # the innermost article or main element around it, 0 if none
    heading: bool


class _Lines(HTMLParser):
    """Collects the lines of a page that are not within boilerplate."""

    def __init__(self, by_name: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.kinds = [""]  # tags of the containers by number
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, int]] = []  # tag, whether it starts boilerplate, container number
        self.depth = Counter()  # open elements by tag
        self.dropped = 0  # open elements that start boilerplate
        self.links = 0
        self.path: list[int] = []
        self.articles: list[int] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            heading = any(self.depth[h] for h in HEADINGS)
            article = self.articles[-1] if self.articles else 0
            self.lines.append(Line(text, self.tags + 1, min(self.linked, len(text)), tuple(self.path), article, heading))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in PARAGRAPH_ENDS and self.depth["p"]:
            self.close_element("p", frozenset(["table", "td", "button"]))
        if tag in SIBLINGS:
            closed, within = SIBLINGS[tag]
            for other in closed:
                if self.depth[other]:
                    self.close_element(other, within)
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "wbr", "hr", "img"):
                self.parts.append(" " if tag != "wbr" else "")
            return
        if tag in ("td", "th"):
            self.parts.append(" ")
        drops = (tag in DROPPED and (self.by_name or tag != "form")) or (tag == "header" and not self.articles) or _hidden(attrs)
        drops = drops or (self.by_name and _boilerplate(tag, attrs, bool(self.articles)))
        container = 0
        if tag in CONTAINERS:
            container = len(self.kinds)
            self.kinds.append(tag)
            self.path.append(container)
            if _is_article(tag, attrs) and not self.dropped:
                self.articles.append(container)
        self.open.append((tag, drops, container))
        self.depth[tag] += 1
        self.dropped += drops
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # only void elements close themselves in HTML

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in ("br", "p") and not self.depth[tag]:
            self.parts.append(" ")
        if tag in BLOCKS:
            self.end_line()
        if self.depth[tag]:
            self.close_element(tag, frozenset())

    def close_element(self, tag: str, within: frozenset[str]) -> None:
        """Close the innermost open ``tag`` and all in it, unless one of ``within`` is nearer."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                break
            if self.open[at][0] in within:
                return
        else:
            return
        if tag in BLOCKS or any(t in BLOCKS for t, _, _ in self.open[at:]):
            self.end_line()
        for name, drops, container in reversed(self.open[at:]):
            self.depth[name] -= 1
            self.dropped -= drops
            self.links -= name == "a"
            if container:
                self.path.pop()
                if self.articles and self.articles[-1] == container:
                    self.articles.pop()
        del self.open[at:]

    def handle_data(self, data: str) -> None:
        if self.dropped:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)


def _names(attrs: list[tuple[str, str | None]], keys: tuple[str, ...]) -> set[str]:
    return {w.lower() for key, value in attrs if key in keys and value for w in WORDS.findall(value)}


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    given = dict(attrs)
    style = given.get("style") or ""
    return "hidden" in given or given.get("aria-hidden") == "true" or ("none" in style and bool(re.search(r"display\s*:\s*none", style)))


def _boilerplate(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element's names say that it is not the article, such as ``cookie-notice`` but not ``has-sidebar``.

    A header in an article, or named as an article's, is its title.
    """
    if not attrs or tag in ("html", "body", "main"):
        return False
    names = _names(attrs, ("class", "id", "role"))
    if not names & BOILERPLATE or names & LAYOUT_WORDS:
        return False
    return bool(names & BOILERPLATE - TITLE_WORDS) or not (in_article or names & ARTICLE_WORDS)


def _is_article(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    given = dict(attrs)
    return tag in ARTICLES or given.get("role") in ("main", "article") or (given.get("itemprop") or "").lower() == "articlebody"


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """The ratios under a Gaussian over neighbouring lines; at the ends over the lines that there are."""
    at = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(at**2) / (2 * SIGMA**2))
    mass = np.convolve(np.ones(len(ratios)), kernel)[REACH : REACH + len(ratios)]
    return np.convolve(ratios, kernel)[REACH : REACH + len(ratios)] / mass


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters with the least spread within them; the smallest value where all are alike."""
    ordered = np.sort(values)
    if ordered[0] == ordered[-1]:
        return float(ordered[0])
    n = np.arange(1, len(ordered))
    sums = np.cumsum(ordered)
    low, high = sums[:-1] / n, (sums[-1] - sums[:-1]) / (len(ordered) - n)
    between = np.where(ordered[1:] > ordered[:-1], n * (len(ordered) - n) * (high - low) ** 2, -1.0)
    return float(ordered[between.argmax() + 1])


def _menus(lines: list[Line]) -> list[bool]:
    """Whether a line belongs to a run of ``MENU_LINES`` or more lines that are almost all link."""
    linked = [line.linked >= LINKED * len(line.text) for line in lines]
    menus, start = [False] * len(lines), 0
    for i in range(len(lines) + 1):
        if i < len(lines) and linked[i]:
            continue
        if i - start >= MENU_LINES:
            menus[start:i] = [True] * (i - start)
        start = i + 1
    return menus


def _region(lines: list[Line], content: np.ndarray) -> int:
    """The innermost container with ``REGION_SHARE`` of the content's text."""
    held = Counter()
    for line, chosen in zip(lines, content):
        if chosen:
            held.update(dict.fromkeys(line.path, len(line.text)))
    whole = sum(len(line.text) for line, chosen in zip(lines, content) if chosen)
    enough = [c for c, n in held.items() if n >= REGION_SHARE * whole]
    return max(enough, default=0)  # numbers grow inwards along a path


def _parsed(html: str, by_name: bool = True) -> _Lines:
    parser = _Lines(by_name)
    parser.feed(html)
    if parser.rawdata.startswith("<!--") or ("<" in parser.rawdata and ">" not in parser.rawdata):
        parser.rawdata = ""  # a comment or tag that the page's end cuts off
    parser.close()
    parser.end_line()
    return parser


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by a line feed; empty for NULL, empty and textless pages."""
    if not html:
        return ""
    parser = _parsed(html)
    if not parser.lines:  # a form, or a name such as "sidebar", around the whole article
        parser = _parsed(html, by_name=False)
        parser.lines = [line for line in parser.lines if line.article]
    lines = [line for line, menu in zip(parser.lines, _menus(parser.lines)) if not menu]
    if not lines:
        return ""
    named = [line for line in lines if line.article]
    scope = named or lines
    ratios = np.array([(len(line.text) - line.linked) / line.tags for line in scope])
    values = smoothed(ratios)
    content = values >= threshold(values)
    if named:
        chosen = {line.article for line, c in zip(scope, content) if c}
        inside = [line for line in scope if line.article in chosen or chosen & set(line.path)]
    else:
        region = _region(scope, content)
        within = [not region or region in line.path for line in scope]
        first, last = int(content.argmax()), len(content) - 1 - int(content[::-1].argmax())
        while first and scope[first - 1].heading:
            first -= 1
        narrow = parser.kinds[region] in ("", "html", "body")  # the page itself: no lines before or after the content
        inside = [line for i, line in enumerate(scope) if within[i] and (not narrow or first <= i <= last)]
    return "\n".join(line.text for line in inside)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts: list[str] = []
        size = start = 0
        for i in range(batch.num_rows):
            texts.append(main_text(batch.column("html")[i].as_py()))
            size += len(texts[-1])
            if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                keys = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [keys.column("page_id"), keys.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )
                texts, size, start = [], 0, i + 1


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, NULL keys kept; no shuffle, each page for itself.

    NULL, empty and textless pages give an empty text. Repeated rows are answered each. Other columns are not
    read. Long pages are parsed whole, in time proportional to their length.
    """
    ship(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
