"""Main text of web pages by tag-path ratios.

A page is read into text blocks: stretches of text between the tags of block elements, each with its root-to-leaf tag path, which carries the class of an element
beside its name. Character references are decoded and white space in a block becomes one space.

1. What is never the article is left out with all that is in it: head, scripts, styles, forms, menus, footers, asides, hidden elements, elements whose role,
   class or id names a menu, sidebar, notice, advert or the comments of readers. A header is left out too, but for headings inside an article.
2. For each path, the characters and the punctuation marks of all its blocks are added up and divided by their number: the two tag-path ratios. Each block takes
   the ratios of its path; both sequences are smoothed by a Gaussian over neighbouring blocks and fused by their geometric mean.
   Text in links counts against a block.
3. Blocks whose fused ratio reaches ``SHARE`` of the standard deviation, or of the greatest if that is less, are content nodes.
4. The main text is that of the element that holds them: of the ``main`` or ``article`` element with the most fused content if there is one, else of the deepest element with
   ``MOST`` of the content nodes' characters. All its blocks are taken, short ones too, as they are part of the article, but lists that consist of links.
   If no element but the body holds the content nodes, the blocks between the first and the last of them are taken that are content nodes themselves or headings,
   or have a path that a content node has.

Pages are worked on one by one in Arrow slices of bounded size, and no page depends on another, so nothing is shuffled.

Defined results: null and empty pages, and pages without text, give the empty text; broken markup (missing end tags, unclosed
comments, a bare ``<``) is read as browsers do as far as the rules here go; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Collection, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty

# Element names of HTML, by how they bear on text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset(
    "head script style noscript template nav menu footer aside form search button select textarea input option datalist dialog iframe object embed "
    "applet canvas svg audio video map noembed noframes title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

# Parts of class names and ids of what is not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot banner banners sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars rail footer masthead topbar toolbar pagination pager "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay lightbox paywall newsletter subscribe "
    "subscription signup login signin register search searchbox form comment comments commentlist disqus respond reply replies discussion "
    "share sharing sharebar social socials follow related recommended recommendations widget widgets copyright skip skiplink outbrain taboola".split())

# Which open elements the start of another one ends, up to the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}

HOLDERS = frozenset("html body div section td center dd".split())
TABLE_ENDS = frozenset("table tr tbody thead tfoot html body article main div section".split())

#: A comment, declaration, or tag with its attributes, whose quoted values may hold angle brackets; a tag with a quote left open ends at the first one.
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)|([^>]*))>|</[^>]*>", re.S)
LOST = re.compile(r"<[a-zA-Z/!?]")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
MARKS = re.compile(r"[.,;:!?…，。；：！？、]")

#: Share of the standard deviation a fused ratio must reach, weight of neighbours by distance, and share of content an element must hold.
SHARE, SPREAD, REACH, MOST = 0.5, 1.0, 2, 0.8

WEIGHTS = np.array([math.exp(-(i * i) / (2 * SPREAD * SPREAD)) for i in range(-REACH, REACH + 1)])

#: What holds for an element and all in it: never the article; a link; a heading; an article; a header in an article.
NO, LINK, HEADING, ARTICLE, HEADER = 1, 2, 4, 8, 16
KINDS = dict.fromkeys(NEVER, NO) | {"a": LINK, "article": ARTICLE, "main": ARTICLE} | dict.fromkeys(HEADINGS, HEADING)


class Page:
    """Elements and text blocks of a page."""

    def __init__(self, markup: str):
        #: for each element: its parent, depth, name, and the number of its tag path
        self.parent, self.depth, self.name, self.path = [0], [0], ["#root"], [0]
        #: what it, or one around it, is: the flags from ``NO`` to ``HEADER``
        self.kind = [0]
        #: whether its own names say that it is not the article
        self.named = [False]
        #: for each block: its element, text, and characters in links
        self.at: list[int] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self._open = [0]
        #: how many elements of each name are open, so that no end tag looks in vain
        self._count: defaultdict[str, int] = defaultdict(int)
        self._parts: list[str] = []
        self._links: list[str] = []
        self._owner = -1
        self._paths: dict[tuple[int, str], int] = {}
        self._read(markup)

    def _flush(self) -> None:
        if not self._parts:
            return
        if self._owner >= 0:
            text = " ".join("".join(self._parts).split())
            self.at.append(self._owner)
            self.text.append(text)
            self.linked.append(min(len(text), len(" ".join("".join(self._links).split()))) if self._links else 0)
        self._parts, self._links, self._owner = [], [], -1

    def _add(self, raw: str) -> None:
        decoded = html.unescape(raw) if "&" in raw else raw
        here = self._open[-1]
        if self._owner < 0 and decoded and not decoded.isspace():
            self._owner = here
        self._parts.append(decoded)
        if self.kind[here] & LINK:
            self._links.append(decoded)

    def _close_to(self, depth: int) -> None:
        for e in self._open[depth:]:
            if self.name[e] in BLOCK:
                self._flush()
                break
        for e in self._open[depth:]:
            self._count[self.name[e]] -= 1
        del self._open[depth:]

    def _close_first(self, names: Collection[str], limits: Collection[str]) -> None:
        """End the outermost open element of ``names`` that is inside the innermost of ``limits``."""
        for name in names:
            if self._count[name]:
                break
        else:
            return
        found = None
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.name[self._open[depth]]
            if name in limits:
                break
            if name in names:
                found = depth
        if found is not None:
            self._close_to(found)

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            if name != "table":
                self._close_first(("p",), ("button", "td", "th", "table"))
            if name in CLOSES:
                self._close_first(*CLOSES[name])
            self._flush()
        elif name == "br":
            self._parts.append(" ")
        if name in VOID:
            return
        around = self._open[-1]
        kind, named, label, header = self.kind[around] | KINDS.get(name, 0), False, name, name == "header"
        in_article = self.kind[around] & ARTICLE
        if "=" in attributes or "hidden" in attributes:
            given: dict[str, str] = {}
            for key, double, single, bare in ATTRIBUTE.findall(attributes):
                given.setdefault(key.lower(), html.unescape(double or single or bare))
            classes = given.get("class", "")
            words = {w.lower() for w in PART.findall(classes + " " + given.get("id", ""))}
            label = ".".join([name, *sorted(classes.split())])
            header = header or "header" in words and name not in HEADINGS
            named = not words.isdisjoint(NAMES) or header and not in_article
            if (given.get("role", "").lower() in ROLES or "hidden" in given or given.get("aria-hidden", "").lower() == "true"
                    or HIDDEN.search(given.get("style", ""))):
                kind |= NO
        self._open.append(len(self.name))
        self._count[name] += 1
        self.parent.append(around)
        self.depth.append(self.depth[around] + 1)
        self.name.append(name)
        self.path.append(self._paths.setdefault((self.path[around], label), len(self.name)))
        if header:
            kind |= HEADER if in_article else NO if name == "header" else 0
        self.kind.append(kind)
        self.named.append(named)

    def _end(self, name: str) -> None:
        if name == "br":
            self._parts.append(" ")
        if not self._count[name]:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            here = self.name[self._open[depth]]
            if here == name:
                self._close_to(depth)
                return
            # An inline end tag does not end blocks around it, and few end a table.
            if name not in BLOCK and here in BLOCK or here in ("table", "td", "th") and name not in TABLE_ENDS:
                return

    def _read(self, markup: str) -> None:
        at, last = 0, markup.rfind(">")
        while at <= last and (token := TOKEN.search(markup, at)):
            if token.start() > at:
                self._add(markup[at:token.start()])
            at = token.end()
            if token[2]:
                name = token[2].lower()
                if token[1]:
                    self._end(name)
                else:
                    self._start(name, token[3] or token[4] or "")
                    if name in RAW:
                        at = re.compile(rf"</{re.escape(name)}(?=[\s/>])|\Z", re.I).search(markup, at).start()
        # A tag that never ends is none, and no text either.
        self._add(LOST.split(markup[at:], maxsplit=1)[0])
        self._close_to(1)
        self._flush()

    def sums(self, blocks: Iterable[int], sizes: Sequence[float]) -> list[float]:
        """For each element, the sum over the ``blocks`` in it of their ``sizes``."""
        total = [0.0] * len(self.name)
        for block, size in zip(blocks, sizes, strict=True):
            total[self.at[block]] += size
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def kept(self) -> list[int]:
        """The blocks that may be the article: not in an element that is left out."""
        blocks = [b for b, e in enumerate(self.at) if not self.kind[e] & NO and self.kind[e] & (HEADING | HEADER) != HEADER]
        if not any(self.named):
            return blocks
        size = self.sums(blocks, [len(self.text[b]) for b in blocks])
        holds = [name in ("article", "main", "body") for name in self.name]
        for e in range(len(holds) - 1, 0, -1):
            holds[self.parent[e]] |= holds[e]
        out = [False] * len(self.name)
        for e in range(1, len(out)):
            # A name says nothing on an element that holds the article, or nearly all of the page.
            own = self.named[e] and size[e] < 0.9 * size[0] and (not holds[e] or self.name[e] == "article")
            out[e] = own or out[self.parent[e]]
        return [b for b in blocks if not out[self.at[b]]]


def smoothed(values: np.ndarray) -> np.ndarray:
    """Each value with its neighbours; at the ends of the page with those there are."""
    weight = np.convolve(np.ones(len(values)), WEIGHTS)[REACH:-REACH]
    return np.convolve(values, WEIGHTS)[REACH:-REACH] / weight


def fused_ratios(page: Page, blocks: list[int]) -> np.ndarray:
    """The smoothed and fused tag-path ratios of the blocks."""
    paths = [page.path[page.at[b]] for b in blocks]
    number, chars, marks = Counter(paths), defaultdict(float), defaultdict(float)
    for path, b in zip(paths, blocks, strict=True):
        size, linked = len(page.text[b]), page.linked[b]
        chars[path] += size - linked
        marks[path] += len(MARKS.findall(page.text[b])) * (1 - linked / size)
    text = smoothed(np.array([chars[p] / number[p] for p in paths]))
    punctuation = smoothed(np.array([marks[p] / number[p] for p in paths]))
    return np.sqrt(text * (1 + punctuation))


def content_nodes(fused: np.ndarray) -> list[bool]:
    found = (fused >= SHARE * min(fused.std(), fused.max())) & (fused > 0)
    return (found | ~found.any()).tolist()


def without_link_lists(page: Page, blocks: list[int]) -> list[int]:
    """The blocks but those of lists whose text is nearly all in links."""
    if not any(page.linked[b] for b in blocks):
        return blocks
    size, linked = page.sums(blocks, [len(page.text[b]) for b in blocks]), page.sums(blocks, [page.linked[b] for b in blocks])
    out = [False] * len(size)
    for e in range(1, len(out)):
        out[e] = out[page.parent[e]] or page.name[e] in ("ul", "ol", "dl") and linked[e] >= 0.9 * size[e]
    return [b for b in blocks if not out[page.at[b]]]


def main_text(markup: str) -> str:
    """The main text of a page, blocks joined by line breaks."""
    page = Page(markup)
    blocks = without_link_lists(page, page.kept())
    if not blocks:
        return ""
    fused = fused_ratios(page, blocks)
    chosen = content_nodes(fused)
    content = page.sums(blocks, [len(page.text[b]) if good else 0 for b, good in zip(blocks, chosen, strict=True)])
    holders = [e for e, name in enumerate(page.name) if name in ("main", "article") and content[e]]
    if holders:
        # The one with the most content; of one inside another with about as much, the inner.
        enough = MOST * max(content[e] for e in holders)
    else:
        # A single paragraph is no place that an article is in.
        number = page.sums(blocks, [1] * len(blocks))
        holders, enough = [e for e, name in enumerate(page.name) if not e or number[e] > 1 and name in HOLDERS], MOST * content[0]
    whole = max((e for e in holders if content[e] >= enough), key=lambda e: (page.depth[e], content[e], -e))
    if page.name[whole] not in ("#root", "html", "body"):
        inside = [False] * len(page.name)
        for e in range(whole, len(inside)):
            inside[e] = e == whole or inside[page.parent[e]]
        return "\n".join(page.text[b] for b in blocks if inside[page.at[b]])
    paths = {page.path[page.at[b]] for b, good in zip(blocks, chosen, strict=True) if good}
    places = [i for i, good in enumerate(chosen) if good]
    first, last = places[0], places[-1]
    return "\n".join(
        page.text[b] for i, b in enumerate(blocks)
        if chosen[i] or i <= last and (page.kind[page.at[b]] & HEADING or i >= first and page.path[page.at[b]] in paths))


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [main_text(markup) for markup in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    ship_package(pages.sparkSession)
    pages = pages.select(F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                         text_or_empty(html_column).alias("html"))
    return pages.mapInArrow(run, "page_id bigint, url string, text string")
