"""Main text of web pages from parser events and smoothed text-to-tag ratios.

The standard library's streaming parser turns a page into lines, one per run of
text between block tags, with the number of characters, tags and linked
characters of each. Lines inside menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments (told by element, role and
class or id names) never become content, unless only a name says so and the
element holds most of the page's text. The remaining lines get a
text-to-tag ratio, a Gaussian smooths the ratios along the page, and a two-means
threshold parts content regions from the rest. On every page the cluster of high
ratios chooses the region. A marked article only closes or clips it: the mark
that holds most of the cluster's text gives the region its ends, and articles
beside a cluster that lies mostly outside of them (teaser cards) are left out.
Without such a mark the cluster is closed over the gaps between its lines and
grows over the headings and siblings next to it, up to the first link of a menu.
Lines of links inside the region belong to it.

Defined cases: null or empty html, and pages without any line, give an empty
text. Unclosed and stray tags are tolerated; an unclosed boilerplate element ends
with its parent. Very deep or long pages are streamed by the parser in pieces.
Repeated rows give equal texts; columns that share a name with a result are
replaced, all others are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickloom.llm.common import clear_of

#: Standard deviation, in lines, of the smoothing window.
SIGMA = 1.0
PIECE = 1 << 16
#: Lines of links at the ends of a region are entries of a menu up to so many words, references beyond.
MENU_WORDS = 4

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style head title template noscript svg math canvas iframe object select textarea button nav header "
    "footer aside form dialog menu audio video map datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul"
    .split()
)
PARAGRAPH_ENDERS = BLOCKS - {"br"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article center details div main section td".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of class and id names of boilerplate. A name is one only as a whole: the rest of its words must be PLAIN.
LAYOUT = frozenset("footer menu modal nav navbar navigation overlay popup sidebar skip toolbar widget".split())
#: Those that an article has of its own: inside of one they are no boilerplate.
OWN = frozenset("header masthead banner notice notices legal copyright".split())
#: Those of text that is not the page's own, however much it is.
FOREIGN = frozenset(
    "ad ads breadcrumb breadcrumbs comment comments commentlist respond cookie cookies consent disqus newsletter "
    "pagination related share sharing social subscribe".split()
)
FOREIGN_STEMS = ("advert", "promo", "sponsor")
PLAIN = frozenset(
    "archive archives area articles author bar block body bottom box btn button buttons canvas categories closed col "
    "column container content count date desktop email facebook fixed float floating form global google group icon "
    "icons info inner instagram item items latest law left link linkedin links list local main media mega message meta "
    "mobile network next off outer page panel popular posts prev previous primary recent reply right row secondary "
    "section sense signup site slot sticky stories sub tab tabs tags text thread title toggle tools top twitter unit "
    "view whatsapp widgets wrap wrapper youtube".split()
)
#: Words that decide by themselves what a name says, whatever stands before them, if only words of layout follow.
HEADS = frozenset("ad ads comment comments commentlist disqus newsletter".split())
HEAD_STEMS = ("advert", "sponsor")
NOTICES = frozenset("notice notices".split())
#: Notices that are a text of their own.
OF_NOTICE = frozenset("legal public copyright".split())
#: Words that say what an element has or lacks, not what it is.
HAVING = frozenset("has have having is no not with without".split())
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
SIZE = re.compile(r"\d+(?:x\d+)?")
#: Words that may stand before others, and then say what the element belongs to.
OF_ARTICLE = frozenset("article entry post story".split())
NAME_PARTS = re.compile(r"[_-]+")
ARTICLE_NAME = re.compile(r"(?:^|\s)(?:article|post|entry|story)[_-]?(?:body|content|text)(?=$|\s)", re.IGNORECASE)
BLANKS = re.compile(r"\s+")


def is_foreign(word: str) -> bool:
    return word in FOREIGN or word.startswith(FOREIGN_STEMS)


def head_of(words: list[str]) -> str:
    """The last word of a name that is not one of layout; "" for names that say what an element has."""
    if HAVING.intersection(words):
        return ""
    for word in reversed(words):
        if word in NOTICES or not (word in PLAIN or word in LAYOUT or word in OWN or SIZE.fullmatch(word)):
            return word
    return ""


@lru_cache(1 << 12)
def named_boilerplate(names: str, in_article: bool) -> str:
    """Whether class or id names say boilerplate: "" (no), "layout" or "foreign"."""
    kind = ""
    for name in names.split():
        words = [w for w in NAME_PARTS.split(CAMEL.sub("-", name).lower()) if w]
        of_article = len(words) > 1 and words[0] in OF_ARTICLE
        words = words[of_article:]
        head = head_of(words)
        if head in HEADS or head.startswith(HEAD_STEMS):
            return "foreign"
        if head in NOTICES and not OF_NOTICE.intersection(words):
            kind = "layout"
        if not all(w in LAYOUT or w in OWN or w in PLAIN or SIZE.fullmatch(w) or is_foreign(w) for w in words):
            continue
        if any(map(is_foreign, words)):
            return "foreign"
        if any(w in LAYOUT or (w in OWN and not in_article and not of_article) for w in words):
            kind = "layout"
    return kind


class Lines(HTMLParser):
    """Collects lines of [text pieces, tags, heading, container], and the lines that elements span.

    A piece is (text, linked, innermost open element with a name of boilerplate, or 0).
    ``spans`` has [first line, line after the last, name, marks an article] of every container and mark.
    ``named`` has [outer one, kind, in an article, characters, of those in an article, holds a main part
    or main heading] of every element with a name of boilerplate; the first stands for the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # name, boilerplate, article, span or -1, outer container, outer element with a name of boilerplate
        self.open: list[tuple[str, bool, bool, int, int, int]] = []
        self.skipping = self.articles = self.links = self.headings = 0
        self.spans: list[list] = []
        self.container = -1
        self.named: list[list] = [[0, "", False, 0, 0, False]]
        self.inside = 0
        self.lines: list[list] = []
        self.line = self.fresh()

    def fresh(self) -> list:
        return [[], 0, False, -1]

    def end_line(self) -> None:
        if self.line[0]:
            self.lines.append(self.line)
        self.line = self.fresh()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
        if tag in PARAGRAPH_ENDERS and any(name == "p" for name, *_ in self.open[-8:]):
            self.leave("p", blocks=False)
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self.leave(tag, blocks=False)
        self.line[1] += 1
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden", "style")}
        names = f"{given.get('class', '')} {given.get('id', '')}"
        main = tag in ("article", "main", "body", "html")
        skips = (
            (tag in SKIPPED and not (tag == "header" and self.articles))
            or given.get("role", "").lower() in ROLES
            or "hidden" in given
            or given.get("aria-hidden") == "true"
            or "display:none" in given.get("style", "").replace(" ", "")
        )
        article = tag in ("article", "main") or given.get("role") == "main" or bool(ARTICLE_NAME.search(names))
        span, outer, inside = -1, self.container, self.inside
        if not self.skipping:
            kind = "" if main or names == " " or (tag == "h1" and self.articles) else named_boilerplate(names, self.articles > 0)
            if kind and not skips:
                self.inside = len(self.named)
                self.named.append([inside, kind, self.articles > 0, 0, 0, False])
            self.named[self.inside][5] |= tag in ("h1", "main")
        if article or tag in CONTAINERS:
            span = len(self.spans)
            self.spans.append([len(self.lines), -1, tag, article])
            if tag in CONTAINERS:
                self.container = span
        self.open.append((tag, skips, article, span, outer, inside))
        self.skipping += skips
        self.articles += article
        self.links += tag == "a"
        self.headings += tag in HEADINGS

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
        self.line[1] += 1

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        self.line[1] += 1
        self.leave(tag, blocks=True)

    def leave(self, tag: str, blocks: bool) -> None:
        """Close the innermost open ``tag`` and what is open inside it; an implied end stays within its block."""
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                end = len(self.lines) + bool(self.line[0])
                for gone, skips, article, span, *_ in self.open[at:]:
                    self.skipping -= skips
                    self.articles -= article
                    self.links -= gone == "a"
                    self.headings -= gone in HEADINGS
                    if span >= 0:
                        self.spans[span][1] = end
                *_, self.container, self.inside = self.open[at]
                del self.open[at:]
                return
            if not blocks and name in BLOCKS and name != "p":
                return

    def handle_data(self, data):
        if self.skipping:
            return
        if self.line[0] or not data.isspace():
            self.line[0].append((data, self.links > 0, self.inside))
            self.line[2] |= self.headings > 0
            self.line[3] = self.container
            if self.inside or not data.isspace():
                n = len(data.strip())
                self.named[self.inside][3] += n
                self.named[self.inside][4] += n * (self.articles > 0)

    def dropped(self) -> list[bool]:
        """Of every element with a name of boilerplate: whether its text is left out.

        It is not if it holds most of the page's text and also the main heading, or, unless its name is that of
        foreign text, if it lies in the article or no article lies beside it.
        """
        for outer, _, _, n, in_article, marked in self.named[:0:-1]:
            self.named[outer][3] += n
            self.named[outer][4] += in_article
            self.named[outer][5] |= marked
        _, _, _, total, total_in_article, _ = self.named[0]
        out = [False]
        for outer, kind, within, n, in_article, marked in self.named[1:]:
            fits = marked or (kind == "layout" and (within or in_article == total_in_article))
            out.append(out[outer] or not (2 * n > total and fits))
        return out


def smoothed(values: np.ndarray) -> np.ndarray:
    radius = int(3 * SIGMA) or 1
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / SIGMA) ** 2)
    kernel /= kernel.sum()
    return np.convolve(np.pad(values, radius, mode="edge"), kernel, mode="valid")


def threshold(values: np.ndarray) -> float:
    """Between the centres of two clusters of the values."""
    low, high = values.min(), values.max()
    for _ in range(32):
        middle = (low + high) / 2
        upper = values > middle
        if not upper.any() or upper.all():
            return low - 1.0
        new_low, new_high = values[~upper].mean(), values[upper].mean()
        if new_low == low and new_high == high:
            break
        low, high = new_low, new_high
    # Clusters that lie close together are one: all of it is content.
    return (low + high) / 2 if high > 4 * max(low, 1.0) else low - 1.0


def region(
    core: np.ndarray, texts: list[str], linked: list[bool], headings: list[bool], homes: list[int], spans: list[tuple]
) -> np.ndarray:
    """Which lines the main text has, from the cluster of high ratios ``core``.

    ``spans`` are (first, after, name, marks an article) of elements, outer ones before inner ones.
    """
    held = np.concatenate([[0], np.cumsum(np.where(core, [len(t) for t in texts], 0))])
    most = held[-1] / 2
    marks = [(x, y, tag) for x, y, tag, mark in spans if mark and held[y] - held[x] > most]
    articles = [m for m in marks if m[2] == "article"]
    scope = articles[-1] if articles else marks[0] if marks else (0, len(texts), "")
    cards = np.zeros(len(texts), dtype=bool)
    if scope[2] != "article":
        reach = 0
        for x, y, tag, _ in spans:
            if tag == "article" and scope[0] <= x and reach < y <= scope[1]:
                cards[x:y] = True
                reach = y
        if np.diff(held)[cards].sum() >= most:  # a page of several articles
            cards[:] = False
    kept = np.zeros(len(texts), dtype=bool)
    if marks:
        kept[scope[0] : scope[1]] = True
        return kept & ~cards
    core = core & ~cards
    menu = [link and len(t.split()) <= MENU_WORDS for t, link in zip(texts, linked, strict=True)]
    found = [k for k in np.flatnonzero(core).tolist() if not menu[k]]
    if not found:
        return kept
    low, high = found[0], found[-1] + 1
    near = {homes[k] for k in found}
    # The innermost element around the cluster, if the page has lines beside it.
    around = [(x, y) for x, y, *_ in spans if x <= low and high <= y and y - x < len(texts)]
    start, end = around[-1] if around else (0, len(texts))

    def joins(k: int) -> bool:
        if menu[k] or cards[k]:
            return False
        return bool(around) or headings[k] or (homes[k] in near and not linked[k])

    while low > start and joins(low - 1):
        low -= 1
    while high < end and joins(high):
        high += 1
    kept[low:high] = True  # short lines between content lines belong to it
    reach = 0
    for x, y, _, mark in spans:
        if mark and reach < y:
            reach = y
            if core[x:y].any():  # what one of several marks holds is taken whole
                kept[x:y] = True
    return kept & ~cards


def main_text(html: str | None) -> str:
    """The main text of one page: its content lines in order, joined by one space."""
    if not html:
        return ""
    parser = Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    parser.close()
    parser.end_line()
    texts, ratios, linked, headings, homes, places = [], [], [], [], [], []
    dropped = parser.dropped()
    for place, (pieces, tags, heading, home) in enumerate(parser.lines):
        pieces = [piece for piece in pieces if not dropped[piece[2]]]
        text = BLANKS.sub(" ", "".join(data for data, *_ in pieces)).strip()
        if text:
            texts.append(text)
            ratios.append(len(text) / max(1, tags))
            linked.append(2 * sum(len(data.strip()) for data, link, _ in pieces if link) > len(text))
            headings.append(heading)
            homes.append(home)
            places.append(place)
    if not texts:
        return ""
    smooth = smoothed(np.array(ratios))
    core = smooth > threshold(smooth)
    ends = [end if end >= 0 else len(parser.lines) for _, end, *_ in parser.spans]
    first = np.searchsorted(places, [span[0] for span in parser.spans]).tolist()
    after = np.searchsorted(places, ends).tolist()
    spans = [(x, y, tag, mark) for x, y, (*_, tag, mark) in zip(first, after, parser.spans, strict=True) if x < y]
    kept = region(core, texts, linked, headings, homes, spans)
    return " ".join(t for t, keep in zip(texts, kept.tolist(), strict=True) if keep)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with the main text and its code points."""
    import pyarrow as pa

    held = clear_of(pages, "text", "n_chars") if html not in ("text", "n_chars") else pages
    fields = [f for f in held.schema.fields if f.name != html]
    schema = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])
    names = [f.name for f in fields]

    def run(found: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for whole in found:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [main_text(x.as_py()) for x in batch.column(html)]
                rest = [batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[*names, "text", "n_chars"],
                )

    return held.select(*names, html).mapInArrow(run, schema)
