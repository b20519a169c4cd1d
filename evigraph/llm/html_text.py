"""The main text of web pages, from streaming parser events and smoothed text-to-tag ratios.

The standard library's parser is fed piece by piece. Its events make lines: a line is what stands
between two block tags, with the number of tags since the line before. What is no text to read by
its very tag (scripts, styles, menus, asides, forms' fields, a page's header and footer) is set aside.

Every other line has a text-to-tag ratio, larger by ``VOUCHED`` in an article or main element and
smaller by ``MARKED`` where a class or id tells against an element. The ratios are smoothed by a
Gaussian and parted into two clusters, and lines of the upper one are content, as are lines whose own
ratio is like theirs. A region is the smallest element
that holds all content: from the whole page down, an element is left for a child only if all content lies in
it, down to an article or main element, and one that shares it out among articles is left for all of these;
headings and paragraphs of its own go along. What stands in a region makes the text, short lines too, but for the
parts that a class or id tells against: comments, forms and adverts whatever their length, others if less
than half of their text is content by its own ratio.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

PIECE = 1 << 16
SIGMA = 1.0
#: How much more the ratio of a line in an article or main element counts, and how much less one's where a class or id tells against it.
VOUCHED, MARKED = 8.0, 0.05
#: A line is content by itself if its own ratio is such a share of the mean of the upper cluster's lines.
ALIKE = 0.5
RESULT = "text string, n_chars long, n_lines int, region string"

REGION = frozenset("article main section div td body html form".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()) | frozenset(
    "math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
SKIPPED = frozenset("script style noscript template head title nav footer aside button select option textarea input iframe object svg canvas audio video map dialog menu menuitem noframes".split())
#: How much tells against an element: a name that may be a section's too, what is no article's text, readers' comments.
DOUBT, FOREIGN, COMMENTS = 1, 2, 3
#: Fields of a form go; a form itself may be a page's wrapper and is only told against.
AGAINST = {"form": FOREIGN, "label": DOUBT}
#: Blocks of an element's own that go along with a region in it.
ALONG = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre header hgroup".split())
ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar status".split())
#: Words of a class or id that tell against an element.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsored sponsors promo promos promotion promoted"
    " nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside footer foot topbar masthead toolbar pagination pager pagenav"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall disclaimer"
    " comment comments commentlist respond reply replies disqus discussion feedback share sharing social related recommended recommendations widget widgets skip search form".split()
)
READERS = frozenset("comment comments commentlist respond reply replies disqus".split())
BOUGHT = frozenset("ad ads adv advert adverts advertisement advertising advertisements adsense adsbygoogle sponsor sponsored sponsors promo promos promotion promoted cookie cookies consent gdpr newsletter subscribe subscription paywall".split())
#: Words that may stand beside these in a name, as in reader-comments; with any other word, as in has-sidebar, a name says nothing.
HELPERS = frozenset("a all area bar banner block bottom box button buttons container content count foot global head header icon icons info inner item items left line link links list main module my outer page panel post primary reader row secondary section site top user users web wrap wrapper right slot text thread top unit zone".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body article main section div td th blockquote".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


class Lines(HTMLParser):
    """Collects the elements of a page, and (text, tags before it, elements it stands in) of each line.

    An element is [tag, parent, set aside, how much tells against it, vouched for, closed by its own end tag, inside an article or main].
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        self.elements: list[list] = []
        self.open: list[int] = []
        self.now: list[str] = []
        self.tags = 0

    def line(self) -> None:
        if self.now:
            text = " ".join("".join(self.now).split())
            self.now = []
            if text:
                self.lines.append((text, self.tags, tuple(self.open)))
                self.tags = 0

    def tag(self, at: int) -> str:
        return self.elements[self.open[at]][0]

    def pop(self, at: int) -> None:
        if any(self.tag(i) not in INLINE for i in range(at, len(self.open))):
            self.line()
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.now.append(" ")
            return
        if tag in CLOSES_P:
            for at in range(len(self.open) - 1, -1, -1):
                if self.tag(at) == "p":
                    self.pop(at)
                    break
                if self.tag(at) in SCOPES:
                    break
        for at in range(len(self.open) - 1, -1, -1) if tag in CLOSES_OWN else ():
            if self.tag(at) in CLOSES_OWN[tag]:
                self.pop(at)
                break
            if self.tag(at) in ("ul", "ol", "dl", "table", "select"):
                break
        if tag not in INLINE:
            self.line()
        if tag in VOID:
            return
        parent = self.open[-1] if self.open else -1
        inside = parent >= 0 and self.elements[parent][6]
        role = next((v.lower() for n, v in attrs if n == "role" and v), "")
        aside = tag in SKIPPED or role in ROLES or (tag == "header" or role == "banner") and not inside
        against = 0 if aside else max(AGAINST.get(tag, 0), 0 if tag in ("html", "body", "main") else marked(attrs))
        vouched = tag in ("article", "main") and not against
        self.open.append(len(self.elements))
        self.elements.append([tag, parent, aside, against, vouched, False, inside or vouched])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        for at in range(len(self.open) - 1, -1, -1):
            if self.tag(at) == tag:
                self.elements[self.open[at]][5] = True
                self.pop(at)
                return
        if tag == "p":  # ends a line even if none is open
            self.line()

    def handle_data(self, data):
        self.now.append(data)


def marked(attrs: list) -> int:
    """How much a class or id tells against an element: a name counts of which every word is in MARKS or HELPERS, one at least in MARKS."""
    most = 0
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.split():
                words = {w.lower() for w in _WORDS.findall(token)}
                if words & MARKS and words <= MARKS | HELPERS:
                    most = max(most, COMMENTS if words & READERS else FOREIGN if words & BOUGHT else DOUBT)
    return most


def smoothed(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over three sigma on either side, weighted anew at the ends."""
    r = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(x, kernel)[r : r + len(x)] / np.convolve(np.ones(len(x)), kernel)[r : r + len(x)]


def threshold(x: np.ndarray) -> float:
    """Where two clusters of numbers part: halfway between their means, found by 2-means from the extremes."""
    low, high = float(x.min()), float(x.max())
    for _ in range(50):
        mid = (low + high) / 2
        below, above = x[x < mid], x[x >= mid]
        if not len(below) or not len(above):
            return mid
        if (float(below.mean()), float(above.mean())) == (low, high):
            break
        low, high = float(below.mean()), float(above.mean())
    return (low + high) / 2


def content(lines: list, elements: list) -> tuple[list, np.ndarray, set[int]]:
    """The lines that are not set aside; their weighed lengths, 0 for those that are no content by their smoothed ratios; the elements told against that go.

    An element told against that holds an article or main element is not told against, nor, on a page
    without such an element, one that holds most of the text, comments excepted. Comments go if
    anything else is left, and so do forms and adverts. An element that was set aside by its tag but never closed is
    only told against.
    """
    aside = {i for i, e in enumerate(elements) if e[2] and e[5]}
    lines = [x for x in lines if not aside.intersection(x[2])]
    doubted = {i: e[3] or DOUBT for i, e in enumerate(elements) if e[3] or e[2] and not e[5]}
    for i, e in enumerate(elements):
        if e[4] and doubted:
            while i >= 0:
                doubted.pop(i, None)
                i = elements[i][1]
    article = any(elements[i][4] for x in lines if doubted.keys().isdisjoint(x[2]) for i in x[2])
    if not article:
        held = _held(lines, doubted)
        doubted = {i: d for i, d in doubted.items() if d == COMMENTS or 2 * held[i] <= sum(len(x[0]) for x in lines)}
    if all(not doubted.keys().isdisjoint(x[2]) for x in lines):  # nothing but what is told against, or nothing at all
        return [], np.zeros(0), set()
    gone = {i for i, d in doubted.items() if d >= FOREIGN}
    lines = [x for x in lines if gone.isdisjoint(x[2])]
    doubted = doubted.keys() - gone
    held = _held(lines, doubted)
    vouched = np.array([any(elements[i][4] for i in x[2]) for x in lines])
    mass = np.array([len(x[0]) * (MARKED if doubted.intersection(x[2]) else 1.0) for x in lines]) * np.where(vouched, VOUCHED, 1.0)
    own = mass / np.array([1 + x[1] for x in lines])
    ratio = smoothed(own)
    least = threshold(ratio)
    taken = np.where([doubted.isdisjoint(x[2]) for x in lines], ratio, own) >= least  # what is told against is not lifted by what is near
    taken |= own >= np.where(vouched, min(least, ALIKE * own[ratio >= least].mean()), ALIKE * own[ratio >= least].mean())
    found = _held([x for x, t in zip(lines, taken) if t], doubted)
    return lines, mass * taken, {i for i in doubted if 2 * found[i] < held[i]}


def _held(lines: list, among) -> dict[int, int]:
    """How much text of ``lines`` stands in each of some elements."""
    held = dict.fromkeys(among, 0)
    for x in lines:
        for i in x[2]:
            if i in held:
                held[i] += len(x[0])
    return held


def regions(lines: list, weighed: np.ndarray, elements: list) -> tuple[list[int], set[int]]:
    """The elements that hold the content, [-1] being the whole page, and those around them whose own blocks go along."""
    mass, count = {-1: 0.0}, {-1: 0}
    for x, m in zip(lines, weighed.tolist()):
        for i in (-1, *x[2]) if m else ():
            mass[i], count[i] = mass.get(i, 0.0) + m, count.get(i, 0) + 1
    children: dict[int, list[int]] = {}
    for i in sorted(i for i in mass if i >= 0):
        children.setdefault(elements[i][1], []).append(i)
    sections: dict[int, set[int]] = {}  # by parent, those with a heading or paragraph: they are parts of one text
    for x in lines:
        at, block, _ = home(x, elements)
        if at >= 0 and block and elements[at][0] == "section":
            sections.setdefault(elements[at][1], set()).add(at)
    at, around = -1, set()
    while at < 0 or not elements[at][4]:
        below = next((i for i in children.get(at, ()) if count[i] == count[at] and elements[i][0] in REGION), None)
        if below is None or elements[below][0] == "section" and len(sections.get(at, ())) > 1:
            break
        around.add(at)
        at = below
    if at >= 0 and elements[at][4]:
        around = set()  # the page's own word for its article: what is beside it is none
    if at >= 0 and elements[at][0] == "article":
        return [at], around
    main = at >= 0 and elements[at][4]
    texts = [i for i in mass if i >= 0 and elements[i][4] and (elements[i][0] == "article" or not main) and _under(i, at, elements)]
    outer = sorted(i for i in texts if not any(_under(i, j, elements) for j in texts))
    if not main:
        return (outer, set()) if outer and 2 * sum(mass[i] for i in outer) >= mass[at] else ([at], around)
    inside = set()
    for i in outer:
        while i != at:
            i = elements[i][1]
            inside.add(i)
    every = all(not set(outer).isdisjoint(x[2]) or home(x, elements)[0] in inside for x, m in zip(lines, weighed.tolist()) if m)
    return (outer, inside) if outer and every else ([at], set())


def home(line: tuple, elements: list) -> tuple[int, bool, bool]:
    """The innermost element of a line that may be a region, whether the line is a block of it that goes along, and whether a heading."""
    for k in range(len(line[2]) - 1, -1, -1):
        if elements[line[2][k]][0] in REGION:
            break
    else:
        k = -1
    tags = [elements[i][0] for i in line[2][k + 1 :]]
    return line[2][k] if k >= 0 else -1, not ALONG.isdisjoint(tags), any(t[0] == "h" and t[1:].isdigit() for t in tags)


def along(line: tuple, weight: float, around: set[int], elements: list) -> bool:
    """Whether a line outside the regions goes along with them: content, or a heading or paragraph, in an element around them; of a page's body headings only."""
    if not around:
        return False
    at, block, heading = home(line, elements)
    return at in around and (weight > 0 or heading or block and at >= 0 and elements[at][0] not in ("html", "body"))


def _under(i: int, at: int, elements: list) -> bool:
    """Whether element ``i`` stands in element ``at``; all stand in -1."""
    i = elements[i][1]
    while i > at:
        i = elements[i][1]
    return i == at


def extract(html: str | None, piece: int = PIECE) -> tuple[str, int, int, str]:
    """Main text, its code points, its number of lines and the kinds of its regions; see :func:`extract_column`."""
    parser = Lines()
    page = html or ""
    for a in range(0, len(page), piece):
        parser.feed(page[a : a + piece])
    parser.close()
    parser.line()
    lines, weighed, out = content(parser.lines, parser.elements)
    kept = np.array([not out.intersection(x[2]) for x in lines], bool)
    lines, weighed = [x for x, k in zip(lines, kept) if k], weighed[kept]
    if not lines:
        return "", 0, 0, ""
    where, around = regions(lines, weighed, parser.elements)
    inside = lines if where == [-1] else [x for x, m in zip(lines, weighed.tolist()) if not set(where).isdisjoint(x[2]) or along(x, m, around, parser.elements)]
    text = "\n\n".join(x[0] for x in inside)
    return text, len(text), len(inside), " ".join("page" if i < 0 else parser.elements[i][0] for i in where)


def extract_column(html: Column) -> Column:
    """The main text of each whole page as a struct of :data:`RESULT`.

    Character references are decoded, white space in a line becomes one space, lines are joined by
    two line feeds, in page order. Null is the empty page, whose text is empty, as is that of a page
    without any line to read. Several articles that share the content are all taken; of regions that
    hold as much, the first in the page. Broken and unclosed markup is read as far as the parser's
    events go, and a menu or aside that is never closed does not swallow the page. A page of any length
    is one row and read in pieces. Repeated pages repeat their results; other columns are not used.
    """

    @F.pandas_udf(RESULT)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            yield pd.DataFrame([extract(p) for p in pages], columns=["text", "n_chars", "n_lines", "region"])

    return udf(html)


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = common.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", extract_column(F.col("html")).alias("r")).select("page_id", "url", "r.text", "r.n_chars", "r.n_lines", "r.region")
