"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one per block element; a line break inside a block is white space.  Elements of navigation, headers (an
article's own as well), footers, forms and the like are left out, and so are elements whose whole class, id or role says that
they hold adverts, reader comments, menus or notices to the reader.  Each line weighs as many characters as it has; text of links weighs
nothing in lists and outside articles.

Sums of weights over sliding windows of three lines, held against the page's greatest, show where the text surges (a quarter
of it, or SUBSTANTIAL) and where it dives (half of that): the stretches between stay, with a heading right before and one linked paragraph right behind.  Where the page has
an article or main element, only its lines take part, and each such element in which the text surges stays whole.  Names that often but not
always hold such things (side, tags, social, search) only weigh: their lines go where the rest of the text carries the page, and
count like any other where it doesn't.

Null and empty pages, and pages without text, give an empty text.  Unclosed elements are closed by the
end tag of an element around them, by a start tag that implies it (p, li, cells, options) or by the page's
end; an unclosed comment, script or style runs to the end.  A tag without its > is text.  Where a quote in
a tag is open at the page's end, quotes hide no > from there on.  One pass over the page, in time linear
in its length: open elements are found by name and by what they may close, not by walking the stack.
"""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_batches

WINDOW = 3
#: Elements without running text, elements whose content is raw, elements that end a line, void elements.
SKIPPED = frozenset("nav header footer aside form menu dialog button select option fieldset head noscript object audio video canvas map".split())
RAW = frozenset("script style textarea title template iframe svg math xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Weight of a window from which text surges in any case, and the share of the page's greatest from which it does.
SUBSTANTIAL, SHARE = 140, 0.25
#: Lines under doubtful names stay where they weigh so many times what other lines do.
DOUBT = 8
#: Elements whose links are running text.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figcaption pre dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a start tag closes (the innermost of them), unless an element other than those named with them stands above it.
_BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_THROUGH = (INLINE, INLINE | {"option"}, INLINE | {"address", "div", "p"}, INLINE | _BLOCKS - {"table"} | frozenset("li dd dt td th option".split()))
_ENDS = {"li": (("li",), 2), "dd": (("dd", "dt"), 2), "dt": (("dd", "dt"), 2), "option": (("option",), 0), "optgroup": (("optgroup",), 1), "td": (("td", "th"), 3), "th": (("td", "th"), 3), "tr": (("tr",), 3)}
_ENDS |= {name: (("p",), 0) for name in _BLOCKS}
#: Parts of names of what is never the text, of what often isn't, and of where or what kind of block something is.
NOISE = frozenset("ad ads adslot adunit adsense banner nav navbar navigation menu menus breadcrumb breadcrumbs footer cookie cookies consent popup modal overlay newsletter subscribe signup login comment comments replies respond discussion feedback pagination pager copyright legal hidden".split())
DOUBTFUL = frozenset("sidebar side widget widgets header masthead foot notice notices alert search share sharing social related tag tags thread".split())
PLACES = frozenset("site main global primary secondary top bottom left right box block list area container wrapper bar links buttons form posts reader readers user users post article articles page section slot unit cloud content story entry blog news inner outer holder item items text".split())
_BEGINNINGS = {"advert": 2, "sponsor": 2, "promo": 2, "disqus": 2, "cookie": 2, "recommend": 1}
#: Of articles: their head is the text's.
_OWN = frozenset("article post entry story".split())
#: Elements that hold the text or the page: their class names speak of the layout or the subject.
_HOLDERS = frozenset("html body main article".split())
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSHOWN = re.compile(r"display\s*:\s*none", re.I)


def _named(value: str) -> int:
    """2 if a class, id or role says that a block is not the text, 1 if it may say so, 0 otherwise: each of its parts must be a word for
    such things, or say where or what kind of block it is."""
    parts = [x for x in re.split(r"[-_]+", value.lower()) if x]
    if parts[:1] == ["comment"] and len(parts) == 2:
        return 2
    found = 0
    for part in parts:
        kind = 2 if part in NOISE else 1 if part in DOUBTFUL else next((k for x, k in _BEGINNINGS.items() if part.startswith(x)), 0)
        if not kind and part not in PLACES:
            return 0
        found = max(found, kind)
    return 0 if found == 1 and "header" in parts and _OWN.intersection(parts) else found


def _noisy(name: str, attributes: str) -> int:
    """How an element's attributes mark it: 2 not shown or not the text, 1 doubtful, 0 neither."""
    if not attributes or attributes.isspace():
        return 0
    found = 0
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSHOWN.search(value):
            return 2
        if key in ("class", "id", "role") and name not in _HOLDERS:
            found = max([found, *map(_named, value.split())])
    return found


class _Scan:
    """Finds in a page that is read forward once: what was not found before is not looked for again."""

    def __init__(self, page: str) -> None:
        self.page, self.quotes, self.gone = page, True, set()

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        where = self.page.find(what, at)
        if where < 0:
            self.gone.add(what)
        return where

    def tag_end(self, at: int) -> int:
        """Place of the > that ends the tag whose name ends at at, or -1."""
        first, page = self.find(">", at), self.page
        if first < 0:
            return -1
        while self.quotes:
            at = _UNQUOTED.match(page, at).end()
            if at < len(page) and page[at] == ">":
                return at
            close = self.find(page[at], at + 1) if at < len(page) else -1
            if close < 0:
                self.quotes = False
            at = close + 1
        return first


class _Open:
    """The open elements, with the places of each name and of what bars a start tag from closing what is below."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, int, bool]] = []  # name, marked, article
        self.places: dict[str, list[int]] = {}
        self.bars: list[list[int]] = [[] for _ in _THROUGH]

    def push(self, name: str, marked: int, own: bool) -> None:
        for bars, through in zip(self.bars, _THROUGH, strict=True):
            if name not in through:
                bars.append(len(self.elements))
        self.places.setdefault(name, []).append(len(self.elements))
        self.elements.append((name, marked, own))

    def innermost(self, names: tuple[str, ...], through: int) -> int:
        """Place of the innermost element of the names, -1 where there is none or another bars it."""
        place = max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)
        bars = self.bars[through]
        return place if place >= 0 and (not bars or bars[-1] <= place) else -1

    def cut(self, place: int) -> list[tuple[str, int, bool]]:
        gone = self.elements[place:]
        del self.elements[place:]
        for name, _, _ in gone:
            self.places[name].pop()
        for bars in self.bars:
            while bars and bars[-1] >= place:
                bars.pop()
        return gone


class Line(NamedTuple):
    text: str
    #: Characters that weigh.
    weight: int
    #: Number of the outermost article or main element that holds it, 0 for none.
    article: int
    heading: bool
    #: In a paragraph or the like, all of it links.
    linked: bool
    doubtful: bool


def lines(page: str) -> list[Line]:
    """The page's lines, without what is never the text."""
    out: list[Line] = []
    text: list[str] = []
    linked = 0
    opened, scan = _Open(), _Scan(page)
    skip = doubt = article = articles = link = item = running = heading = 0
    at, end = 0, len(page)

    def close() -> None:
        nonlocal linked
        if text:
            line = " ".join("".join(text).split())
            if line:
                weight = max(0, len(line) - line.count(" ") - linked)
                out.append(Line(line, weight, articles if article else 0, heading > 0, running > 0 and not weight, doubt > 0))
            text.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece and not skip:
            piece = html.unescape(piece)
            text.append(piece)
            if link and (item or not article):
                linked += len("".join(piece.split()))

    def end_from(where: int) -> None:
        nonlocal skip, doubt, article, link, item, running, heading
        for gone, marked, own in opened.cut(where):
            skip -= marked == 2
            doubt -= marked == 1
            article -= own
            link -= gone == "a"
            item -= gone == "li"
            running -= gone in RUNNING
            heading -= gone in HEADINGS

    while at < end:
        start = scan.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        m = _NAME.match(page, start + 1)
        if not m:
            if page.startswith("<!--", start):
                tail = scan.find("-->", start + 4)
                at = tail + 3 if tail >= 0 else end
            elif page[start + 1 : start + 2] in ("!", "?") and (tail := scan.find(">", start)) >= 0:
                at = tail + 1
            else:
                say("<")
                at = start + 1
            continue
        tail = scan.tag_end(m.end())
        if tail < 0:
            say("<")
            at = start + 1
            continue
        name, attributes, at = m[2].lower(), page[m.end() : tail], tail + 1
        if name == "br":
            say(" ")
        if name not in INLINE:
            close()
        if m[1]:
            if name in INLINE:
                where = opened.innermost((name,), 0)
            else:
                where = opened.places[name][-1] if opened.places.get(name) else -1
            if where >= 0:
                end_from(where)
            continue
        if name in _ENDS and (where := opened.innermost(*_ENDS[name])) >= 0:
            end_from(where)
        if name in RAW:
            ends = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = ends.end() if ends else end
        elif name not in VOID and not attributes.endswith("/"):
            marked = 2 if name in SKIPPED else _noisy(name, attributes)
            own = marked < 2 and name in ("article", "main")
            skip, doubt, article, articles = skip + (marked == 2), doubt + (marked == 1), article + own, articles + (own and not article)
            link, item, running, heading = link + (name == "a"), item + (name == "li"), running + (name in RUNNING), heading + (name in HEADINGS)
            opened.push(name, marked, own)
    close()
    return out


def _sums(weights: list[int]) -> list[int]:
    """Of the lines before, at and after each."""
    padded = [0, *weights, 0]
    return [sum(padded[k : k + WINDOW]) for k in range(len(weights))]


def stretches(weights: list[int]) -> list[tuple[int, int]]:
    """(first, after the last) of the lines between each surge of the window sums and the dive that follows."""
    sums = _sums(weights)
    surge = min(SUBSTANTIAL, SHARE * max(sums, default=0))
    out, start = [], None
    for k, total in enumerate([*sums, 0]):
        if start is None and total and total >= surge:
            start = k
        elif start is not None and (not total or total < surge / 2):
            out.append((start, k))
            start = None
    return out


def main_text(page: str | None) -> str:
    found = lines(page or "")
    kept = [x for x in found if x.article] or found
    sure = [x for x in kept if not x.doubtful]
    if DOUBT * sum(x.weight for x in sure) >= sum(x.weight for x in kept if x.doubtful) and sure:
        kept = sure
    if any(x.article for x in kept):
        of = {k: list(some) for k, some in itertools.groupby(kept, lambda x: x.article)}  # an outermost element's lines are in a row
        most = {k: max(_sums([x.weight for x in some])) for k, some in of.items()}
        surge = min(SUBSTANTIAL, SHARE * max(most.values()))
        return "\n".join(x.text for k, some in of.items() if most[k] >= surge for x in some)
    parts = []
    for lo, hi in stretches([x.weight for x in kept]):
        # a surge reaches one line before the text, the dive one line past it: the window's own edges
        while not kept[lo].weight:
            lo += 1
        while not kept[hi - 1].weight:
            hi -= 1
        while lo and kept[lo - 1].heading and not (parts and lo - 1 < parts[-1][1]):
            lo -= 1
        if hi < len(kept) and kept[hi].linked and not any(x.linked for x in kept[hi + 1 : hi + 2]):
            hi += 1  # one linked paragraph ends a text, several are a list of links
        parts.append((lo, hi))
    return "\n".join(x.text for lo, hi in parts for x in kept[lo:hi])


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [main_text(x) for x in batch["html"]]
        yield batch[["page_id", "url"]].astype({"page_id": "Int64"}).assign(text=pd.Series(texts, dtype=object, index=batch.index), n_chars=[len(t) for t in texts])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    return text_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(lean(_extracted), "page_id long, url string, text string, n_chars long")
