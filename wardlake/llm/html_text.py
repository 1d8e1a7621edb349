"""Main text of web pages: parser events, text-to-tag ratio, Gaussian smoothing, threshold clustering.

The events of the standard library's streaming parser are cut into lines at block tags. A line knows its text, the
tags met since the line before, and the open element around it. The ratio of text to tags, smoothed with a
Gaussian kernel over neighbouring lines, is cut at a threshold taken from the page itself; the lines above it are the
page's content clusters. Their characters are the mass of the elements around them, and the way goes down from the page
to the element that holds nearly all of the mass; an ``article`` or ``main`` needs less of it, and lines in parts whose
class, id or role names them as something else hardly weigh. Of the element found all blocks are returned, short ones
too, but for named parts below it. A name is overruled where the part holds most of the page's content, and a heading
is none. Tags that hold no article text (menus, forms, scripts...) are left out while parsing.

Every step is linear in the page: open tags are counted by name, masses are added up once from the leaves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import text_of

# Names of the markup language and usual names for parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p "
    "pre section select summary table tbody td template textarea tfoot th thead title tr ul video audio".split())
LEFT_OUT = frozenset(
    "aside audio button canvas dialog footer form head header iframe map menu nav noscript object script select style "
    "svg template textarea title video".split())
LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NAMES = ("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
         "cookies disclaimer discussion disqus footer gdpr header masthead menu modal nav navbar navigation newsletter "
         "notice notices popup promo promotion related replies respond share sharing sidebar signup skip social sponsor "
         "sponsored subscribe toolbar widget")
_ONE = "(?:" + "|".join(NAMES.split()) + ")"
#: The name is the whole word, its first part or its last: ``share-bar``, ``page-footer``, not ``market-share-table``.
NAMED = re.compile(rf"^(?:{_ONE}(?:[-_].*|\d+)?|.*[-_]{_ONE}\d*)$")
#: Reader comments may well be longer than the article: these names are never overruled.
COMMENTS = re.compile(r"^(?:.*[-_])?(?:comments?|discussion|disqus|replies|respond)(?:[-_].*|\d+)?$")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMED_WEIGHT = 0.01
MOST = 0.9  # share of the mass that an element must hold to be gone into
MOST_OF_ARTICLE = 0.6
OVERRULED = 0.9  # share of the page's content that makes a named part, if it has LEAST_LINES, the content
LEAST_LINES = 3
NOT_NAMED = re.compile(r"^(?:has|with|no|without)[-_]|[-_]with[-_]")
#: An open element of the first name ends where one of the second begins.
ENDS_AT = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
           "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}, "head": {"body"}}
KERNEL = [math.exp(-k * k / 2) for k in range(-2, 3)]


class Element:
    """``name``: 0 none, 1 named, 2 reader comments. ``block``: the nearest block around or at it; a block counts the
    inline elements that are open within it."""
    __slots__ = ("tag", "parent", "out", "name", "block", "inline", "nr")

    def __init__(self, tag: str, parent: Element | None, out: bool, name: int = 0, nr: int = 0):
        self.nr = nr
        self.tag, self.parent, self.out, self.name = tag, parent, out, name
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.inline: dict[str, int] | None = {} if self.block is self else None


class Lines(HTMLParser):
    """Collects (text, tags, element) per line, and the elements in the order they begin."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.here = Element("", None, False)
        self.elements = [self.here]
        self.open: dict[str, int] = {}  # open blocks by tag
        self.lines: list[tuple[str, int, Element]] = []
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append((text, self.tags, self.here))
            self.tags = 0

    def leave(self) -> None:
        """One element out."""
        e = self.here
        counts = self.open if e.block is e else e.block.inline
        counts[e.tag] -= 1
        self.here = e.parent

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
            while self.here.block.parent and tag in ENDS_AT.get(self.here.block.tag, ()):
                ended = self.here.block  # an open element that this one ends; no other block stands between
                while self.here is not ended:
                    self.leave()
                self.leave()
        if tag == "br":
            self.parts.append(" ")
        if tag not in VOID:
            self.here = Element(tag, self.here, self.here.out or left_out(tag), name_of(tag, attrs) if attrs else 0, len(self.elements))
            self.elements.append(self.here)
            counts = self.open if self.here.block is self.here else self.here.block.inline
            counts[tag] = counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        counts = self.open if tag in BLOCK else self.here.block.inline
        if not counts.get(tag):
            return  # nothing to end, or an inline element that a block has ended already
        while self.here.tag != tag:
            self.leave()
        self.leave()

    def handle_data(self, data):
        if not self.here.out:
            self.parts.append(data)


def left_out(tag: str) -> bool:
    return tag in LEFT_OUT


def name_of(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether class, id or role name the element as something else than the article."""
    if tag in ("html", "body", "main", "article") or tag in HEADINGS:
        return 0
    found = 0
    for name, value in attrs:
        if name == "role" and value and value.lower() in LEFT_OUT_ROLES:
            found = max(found, 1)
        if name in ("class", "id") and value:
            for one in value.lower().split():
                if not NOT_NAMED.search(one):
                    found = 2 if COMMENTS.match(one) else max(found, 1 if NAMED.match(one) else 0)
    return found


def page_lines(html: str) -> tuple[list[tuple[str, int, Element]], list[Element]]:
    for source in (html, html.replace("<![", "&lt;![")):
        parser = Lines()
        try:
            parser.feed(source)
            parser.close()
        except AssertionError:  # a marked section that the parser refuses: read as text
            continue
        parser.flush()
        return parser.lines, parser.elements
    return [], []


def content_lines(lines: list[tuple[str, int, Element]]) -> list[bool]:
    """The smoothed text-to-tag ratio against a threshold: the deviation of the page's ratios from their mean."""
    ratio = [len(t) / max(1, n) for t, n, _ in lines]
    smooth = []
    for k in range(len(ratio)):
        near = [(KERNEL[d + 2], ratio[k + d]) for d in range(-2, 3) if 0 <= k + d < len(ratio)]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    mean = sum(smooth) / len(smooth)
    threshold = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    return [s >= min(threshold, mean) for s in smooth]


def main_text(html: str) -> str:
    lines, elements = page_lines(html)
    if not lines:
        return ""
    inside = content_lines(lines)
    # characters and lines of content in each element; elements come after those around them, so the way back adds up
    n = len(elements)
    up = [e.parent.nr if e.parent else -1 for e in elements]
    held, count = [0] * n, [0] * n
    for (text, _, element), good in zip(lines, inside):
        if good:
            held[element.nr] += len(text)
            count[element.nr] += 1
    for k in range(n - 1, 0, -1):
        held[up[k]] += held[k]
        count[up[k]] += count[k]
    own = [e.name == 2 or (e.name == 1 and not (held[e.nr] >= OVERRULED * held[0] and count[e.nr] >= LEAST_LINES))
           if e.name else False for e in elements]
    named = own[:]  # it, or one around it
    for k in range(1, n):
        named[k] = named[k] or named[up[k]]
    mass = [0.0] * n
    for (text, _, element), good in zip(lines, inside):
        if good:
            mass[element.nr] += len(text) * (NAMED_WEIGHT if named[element.nr] else 1)
    best = [0] * n  # the child with most mass, the first of equals; 0 for none
    for k in range(n - 1, 0, -1):
        mass[up[k]] += mass[k]
        if not best[up[k]] or mass[k] >= mass[best[up[k]]]:
            best[up[k]] = k
    home = 0
    while best[home]:
        child = best[home]
        need = MOST_OF_ARTICLE if elements[child].tag in ("article", "main") else MOST
        if elements[child].tag == "p" or mass[child] <= 0 or mass[child] < need * mass[home]:
            break
        home = child
    kept = [False] * n
    kept[home] = True
    for k in range(home + 1, n):
        kept[k] = kept[up[k]] and not own[k]
    return "\n".join(t for t, _, e in lines if kept[e.nr])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256)
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) for every row of ``pages``.

    A null or empty page, and one without text, gives an empty text. Rows that repeat are read on their own; an
    empty table gives no rows; other columns are not read. One page is in memory at a time beside its batch.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(_extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
