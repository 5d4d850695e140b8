"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block of text, as a browser would break it, with as many
empty lines as a window is high where a part of the page (its header, menu, footer, article)
begins or ends. Elements that hold no article text by their kind (scripts, menus, forms, ...) are
stripped with what they hold. Over the lines slides a window that sums their text lengths, lines
of links counting nothing; the stretches between two falls of the sum to zero are the page's
passages. Text surges in the first passage that is as dense as running text or has the page's
heading (there at the heading, if it follows a box of less), and dives behind the last one; all
between is the article, whole.

Where a page marks its article (`article`, `main`), the marks decide instead: they are the
publisher's own statement, and window sums could only cut what they hold. Of several the one with the page's heading is
the article, of those the innermost, else the longest; the others are teasers. An element named or made for
boilerplate goes whatever its length. Only where no text surges outside of such elements, one that merely has such a word
within a longer name, or a form, is read as the page's body.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a window.
WINDOW = 3
#: Characters in a window from which a passage is running text; on a page of less, its highest window counts.
SURGE = 80
#: Of a line, the share of characters inside links from which it is one of links.
LINKS = 0.5
#: How sure a mark of boilerplate is: a form or a word within a longer name can also lie around the article.
WEAK, STRONG = 1, 2

# Ends of lines and structures among pieces of text, kinds of elements of HTML.
LINE, BOX, GAP = object(), object(), object()
_HIDDEN = frozenset("script style noscript template iframe object embed svg math canvas audio video select textarea button".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_APART = frozenset("head nav footer aside form dialog menu".split())
_STRUCTURE = frozenset("html body main article header footer nav".split())
_BOX = frozenset("section aside form div table".split())
_BLOCK = _STRUCTURE | _BOX | frozenset(
    "address blockquote dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li ol p pre search summary"
    " caption tbody td tfoot th thead tr ul option title head".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words that name boilerplate in a class, id or role.
_BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer"
    " disqus footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related"
    " replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
#: Words of them that name boilerplate also within a longer name.
_OTHER_TEXT = frozenset("comment comments consent cookie cookies disclaimer disqus related replies reply respond".split())
#: Words before them that tell what a page has around its article.
_STATES = frozenset("has no with without".split())
_CLOSED_BY_BLOCK = frozenset(["p"])
_IN_HEAD = frozenset("base link meta noscript script style template title".split())

_OPENING = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?", re.S)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r""""[^"]*"|'[^']*'|([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_SPACE = re.compile(r"\s+")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _attributes(text: str) -> dict[str, str]:
    """Names and values, one after the other, so that nothing inside a value counts as a name; the first of a name holds."""
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(text):
        if match[1]:
            found.setdefault(match[1].lower(), next((x for x in match.groups()[1:] if x), ""))
    return found


def _hidden(tag: str, attributes: dict[str, str]) -> bool:
    return tag in _HIDDEN or tag == "head" or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"


def _mark(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """How sure the element is boilerplate: 0, WEAK or STRONG."""
    # A header inside an article belongs to it; one of the page does not.
    if tag in _APART and tag != "form" or tag == "header" and not in_article or attributes.get("role", "").lower() in _ROLES:
        return STRONG
    if tag in ("html", "body", "main"):
        return 0
    names = [name for key in ("class", "id") for name in attributes.get(key, "").split()]
    mark = WEAK if tag == "form" else 0
    for name in names:
        parts = [part.lower() for part in _NAME_PARTS.findall(name)]
        words = set() if parts and parts[0] in _STATES else _BOILERPLATE.intersection(parts) - ({"header"} if in_article else set())
        if words & _OTHER_TEXT or words and len(parts) == 1:
            return STRONG
        if words and tag != "article":
            mark = WEAK
    return mark


@dataclass
class _Article:
    tag: str
    within: int  # the innermost element that looks like boilerplate, or -1
    parent: int  # the article around it, or -1
    depth: int
    size: int = 0  # characters, without those of boilerplate
    headed: bool = False


@dataclass
class _Apart:
    """Elements that look like boilerplate, the one each lies in and what they hold, and the articles.

    The last place, -1, is the page outside all of them.
    """

    within: list[int] = field(default_factory=list)
    mark: list[int] = field(default_factory=list)
    strong: list[bool] = field(default_factory=list)  # the element or one around it is surely boilerplate
    own: Counter = field(default_factory=Counter)  # characters outside links, without those of elements inside
    articles: list[_Article] = field(default_factory=list)

    def open(self, within: int, mark: int) -> int:
        self.within.append(within)
        self.mark.append(mark)
        self.strong.append(mark == STRONG or within >= 0 and self.strong[within])
        return len(self.within) - 1

    def chain(self, at: int) -> set[int]:
        found = set()
        while at >= 0:
            found.add(at)
            at = self.within[at]
        return found

    def article(self) -> int | None:
        """The page's article, if it marks one that holds text."""

        def order(at: int) -> tuple:
            article = self.articles[at]
            inner = article.depth if article.headed else (article.tag == "article", -article.depth)
            return article.headed, article.within < 0, inner, article.size, -at

        return max(
            (at for at, x in enumerate(self.articles) if x.size and (x.headed or x.within < 0 or not self.strong[x.within])),
            key=order, default=None,
        )

    def body(self) -> int:
        """The element of most text among those that only may be boilerplate, or -1."""
        return max((at for at in self.own if at >= 0 and not self.strong[at]), key=lambda at: (self.own[at], -at), default=-1)

    def inside_article(self, chosen: int | None) -> list[bool]:
        """For each article whether it is the chosen one or lies in it; last, for no article: no."""
        found = [False] * (len(self.articles) + 1)
        for at, article in enumerate(self.articles):  # an article follows the one it lies in
            found[at] = at == chosen or found[article.parent]
        return found


@dataclass
class _Lines:
    """Lines of text as markup is stripped, with their characters in links, inside an article and as the page's heading."""

    text: list[str] = field(default_factory=list)
    in_links: list[int] = field(default_factory=list)
    in_article: list[bool] = field(default_factory=list)
    heading: list[bool] = field(default_factory=list)
    boxes: list[int] = field(default_factory=list)  # lines before which a box begins or ends
    pending: list[str] = field(default_factory=list)
    linked: int = 0
    headed: bool = False

    def add(self, piece: str, link: bool, heading: bool) -> None:
        self.pending.append(piece)
        self.linked += len(html.unescape(piece).strip()) if link else 0
        self.headed |= heading and not link

    def end(self, article: bool) -> None:
        line = _SPACE.sub(" ", html.unescape("".join(self.pending))).strip()
        if line:
            self.text.append(line)
            self.in_links.append(self.linked)
            self.in_article.append(article)
            self.heading.append(self.headed)
        self.pending, self.linked, self.headed = [], 0, False

    def lengths(self) -> np.ndarray:
        """Characters of each line, none of a line of links."""
        sizes = [0 if linked >= LINKS * len(text) else len(text) for text, linked in zip(self.text, self.in_links, strict=True)]
        return np.array(sizes, dtype=np.int64)

    def gap(self) -> None:
        """Empty lines, over which a window falls to zero."""
        if self.text and self.text[-1]:
            self.text += [""] * WINDOW
            self.in_links += [0] * WINDOW
            self.in_article += [False] * WINDOW
            self.heading += [False] * WINDOW


def _pieces(page: str) -> tuple[list, _Apart]:
    """What a page shows: pieces of text with their place, LINE where a line ends, BOX and GAP where a box or structure begins or ends."""
    found_pieces: list = []
    apart, open_tags, at = _Apart(), [], 0
    hidden = links = headings = 0  # how many open elements are of that kind
    inside = article = -1  # the innermost element that looks like boilerplate, and the innermost article
    names: Counter = Counter()  # how many open elements have a name
    length, pattern = len(page), _TAG

    def close() -> str:
        nonlocal hidden, links, headings, inside, article
        name, was_hidden, was_article, was_link, was_heading, inside = open_tags.pop()
        names[name] -= 1
        hidden, links, headings = hidden - was_hidden, links - was_link, headings - was_heading
        if was_article:
            inner = apart.articles[article]
            article = inner.parent
            if article >= 0 and apart.articles[article].within == inner.within:
                apart.articles[article].size += inner.size
                apart.articles[article].headed |= inner.headed
        return name

    text_from = 0
    while at < length:
        opening = _OPENING.search(page, at)
        found = None
        if opening:
            found = _COMMENT.match(page, opening.start()) or pattern.match(page, opening.start())
            if not found and pattern is _TAG:  # a quote that never ends: from here on quotes count no more
                pattern = _LOOSE_TAG
                found = pattern.match(page, opening.start())
        stop = opening.start() if opening else length
        if stop > text_from:
            piece = page[text_from:stop]
            if names["head"] and open_tags[-1][0] == "head" and piece.strip():
                close()
            if not hidden:
                found_pieces.append((piece, links > 0, article, headings > 0, inside))
                if not links:
                    apart.own[inside] += len(piece.strip())
                if article >= 0 and apart.articles[article].within == inside:
                    apart.articles[article].size += len(piece.strip())
                    apart.articles[article].headed |= headings > 0
        if not found:  # no tag, or one that never ends
            break
        at = text_from = found.end()
        if found.re is _COMMENT:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if not closing and names["head"]:  # its end tag may be missing
            while names["head"] and (tag == "body" or open_tags[-1][0] == "head" and tag not in _IN_HEAD):
                close()
        if tag in _BLOCK:
            found_pieces.append((LINE, False, article, False, inside))
        if tag in _BOX:
            found_pieces.append((BOX, False, article, False, inside))
        if tag in _STRUCTURE:
            found_pieces.append((GAP, False, article, False, inside))
        if not closing:
            if tag in _RAW:  # no markup inside: go on behind the end tag
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = text_from = end.end() if end else length
                continue
            if tag in _BLOCK and open_tags and open_tags[-1][0] in _CLOSED_BY_BLOCK:
                close()
            if tag in _VOID or found[3].rstrip().endswith("/") and tag in _HIDDEN:
                if tag == "br" and not hidden:
                    found_pieces.append((" ", False, article, False, inside))
                continue
            attributes = _attributes(found[3])
            kind = (_hidden(tag, attributes), tag in ("article", "main"), tag == "a", tag == "h1")
            open_tags.append((tag, *kind, inside))
            names[tag] += 1
            mark = 0 if kind[0] else _mark(tag, attributes, article >= 0)
            if mark:
                inside = apart.open(inside, mark)
            hidden, links, headings = hidden + kind[0], links + kind[2], headings + kind[3]
            if kind[1]:
                depth = apart.articles[article].depth + 1 if article >= 0 else 0
                apart.articles.append(_Article(tag, inside, article, depth))
                article = len(apart.articles) - 1
        elif names[tag]:
            while open_tags and close() != tag:
                pass
    found_pieces.append((LINE, False, article, False, inside))
    while open_tags:
        close()
    return found_pieces, apart


def _lines(pieces: list, apart: _Apart, kept: set[int], chosen: int | None) -> _Lines:
    dropped = [False] * len(apart.within)
    for at, within in enumerate(apart.within):  # an element follows the one it lies in
        dropped[at] = at not in kept or within >= 0 and dropped[within]
    marked = apart.inside_article(chosen)
    lines = _Lines()
    for piece, link, article, heading, inside in pieces:
        if piece is LINE:
            lines.end(marked[article])
        elif piece is BOX:
            lines.boxes.append(len(lines.text))
        elif piece is GAP:
            lines.gap()
        elif inside < 0 or not dropped[inside]:
            lines.add(piece, link, heading)
    return lines


def stripped(page: str) -> _Lines:
    """The lines of a page. Unclosed and stray tags are allowed; a tag cut off at the end is text no more."""
    pieces, apart = _pieces(page)
    chosen = apart.article()
    if chosen is not None:
        return _lines(pieces, apart, apart.chain(apart.articles[chosen].within), chosen)
    lines = _lines(pieces, apart, set(), None)
    if apart.body() >= 0 and all(highest < SURGE for *_, highest in passages(lines.lengths())):
        return _lines(pieces, apart, apart.chain(apart.body()), None)
    return lines


def passages(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, highest window) of every stretch of lines between two falls to zero."""
    if not len(lengths):
        return []
    sums = np.convolve(lengths, np.ones(window, dtype=np.int64))  # the window that ends at each line
    found, start = [], None
    for at, here in enumerate(np.append(sums[: len(lengths)], 0)):
        if here and start is None:
            start = at
        elif not here and start is not None:
            stop = at
            while stop > start and not lengths[stop - 1]:
                stop -= 1
            found.append((start, stop, int(sums[start:at].max())))
            start = None
    return found


def main_text(page: str | None) -> str:
    """The article of a page, one line per block; empty if it has none."""
    lines = stripped(page or "")
    if any(lines.in_article):
        return "\n".join(text for text, marked in zip(lines.text, lines.in_article, strict=True) if marked)
    lengths = lines.lengths()
    found = passages(lengths) if lines.text else []
    if not found:
        return ""
    bar = min(SURGE, max(highest for *_, highest in found))
    dense = [(start, stop) for start, stop, highest in found if highest >= bar or any(lines.heading[start:stop])]
    (start, *_), (*_, stop) = dense[0], dense[-1]
    if any(lines.heading[start:stop]):  # less than running text in a box before the heading is none of the article
        box = max((at for at in lines.boxes if start < at <= lines.heading.index(True, start)), default=start)
        if all(highest < bar for *_, highest in (passages(lengths[start:box]) if box > start else [])):
            start = box
    return "\n".join(text for text in lines.text[start:stop] if text)


def extract_main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Every page as row, with text: its article, whole.

    White space inside a block is one space, blocks are joined by a line feed, character
    references are decoded. A null or empty page, or one without an article, has an empty text.
    Nothing but the html is read; rows pass as they came, repeated ones and all columns too.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    return pages.select(F.struct("*").alias("row"), F.pandas_udf(run, "string")(F.col(html_column)).alias("text"))
