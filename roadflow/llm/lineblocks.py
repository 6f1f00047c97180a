"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: the text of a block (paragraph, heading, list item, cell) is a line, and each border of a
container (division, list, table, section) leaves an empty one. A line weighs its text's length; nothing, if it is
mostly links or lies in what a page has for other ends (menus, headers, footers, sidebars, notices, adverts, forms,
comments, by element, role or class name). Lengths are added over windows of WINDOW lines. Where the sum surges over
THRESHOLD the text begins, where it dives to nothing it ends; of all such stretches the one with most text is kept, and in
it every line but those of the other ends, short ones too. A page that declares its article (``article``, ``main``, or a
text property) says where the distribution is taken: lines outside it weigh nothing, empty lines inside it don't count.

Whole pages are taken, whatever their length; no line is cut. A null or empty page, and one without text, gives an empty
text. Repeated ids and null ids are rows like others. Broken markup (missing ends, cut-off tags and references) is read
as browsers do: a paragraph ends where the next block begins, an end without a beginning is ignored.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import of_texts

#: Lines of a window; characters at which its sum surges; characters up to which a line before a surge is no text.
WINDOW, THRESHOLD, SHORT = 3, 80, 25

#: Elements without an end, elements whose content is never text, blocks of text, and containers of blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template iframe object svg canvas textarea select title"
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th caption figcaption summary address legend option".split())
CONTAINERS = frozenset("html body div section article main aside nav header footer ul ol dl table thead tbody tfoot tr form fieldset blockquote figure details dialog center menu search hgroup button head".split())
#: Elements and roles that hold something else than the text, and names that classes of such parts are made of.
OTHER_ELEMENTS = frozenset("nav footer aside form dialog menu search button fieldset head".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
OTHER_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay
    newsletter subscribe subscription signup login sidebar widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar share sharing social related recommended
    recommendations comment comments commentlist reply replies respond discussion disqus pagination pager search form copyright disclaimer skip teaser""".split()
)
#: Names beside which those above describe a page's layout, not a part ("with-sidebar").
LAYOUT_NAMES = frozenset("with has no without layout wrapper page container main article post entry".split())
COMMENTS = re.compile(r"(?:\d+ )?(?:reader |user )?(?:comments?|replies|responses|kommentare|commentaires|comentarios)(?: ?\(\d+\))?:?", re.I)

# The rest of a tag: values in quotes hold no `<` but for two short ones, so that cut-off tags cost no more than their length.
_PLAIN = r"""(?:[^<>"']|"[^"<]*"|'[^'<]*')*+"""
_REST = rf"""{_PLAIN}(?:(?:"[^"]{{0,300}}"|'[^']{{0,300}}'){_PLAIN}){{0,2}}"""
PIECE = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW.replace(" ", "|")})(?=[\s/>]){_REST}>.*?(?:</(?P=raw)\s*+[^>]*+>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<rest>{_REST})>|</?[a-zA-Z][^<>]*+(?:>|(?=<)|\Z)""", re.S | re.I | re.X
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(?P<key>class|id|role|itemprop|style|aria-hidden|hidden)(?:\s*=\s*(?P<value>"[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")


class Element:
    """An open element: its name, whether what it holds is no text, and whether it declares the article."""

    __slots__ = ("article", "name", "other")

    def __init__(self, name: str, other: bool, article: int):
        self.name, self.other, self.article = name, other, article


class Lines:
    """Lines of a page: ``text, linked, other, article, head`` each; an empty text is a container's border."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, bool, int, bool]] = []
        self.open: list[Element] = []
        self.held: dict[str, int] = {}
        self.parts: list[str] = []
        self.linked = self.articles = 0

    def border(self) -> None:
        self.rows.append(("", 0, False, self.open[-1].article if self.open else 0, False))

    def flush(self) -> None:
        """The text so far is a line."""
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            top = self.open[-1] if self.open else Element("", False, 0)
            self.rows.append((text, self.linked, top.other, top.article, len(top.name) == 2 and top.name[0] == "h"))
        self.parts, self.linked = [], 0

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.held.get("a"):
            self.linked += len(text)

    def close(self, name: str) -> None:
        """Close the innermost element of that name and all in it."""
        while self.held.get(name):
            gone = self.open.pop().name
            self.held[gone] -= 1
            if gone in CONTAINERS:
                self.border()
            if gone == name:
                break

    def begin(self, name: str, rest: str) -> None:
        if name in TEXT_BLOCKS or name in CONTAINERS:
            self.flush()
            self.held["a"] = 0
            for before in ("p", *([name] if name in ("li", "dt", "dd", "td", "th", "tr", "option") and self._beside(name) else []), *(["head"] if name in ("body", "article", "main", "div") else [])):
                self.close(before)
            if name in CONTAINERS:
                self.border()
            top = self.open[-1] if self.open else Element("", False, 0)
            other, article = self._kind(name, rest, top)
            self.open.append(Element(name, top.other or other, article))
            self.held[name] = self.held.get(name, 0) + 1
        elif name == "br":
            self.add(" ")
        elif name == "a":
            self.held["a"] = 1

    def end(self, name: str) -> None:
        if name == "a":
            self.held["a"] = 0
        elif name in TEXT_BLOCKS or name in CONTAINERS:
            self.flush()
            self.close(name)

    def _beside(self, name: str) -> bool:
        """Whether the innermost element that isn't text is still in one of that name, not in a new list or table."""
        for e in reversed(self.open):
            if e.name == name:
                return True
            if e.name in CONTAINERS and e.name != "div":
                return False
        return False

    def _kind(self, name: str, rest: str, top: Element) -> tuple[bool, int]:
        """Whether the element is no text, and the number of the article that it is in (0: none)."""
        given = {m["key"].lower(): (m["value"] or "").strip("\"'") for m in ATTRIBUTE.finditer(rest)} if rest else {}
        names = {n.lower() for key in ("class", "id") for n in NAME.findall(given.get(key, ""))}
        role = given.get("role", "").lower()
        declared = name in ("article", "main") or role in ("main", "article") or given.get("itemprop", "").lower() == "articlebody"
        article = top.article
        if declared and not top.other:
            if name == "article" and top.article and any(e.name == "article" for e in self.open):
                return True, article  # an article in an article is a reader's comment
            self.articles += 1
            return False, self.articles
        hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
        if name in OTHER_ELEMENTS or role in OTHER_ROLES or hidden or (name == "header" and not article):
            return True, article
        named = bool(names & OTHER_NAMES or ("header" in names and not article and name != "h1")) and not names & LAYOUT_NAMES
        return named and name not in ("html", "body"), article


def lines_of(page: str) -> list[tuple[str, int, bool, int, bool]]:
    lines, at = Lines(), 0
    for m in PIECE.finditer(page):
        if m.start() > at:
            lines.add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name:
            name = name.lower()
            if m["end"]:
                lines.end(name)
            else:
                lines.begin(name, m["rest"])
    if at < len(page):
        lines.add(page[at:])
    lines.flush()
    return lines.rows


def stretches(weights: list[int], surge: int) -> list[tuple[int, int]]:
    """First and last line of every stretch: from where the sum of a window reaches ``surge`` (the largest sum, if none
    does) to where it dives to nothing."""
    n = len(weights)
    total = [0]
    for w in weights:
        total.append(total[-1] + w)
    window = [total[min(i + WINDOW, n)] - total[i] for i in range(n)]
    least = min(surge, max(window, default=0))
    out, i = [], 0
    while i < n:
        if window[i] < least or not window[i]:
            i += 1
            continue
        j = i
        while j < n and window[j]:
            j += 1
        out.append((i, j - 1))
        i = j
    return out


def main_text(page: str) -> str:
    rows = lines_of(page)
    size = {}
    for text, _, other, article, _ in rows:
        if article and not other:
            size[article] = size.get(article, 0) + len(text)
    if size:  # the article with most text, as it was declared
        best = max(size, key=lambda a: (size[a], -a))
        own = [i for i, r in enumerate(rows) if r[0] and not r[2] and r[3] == best]
        kept, before, after = [rows[i] for i in own], rows[: own[0]], rows[own[-1] + 1 :]  # what it holds for other ends doesn't count
        rows = before + kept + after
        weights = [0] * len(before) + [len(r[0]) for r in kept] + [0] * len(after)
    else:
        rows = [r for r in rows if not r[2]]
        for i, r in enumerate(rows):  # a heading of readers' comments ends the text
            if r[4] and COMMENTS.fullmatch(r[0]):
                rows = rows[:i]
                break
        weights = [len(text) if 2 * linked < len(text) else 0 for text, linked, *_ in rows]
    found = stretches(weights, 1 if size else THRESHOLD)  # a declared article has no short lines before it
    if not found:
        return ""
    start, end = max(found, key=lambda s: (sum(weights[s[0] : s[1] + 1]), -s[0]))
    if size:  # the surge's window reaches over lines before it
        start += next(i for i, w in enumerate(weights[start:]) if w)
    else:  # short lines before the surge's own text that an empty line parts from it
        for i in range(start, min(start + WINDOW - 1, end)):
            if not rows[i + 1][0] and 0 < len(rows[i][0]) <= SHORT and not rows[i][4]:
                start = i + 1
    return "\n".join(r[0] for r in rows[start : end + 1] if r[0])


def extract(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with ``into``, the main text of each page; a column of that name is replaced."""
    out = of_texts(pages, html_col, into, "string", lambda: lambda texts: pd.Series([main_text(t) if t else "" for t in texts], dtype=object))
    return out.withColumn(into, F.coalesce(F.col(f"`{into}`"), F.lit("")))
