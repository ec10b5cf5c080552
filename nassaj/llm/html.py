"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block. Scripts, menus, headers, footers, sidebars, notices,
adverts, forms and reader comments, known by element, role, class or id, leave no lines.
Link text is kept but weighs nothing. Text lengths are summed over a sliding window of ``window`` lines: a
window that rises above the surge height begins a region, and the region ends where the windows dive
to nothing. What stands between is the main text.

A page that marks its article (``article`` or ``main``) is searched inside it alone, in the same way, from a
quarter of the surge height: runs of links dive there too. Elsewhere the surge height is ``surge`` characters.
What stands below it is kept between regions that surge, and where it lies in the same container (div, section,
table cell) as one of them. If nothing surges, the largest region counts as one that does; if all text is linked, links
weigh as text. A title (``h1``) weighs in full, linked or not.

Null, empty and markup-only pages give an empty text. Elements end where HTML ends them, so an end tag
that may be left out (of head, p, li, dd, option, table parts) is not missed; others end with their parent or the page. A stray
``<`` is text; a tag with an open quote ends at its first ``>``. Pages are read whole, in time linear in their length, and judged
one by one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80
ARTICLE_SHARE = 4

# --- fixed values: HTML elements by their part in a page --------------------------
RAW = frozenset("script style title textarea xmp noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr input".split()
)
ASIDE = frozenset(
    "head nav footer aside form noscript template select option button iframe svg object canvas dialog menu "
    "audio video map script style title textarea xmp noframes".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
ASIDE_NAMES = frozenset(
    "ad ads adbox adslot adsense adsbygoogle advert adverts advertisement advertisements advertising sponsor sponsored promo "
    "promotion banner sidebar aside menu menubar nav navbar navigation topbar toolbar breadcrumb breadcrumbs pagination pager "
    "footer masthead comment comments commentlist reply replies respond disqus cookie cookies consent gdpr notice notices alert "
    "announcement newsletter subscribe subscription signup login popup modal overlay related recommended recommendations "
    "trending share sharing social widget widgets copyright".split()
)
#: Elements whose start tag ends an open paragraph.
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li listing main menu nav ol p pre search section summary table ul xmp".split()
)
#: By start tag: the open elements that it ends, and those beyond which it does not look for them.
SIBLINGS = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset("ul ol menu dir".split()))),
    **dict.fromkeys(("dd", "dt"), (frozenset(("dd", "dt")), frozenset(("dl",)))),
    "option": (frozenset(("option",)), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset(("option", "optgroup")), frozenset("select datalist".split())),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    "tr": (frozenset(("td", "th", "tr")), frozenset(("table",))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset("td th tr tbody thead tfoot caption".split()), frozenset(("table",)))),
}
#: An end tag reaches no element outside these, unless it is of a part of the table itself.
SCOPES = frozenset("table td th caption object template marquee html".split())
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption object template marquee body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())
#: Words that turn a name into a remark about the page, as in ``has-sidebar``.
REMARKS = frozenset("no has with without".split())
ARTICLE = frozenset(("article", "main"))
CONTAINERS = frozenset("div section article main td th center fieldset details".split())

_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)", re.I)


def _is_aside(name: str, attributes: str, in_article: bool) -> bool:
    if name in ASIDE or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in _NAMED.findall(attributes):
        value, key = value.strip("\"'").lower(), key.lower()
        if key == "role":
            if value in ASIDE_ROLES:
                return True
        elif key == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif key == "aria-hidden":
            if value == "true":
                return True
        else:
            for one in value.split():
                words = re.split(r"[^a-z0-9]+", one)
                if REMARKS.isdisjoint(words) and (
                    not ASIDE_NAMES.isdisjoint(words) or "header" in words and not in_article
                ):
                    return True
    rest = re.sub(r"\"[^\"]*\"|'[^']*'", "", _NAMED.sub(" ", attributes))
    return bool(_HIDDEN.search(rest.replace("aria-hidden", "")))


class _Ends:
    """Where tags end, known for all places of a page at once, so that no tag is searched to the page's end."""

    def __init__(self, html: str) -> None:
        self.marks = [m.start() for m in _MARK.finditer(html)]
        n = len(self.marks)
        self.loose, self.closed = [-1] * (n + 1), [-1] * (n + 1)
        following: dict[str, int] = {}
        for i in range(n - 1, -1, -1):
            mark = html[self.marks[i]]
            if mark == ">":
                self.loose[i] = self.closed[i] = self.marks[i]
            else:
                self.loose[i] = self.loose[i + 1]
                self.closed[i] = self.closed[following[mark] + 1] if mark in following else -1
                following[mark] = i

    def bracket(self, at: int) -> int:
        """The first ``>`` from a place on, or -1."""
        return self.loose[bisect_left(self.marks, at)]

    def tag(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin at a place: outside quotes if there is one, else the first."""
        i = bisect_left(self.marks, at)
        return self.closed[i] if self.closed[i] >= 0 else self.loose[i]


class _Lines:
    """The lines of a page: text, its length without links, whether in an article, the container of its block."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, bool, int]] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.title = False
        self.home = 0

    def end(self, article: bool) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text:
                link = 0 if self.title else len(" ".join(unescape("".join(self.linked)).split()))
                self.rows.append((text, max(0, len(text) - link), article, self.home))
            self.parts, self.linked = [], []


class _Open:
    """The open elements but inline ones, which end where HTML ends them, with or without an end tag."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}
        self.homes: list[tuple[int, int]] = []  # of open containers: their place and number
        self.met = 0
        self.aside = -1  # the place of the aside being skipped

    def push(self, name: str) -> None:
        if name in CONTAINERS:
            self.met += 1
            self.homes.append((len(self.names), self.met))
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def cut(self, size: int) -> None:
        while len(self.names) > size:
            name = self.names.pop()
            if name:
                self.places[name].pop()
        while self.homes and self.homes[-1][0] >= size:
            self.homes.pop()

    def home(self) -> int:
        """The container that the block at hand lies in; a container with text of its own is a block."""
        own = bool(self.homes) and self.homes[-1][0] == len(self.names) - 1
        return self.homes[-1 - own][1] if len(self.homes) > own else 0

    def place(self, ends: frozenset[str], scope: frozenset[str]) -> int:
        """The innermost open element of some names inside a scope, or -1."""
        at = self.last(ends)
        return at if at >= 0 and at >= self.last(scope) else -1

    def last(self, names: frozenset[str]) -> int:
        """The innermost open element of some names, or -1."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=-1)

    def start(self, name: str) -> None:
        """End what a start tag ends."""
        if self.places.get("head") and name not in IN_HEAD:
            self.end("head")
        if name in SIBLINGS:
            ends, scope = SIBLINGS[name]
            last = at = self.place(ends, scope)
            while last >= 0:  # a row ends its cells and the row before
                at = last
                self.cut(at)
                last = self.place(ends, scope)
        if name in PARAGRAPH_ENDS:
            at = self.place(frozenset(("p",)), SCOPES | {"button"})
            if at >= 0:
                self.cut(at)

    def end(self, name: str) -> None:
        """End what an end tag ends; a stray one ends nothing."""
        ends = HEADINGS if name in HEADINGS else frozenset((name,))
        at = self.place(ends, frozenset(("table",)) if name in TABLE_PARTS else SCOPES)
        if name in INLINE and at > self.aside and at >= 0:  # blocks in it stay open
            self.places[self.names[at]].pop()
            self.names[at] = ""
        elif at >= 0:
            self.cut(at)


def lines(html: str) -> list[tuple[str, int, bool, int]]:
    out, opened, ends = _Lines(), _Open(), _Ends(html)
    at, end, articles, links = 0, len(html), 0, 0
    skip = ""  # the aside being skipped
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            lt = end
        if skip == "head" and opened.names[-1] == "head" and html[at:lt].strip():
            opened.end("head")
            skip, opened.aside = "", -1
        if lt > at and not skip:
            if not out.parts:
                out.home = opened.home()
            out.parts.append(html[at:lt])
            if links:
                out.linked.append(html[at:lt])
        if lt == end:
            break
        if html.startswith("<!--", lt):
            close = html.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            close = html.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        m = _TAG_NAME.match(html, lt) if ends.bracket(lt) >= 0 else None
        if not m:
            if not skip:
                out.home = out.home if out.parts else opened.home()
                out.parts.append("<")
            at = lt + 1
            continue
        closing, name, close = m[1], m[2].lower(), ends.tag(m.end())
        attributes = html[m.end() : close]
        at = close + 1
        if closing:
            opened.end(name)
        else:
            opened.start(name)
        ended = bool(skip) and len(opened.names) <= opened.aside
        if ended:
            skip, opened.aside = "", -1
        holds = not closing and name not in VOID and (not attributes.endswith("/") or name in RAW)
        if skip or ended and closing and name not in ARTICLE:
            if holds and (name not in INLINE or name == skip):
                opened.push(name)
            if closing and name == "a":
                links = 0
        elif not closing and name not in VOID and _is_aside(name, attributes, articles > 0):
            out.end(articles > 0)
            if holds:
                skip, opened.aside = name, len(opened.names)
                opened.push(name)
        elif name in ARTICLE:
            out.end(articles > 0)
            articles = max(0, articles + (-1 if closing else 1))
            if holds:
                opened.push(name)
        elif name == "a":
            links = 0 if closing else 1
        elif name == "br":
            out.home = out.home if out.parts else opened.home()
            out.parts.append(" ")
            if links:
                out.linked.append(" ")
        elif name not in INLINE:
            out.end(articles > 0)
            out.title = name == "h1" and not closing
            if holds:
                opened.push(name)
        if not closing and name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            at = end if not close else close.start()
    out.end(articles > 0)
    return out.rows


def regions(lengths: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Half-open ranges of lines between a surge and the dive after it."""
    n = len(lengths)
    total, sums = 0, []
    for i in range(n + window - 1):
        total += (lengths[i] if i < n else 0) - (lengths[i - window] if i >= window else 0)
        if i >= window - 1:
            sums.append(total)  # of the window that begins at line i - window + 1
    found, i = [], 0
    while i < n:
        if not lengths[i]:
            i += 1
            continue
        stop, top = i, 0
        while stop < n and sums[stop] > 0:
            top = max(top, sums[stop])
            stop += 1
        if top > surge:
            found.append((i, stop))
        i = stop
    return found


def main_text(html: str, window: int = WINDOW, surge: int = SURGE) -> str:
    rows = lines(html)
    if any(inside for _, _, inside, _ in rows):
        rows, surge = [r for r in rows if r[2]], surge // ARTICLE_SHARE
    lengths = [n for _, n, _, _ in rows]
    if not any(lengths):
        lengths = [len(text) for text, _, _, _ in rows]
    everything = regions(lengths, window, 0)
    if not everything:
        return ""
    found = regions(lengths, window, surge) or [max(everything, key=lambda r: sum(lengths[r[0] : r[1]]))]
    homes = {rows[k][3] for a, b in found for k in range(a, b)}
    kept = [
        (a, b) for a, b in everything
        if found[0][0] <= a <= found[-1][0] or any(rows[k][3] in homes for k in range(a, b) if lengths[k])
    ]
    return "\n".join(rows[k][0] for a, b in kept for k in range(a, b))


def extract(html: Column | str, window: int = WINDOW, surge: int = SURGE) -> Column:
    """The main text of each page."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(h, window, surge) for h in pages.fillna("")], dtype=object)

    return texts.asNondeterministic()(html)
