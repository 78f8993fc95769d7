r"""Main text of web pages by composite text density.

A page becomes a tree (implied end tags, raw-text elements, truncated markup
and unclosed elements as browsers read them).  Elements that declare
themselves boilerplate, by tag, role, class or id, are taken out first,
however much of the text they hold.  Where it is the role, class or id, the
wrappers of the page's ``main`` and ``article`` stay, and so do the outermost
ones if all text stands in such elements.  For every remaining node with C characters and T tags below it, of which LC stand
in links and LT are links,

    density = C / T * log_b(C / LC * T / LT),
    b = ln(C / (C - LC) * LC + LCbody / Cbody * C + e)

(zeros count as ones), and its density sum adds its children's densities.  The
node of the largest sum holds the article; the least density on the path from
the body down to it is the threshold at which other subtrees are kept too.
If that node lies in an ``article`` or ``main``, this is the article.

Blocks are the texts of block-level elements: character references decoded,
white space collapsed, trimmed, empty ones left out, joined by a newline.

Edge cases: a null or empty page, or one without text, gives an empty text.
Nothing recurses, so nesting may be of any depth; no text is cut.  Rows are
independent: null ids, repeated rows and extra columns are passed through; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import ship

# Fixed values of the HTML standard, and of common usage for class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search
    section summary table tbody td tfoot th thead tr ul""".split()
)
#: Elements that a start tag closes if one is open, and where the search ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset(
    """aside audio button canvas dialog embed fieldset footer form head iframe input label map menu nav noembed
    noframes noscript object option script search select style svg template textarea title video""".split()
)
ROLES = frozenset(
    """alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search status
    toolbar""".split()
)
NAMES = frozenset(
    """ad ads adv advert advertisement advertising adverts aside banner breadcrumb breadcrumbs byline comment
    commentlist comments consent cookie cookies copyright discussion disqus feedback foot footer form gdpr hint
    login masthead menu modal nav navbar navigation newsletter notice notification outbrain overlay pager
    pagination paywall popup promo promoted promotion recommend recommended related replies reply respond
    responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola
    teaser toc toolbar topbar warning widget widgets""".split()
)
#: Of these, what an article may call a part of its own.
OWN = frozenset("discussion feedback hint notice responses warning".split())
#: Words that say how or where something named above is laid out.
LAYOUT = frozenset(
    """action actions area articles bar block body bottom box btn button buttons card center col column content
    count cta desktop field fixed form full group header heading holder icon icons inline inner input item items
    label large left line link links list mobile outer panel placeholder post posts right row section single slot
    small stories tab tabs text thread title toggle top unit wide wrap wrapper zone""".split()
)
HEADERS = frozenset("header head masthead topbar banner".split())
#: Parts of a class name after which it names what an element goes with.
BESIDE = frozenset("has no not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters of a linked entry, on average, from which a list of links is one
#: of references and not a menu.
REFERENCE = 30

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>"']|"[^"]*"|'[^']*')*))(?:>|\Z)"""
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Page:
    """A page as arrays over its elements in page order.  ``texts`` holds
    (element, text) in page order; ``None`` as text ends a block."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["html"], [-1], [""]
        self.texts: list[tuple[int, str | None]] = []
        # Open elements, outermost first, and their places by tag; those of
        # block-level elements also under None.
        self.stack, self.places = [0], {"html": [0], None: [0]}
        self._read(source)

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        return len(self.tag) - 1

    def _push(self, node: int) -> None:
        tag, place = self.tag[node], len(self.stack)
        self.stack.append(node)
        self.places.setdefault(tag, []).append(place)
        if tag in BLOCK:
            self.places[None].append(place)

    def _cut(self, place: int) -> None:
        """Close the open elements from a place on."""
        for node in reversed(self.stack[place:]):
            self.places[self.tag[node]].pop()
            if self.tag[node] in BLOCK:
                self.places[None].pop()
        del self.stack[place:]

    def _last(self, tag: str | None) -> int:
        """The innermost open place of a tag, 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def _read(self, source: str) -> None:
        at, size, stack = 0, len(source), self.stack
        while at < size:
            m = TOKEN.search(source, at)
            end = m.start() if m else size
            if end > at:
                self.texts.append((stack[-1], html.unescape(source[at:end])))
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(tag)
            else:
                at = self._start(tag, m[3] or m[6] or "", source, at)

    def _start(self, tag: str, attrs: str, source: str, at: int) -> int:
        stack = self.stack
        if tag in ("html", "body") and len(stack) > 1:
            return at
        if tag in BLOCK:
            self._close({"p"}, {"button", "table", "td", "th", "caption"})
            self.texts.append((stack[-1], None))
        if tag in HEADINGS:
            self._close(HEADINGS, BLOCK - HEADINGS)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag == "body" or tag in BLOCK and self.tag[stack[-1]] == "head":
            self._close({"head"}, set())
        node = self._open(tag, attrs, stack[-1])
        if tag in VOID:
            if tag == "br":
                self.texts.append((stack[-1], " "))
            return at
        if tag in RAW:
            m = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            return m.end() if m else len(source)
        if not attrs.endswith("/") or tag not in ("path", "g", "use", "circle", "rect", "svg"):
            self._push(node)
        return at

    def _close(self, tags, until) -> None:
        """Close the outermost of the open ``tags`` above any of ``until``."""
        above = max((self._last(t) for t in until), default=0)
        found = []
        for t in tags:
            places = self.places.get(t, ())
            k = bisect_right(places, above)
            if k < len(places):
                found.append(places[k])
        if found:
            place = min(found)
            for node in reversed(self.stack[place:]):
                if self.tag[node] in tags:
                    self.texts.append((node, None))
            self._cut(place)

    def _end(self, tag: str) -> None:
        place = self._last(tag)
        if tag in ("html", "body") or not place:
            return
        if tag not in BLOCK and self._last(None) > place:
            return  # an inline end tag does not close blocks
        if tag in BLOCK:
            self.texts.append((self.stack[place], None))
        self._cut(place)


def _named(parts: list[str]) -> set[str]:
    """The boilerplate that a class or id names: words of ``NAMES`` or
    ``HEADERS`` after which only layout follows.  ``related-posts`` and
    ``post-comments`` are such names, ``related-work`` and ``share-of-market``
    are not: there the word describes another."""
    parts = parts[: next((k for k, p in enumerate(parts) if p in BESIDE), len(parts))]
    out: set[str] = set()
    for p in reversed(parts):
        if p in NAMES or p in HEADERS:
            out.add(p)
        elif not (p in LAYOUT or p.isdigit() or len(p) == 1):
            break
    return out


def _boilerplate(tag: str, attrs: str, within: bool) -> tuple[bool, bool]:
    """Whether an element, ``within`` an article or not, declares itself
    boilerplate, and whether as a header (which may hold the article's
    headings)."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attrs)} if attrs else {}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, False
    if tag == "header":
        return True, True
    if tag in DROPPED:
        return True, False
    role = found.get("role", "").lower()
    names = set()
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        names |= _named([p.lower() for p in NAME_PARTS.findall(name)])
    if within:
        names -= OWN
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return False, False
    if tag == "article":
        return bool(names & {"comment", "comments", "reply", "ad", "advert", "teaser", "related", "promo"}), False
    if role in ROLES:
        return True, role == "banner"
    if names & HEADERS:
        return True, True
    return bool(names & NAMES), False


def _is_main(tag: str, attrs: str) -> bool:
    return tag == "main" or bool(re.search(r"role\s*=\s*[\"']?main", attrs))


def _wrappers(page: Page, soft: list[bool], out: list[bool], total: list[int]) -> set[int]:
    """The ``soft`` elements around the page's main and its article: the one
    with the fewest of them around it, the first of equals.  An article in an
    article is a comment on it, several alone in one wrapper are a list, and with
    a main only those in it are the page's.  ``out`` elements do not count."""
    tag, parent = page.tag, page.parent
    n = len(tag)
    around, inner, in_main, in_article = [0] * n, [0] * n, [False] * n, [False] * n
    found: dict[str, list[int]] = {"main": [], "article": []}
    for i in range(1, n):
        p = parent[i]
        around[i], inner[i] = around[p] + soft[p], p if soft[p] else inner[p]
        in_main[i], in_article[i] = in_main[p], in_article[p]
        if total[i] and not soft[i] and not out[i]:
            if _is_main(tag[i], page.attrs[i]):
                found["main"].append(i)
                in_main[i] = True
            elif tag[i] == "article":
                if not in_article[i]:
                    found["article"].append(i)
                in_article[i] = True
    if found["main"]:
        found["article"] = [i for i in found["article"] if in_main[i]]
    held = Counter(inner[i] for i in found["article"])
    found["article"] = [i for i in found["article"] if not inner[i] or held[inner[i]] == 1]
    wrappers = set()
    for nodes in found.values():
        i = min(nodes, key=lambda i: around[i], default=0)
        while i:
            i = parent[i]
            if soft[i]:
                wrappers.add(i)
    return wrappers


def _density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    if not c:
        return 0.0
    t, plain = max(t, 1), max(c - lc, 1)
    base = math.log(c / plain * lc + share * c + math.e)
    return c / t * (math.log(c / max(lc, 1) * t / max(lt, 1)) / math.log(base) if base > 1 else 1.0)


def main_text(source: str | None) -> str:
    """The article of a page, its blocks joined by newlines."""
    if not source:
        return ""
    page = Page(source)
    tag, parent = page.tag, page.parent
    n = len(tag)

    own = [0] * n
    for node, text in page.texts:
        if text:
            own[node] += len(" ".join(text.split()))
    # Boilerplate by tag, and by name unless it is a wrapper or all there is.
    in_article = [False] * n
    for i in range(1, n):
        in_article[i] = in_article[parent[i]] or tag[i] in ("article", "main")
    marks = [(False, False)] + [_boilerplate(tag[i], page.attrs[i], in_article[parent[i]]) for i in range(1, n)]
    soft = [m[0] and tag[i] not in DROPPED and tag[i] != "header" for i, m in enumerate(marks)]
    out = [False] * n
    for i in range(1, n):
        out[i] = out[parent[i]] or marks[i][0] and not soft[i]
    total = [0 if o else c for c, o in zip(own, out)]
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    wrappers = _wrappers(page, soft, out, total)
    names = [0] * n
    for i in range(1, n):
        names[i] = names[parent[i]] + (soft[i] and i not in wrappers)
    least = min((names[i] for i in range(n) if own[i] and not out[i]), default=0)
    dropped, header = [False] * n, [False] * n
    for i in range(1, n):
        p = parent[i]
        dropped[i], header[i] = dropped[p], header[p]
        if header[p] and tag[i] in HEADINGS and in_article[i]:
            dropped[i] = False
        elif not dropped[i]:
            drop, as_header = marks[i]
            if drop and (not soft[i] or i not in wrappers and names[i] > least):
                dropped[i], header[i] = True, as_header

    chars, tags, link_chars, links = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if not dropped[i]:
            chars[i] += own[i]
        if tag[i] == "a":
            link_chars[i], links[i] = chars[i], links[i] + (not dropped[i])
        if i:
            p = parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + (not dropped[i])
            link_chars[p] += link_chars[i]
            links[p] += links[i]
    body = next((i for i in range(n) if tag[i] == "body"), 0)
    if not chars[body]:
        body = 0
    if not chars[body]:
        return ""
    share = link_chars[body] / chars[body]
    density = [_density(chars[i], tags[i], link_chars[i], links[i], share) for i in range(n)]
    sums = [0.0] * n
    for i in range(1, n):
        sums[parent[i]] += density[i]
    inside = [False] * n
    inside[body] = True
    for i in range(body + 1, n):
        inside[i] = inside[parent[i]] if i else False
    best = max((i for i in range(n) if inside[i] and chars[i]), key=lambda i: (sums[i], -i))

    path = [best]
    while path[-1] != body:
        path.append(parent[path[-1]])
    article = next((i for i in path if tag[i] == "article"), None)
    if article is None:
        article = next((i for i in path if _is_main(tag[i], page.attrs[i])), None)
    kept = [False] * n
    if article is not None:
        kept[article] = True
    else:
        threshold = min(density[i] for i in path)
        kept[best], on_path = True, set(path)
        # Other subtrees at or above the threshold.
        for i in range(body + 1, n):
            if inside[i] and i not in on_path and density[i] >= threshold > 0 and parent[i] in on_path:
                kept[i] = True
        if best == body:
            kept = [False] * n
            kept[body] = True
    last_child = [0] * n
    for i in range(1, n):
        before, last_child[parent[i]] = last_child[parent[i]], i
        if kept[parent[i]]:
            # A list of nothing but short links is a menu wherever it stands,
            # unless a heading announces it.
            linked = tag[i] in ("ul", "ol", "div") and links[i] >= 3 and link_chars[i] >= 0.9 * chars[i]
            kept[i] = not linked or tag[before] in HEADINGS or link_chars[i] >= REFERENCE * links[i]

    blocks, line = [], []
    for node, text in page.texts:
        if text is None:
            if line:
                blocks.append(" ".join("".join(line).split()))
                line = []
        elif kept[node] and not dropped[node]:
            line.append(text)
    blocks.append(" ".join("".join(line).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without the html column, with ``text`` and ``n_chars`` added or
    replaced.  One row in, one row out; no shuffle."""
    ship(pages.sparkSession)

    @F.pandas_udf(StringType())
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            yield pd.Series([main_text(s) for s in sources], dtype=object)

    text = pages.withColumn("text", read(F.col(column))).drop(column)
    return text.withColumn("n_chars", F.char_length("text").cast("long"))
