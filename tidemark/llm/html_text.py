"""Main text of web pages by composite text density.

Each page becomes an element tree. Elements whose role is not article text (menus, page headers and footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) leave it first. Every remaining node gets its link-adjusted
characters per tag; the sums of the children's densities rank the subtrees; the lowest density on the path from the best
subtree to the body is the threshold a subtree must reach to count as text.

Names (class, id) tell roles by any of their words outside of an article. Within one they count only if the whole name, but
for words such as box or list, says so (share-buttons, not related-work); ids of headings never do, nor does a name of a node
that holds most of its article's text. Names of reader comments count unless the node holds the page's first article or
headline.

Defined results: null or empty html, and pages without text, give an empty text; unclosed, stray and wrongly nested tags are
repaired as browsers do: a tag without an end takes the rest of the page along, but a quote that never closes ends at the next
>; time and memory are linear in one page, whatever it holds; equal density sums go to the earlier node.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noframes noembed".split())
#: Elements skipped with all they hold, others of their name included.
SKIPPED = frozenset("noscript template svg math object audio video canvas select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_TEXT = frozenset("head nav footer aside form fieldset button dialog menu input label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations comments comment commentlist disqus replies reply widget toolbar masthead alert paywall pagination pager".split()
)
COMMENT_NAMES = frozenset("comments comment commentlist disqus replies reply".split())
#: Names that say so of a frame outside of the article only, and words that turn a name's meaning.
PAGE_NAMES = frozenset("header topbar logo tagline login skip".split())
TURNS = frozenset("with has no without open opened closed enabled disabled on off allowed count status".split())
#: Words that say what a thing looks like, not what it is.
SHAPES = frozenset(
    "area bar block body bottom box btn button buttons card col column container content footer form group header holder icons inner item items left link links list module outer panel "
    "post posts articles stories right row section slot text title top unit widget widgets wrap wrapper zone author thread respond".split()
)
KEEPS = frozenset("html body main".split())
#: An opening tag of the key closes an open element of the value, up to the nearest boundary.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDARY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
#: Elements that no missing end tag of an inner element reaches across.
CONTAINERS = ("article", "section", "div", "main", "body", "aside", "nav", "footer", "header", "form")
#: End tags that reach across the cells of a table.
ACROSS_CELLS = frozenset("table tr tbody thead tfoot div article main section".split())

#: What follows < and a letter or /: the name, then attributes up to > outside of quotes. Possessive: nothing is read twice.
STRICT = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?=[^\"'\s])|(?=\Z)))*+)>")
LOOSE = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s=\"'/]++)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class _Open:
    """The open elements, with the places of each name among them."""

    def __init__(self, tag: list[str]) -> None:
        self.tag, self.nodes = tag, [0]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: int) -> None:
        name = self.tag[node]
        self.places.setdefault(name, []).append(len(self.nodes))
        if name in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, *names: str) -> int:
        """Place of the innermost element with one of the names, 0 if there is none."""
        return max((own[-1] for n in names if (own := self.places.get(n))), default=0)

    def cut(self, place: int) -> None:
        """Close the element at a place and all within."""
        while len(self.nodes) > place:
            name = self.tag[self.nodes.pop()]
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()


class _Page:
    """Element tree in document order: for node i, parent[i] < i. Every character of the html is looked at a bounded number of times."""

    def __init__(self, html: str) -> None:
        self.parent, self.tag, self.attrs = [-1], ["html"], [""]
        self.pieces: list[tuple[int, str | None]] = []  # (node, text) in document order; None parts two blocks
        self.html, self.unclosed = html, set()
        stack, at, n, form = _Open(self.tag), 0, len(html), STRICT
        while at < n:
            start = html.find("<", at)
            if start < 0:
                start = n
            if start > at:
                self.pieces.append((stack.nodes[-1], html[at:start]))
            if start >= n:
                break
            after = html[start + 1 : start + 3]
            if after[:1] in ("!", "?") or after[:1] == "/" and not after[1:].isalpha():
                at = self._skip_comment(start)
                continue
            if not (after[:1].isascii() and after[:1].isalpha() or after[:1] == "/" and after[1:].isascii()):
                self.pieces.append((stack.nodes[-1], "<"))
                at = start + 1
                continue
            m = form.match(html, start + 1)
            if not m and form is STRICT:  # some quote never closes: from here on quotes mean nothing
                form = LOOSE
                m = form.match(html, start + 1)
            if not m:  # no tag ends any more
                break
            at, name = m.end(), m[2].lower()
            if name in BLOCK or name == "br":
                self.pieces.append((stack.nodes[-1], " " if name == "br" else None))
            if m[1]:
                self._close(stack, name)
            elif name == "html":
                continue
            elif name in RAW and not m[3].endswith("/"):
                at = self._raw_end(name, at)
            elif name in SKIPPED and not m[3].endswith("/"):
                at = self._skipped_end(name, at)
            else:
                self._open(stack, name, m[3])

    def _skip_comment(self, start: int) -> int:
        html, n = self.html, len(self.html)
        if html.startswith("<!--", start):
            if html.startswith(("<!-->", "<!--->"), start):
                return html.index(">", start) + 1
            end = re.compile("--!?>").search(html, start + 4)
            return end.end() if end else n
        end = html.find(">", start)
        return end + 1 if end >= 0 else n

    def _raw_end(self, name: str, at: int) -> int:
        """Behind the end tag of an element that holds no elements; without one it holds the rest."""
        end = None if name in self.unclosed else re.compile(rf"</{name}(?=[\s/>])", re.I).search(self.html, at)
        if not end:
            self.unclosed.add(name)
            return len(self.html) if name in ("script", "style", "textarea", "title") else at
        close = self.html.find(">", end.end())
        return close + 1 if close >= 0 else len(self.html)

    def _skipped_end(self, name: str, at: int) -> int:
        """Behind the end tag that belongs to an element; without one only its opening tag goes."""
        if name in self.unclosed:
            return at
        depth = 1
        for m in re.compile(rf"<(/?){name}(?=[\s/>])", re.I).finditer(self.html, at):
            depth += -1 if m[1] else 1
            if not depth:
                close = self.html.find(">", m.end())
                return close + 1 if close >= 0 else len(self.html)
        self.unclosed.add(name)
        return at

    def _open(self, stack: _Open, name: str, attrs: str) -> None:
        if name in BLOCK:
            self._drop(stack, ("p",), ("table", "td", "th", "button"))
        if name in CLOSES:
            self._drop(stack, CLOSES[name], BOUNDARY[name])
        if name == "body":
            self._drop(stack, ("head",), ())
        self.parent.append(stack.nodes[-1])
        self.tag.append(name)
        self.attrs.append(attrs)
        if name not in VOID:
            stack.push(len(self.tag) - 1)

    def _drop(self, stack: _Open, names: tuple[str, ...], until: tuple[str, ...]) -> None:
        """Close the innermost open element with one of the names unless a boundary stands above it."""
        place = stack.last(*names)
        if place and place > stack.last(*(x for x in (*until, *CONTAINERS) if x not in names)):
            stack.cut(place)

    def _close(self, stack: _Open, name: str) -> None:
        if name in ("html", "body"):
            return
        place = stack.last(name)
        if not place or name not in BLOCK and stack.blocks and stack.blocks[-1] > place:
            return
        if name in ACROSS_CELLS or place >= stack.last("body", "td", "th"):
            stack.cut(place)

    def _named(self, name: str, within: bool, heading: bool) -> frozenset[str]:
        """What a class or id name says of its node's role."""
        words = [w.lower() for w in WORDS.findall(name)]
        if TURNS.intersection(words):
            return frozenset()
        if not within:
            return (NAMES | PAGE_NAMES).intersection(words)
        told = [w for w in words if not w.isdigit() and w not in SHAPES] or words
        return frozenset() if heading or not NAMES.issuperset(told) else NAMES.intersection(words)

    def unwanted(self) -> list[bool]:
        """Nodes that are no article text by their role, with all below them."""
        n, tag, parent = len(self.tag), self.tag, self.parent
        article, named, out = [0] * n, [frozenset()] * n, [False] * n  # article: the innermost one, or 0
        for i in range(n):
            attrs = self.attrs[i]
            article[i] = i if tag[i] in ("article", "main") else article[parent[i]] if i else 0
            if tag[i] in NEVER_TEXT or tag[i] == "header" and not article[i]:
                out[i] = True
            if not attrs or tag[i] in KEEPS:
                continue
            for key, value in ATTRIBUTE.findall(attrs):
                key, value = key.lower(), value.strip("\"'")
                if key in ("class", "id"):
                    for name in value.split():
                        named[i] |= self._named(name, bool(article[i]), key == "id" and tag[i] in HEADINGS)
                elif key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    out[i] = True
                elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    out[i] = True
        # A name says nothing about a frame that holds the article itself, or most of its article's text.
        holds, first = [False] * n, [False] * n
        for name in ("article", "main", "h1"):
            i = tag.index(name) if name in tag else 0
            while i > 0 and not first[parent[i]]:
                i = parent[i]
                first[i] = True
        size = [0] * n
        for i, text in self.pieces:
            size[i] += len(text or "")
        for i in range(n - 1, 0, -1):
            size[parent[i]] += size[i]
            own = tag[i] in ("article", "main", "h1") and not named[i] & COMMENT_NAMES
            if own or holds[i]:
                holds[parent[i]] |= own or not named[i] & COMMENT_NAMES
        for i in range(1, n):
            comments = named[i] & COMMENT_NAMES and not first[i]
            most = article[i] and article[i] != i and 2 * size[i] > size[article[i]]
            other = named[i] - COMMENT_NAMES and not holds[i] and tag[i] != "article" and not most
            out[i] |= out[parent[i]] or bool(comments) or bool(other)
        return out


def main_text(html: str | None) -> str:
    """The article of one page; see the module's text."""
    if not html:
        return ""
    page = _Page(html)
    tag, parent, n = page.tag, page.parent, len(page.tag)
    out = page.unwanted()
    pieces = [(i, t and unescape(t)) for i, t in page.pieces if t is None or not out[i]]
    link = [False] * n
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        link[i] = tag[i] == "a" or link[parent[i]]
    for i, text in pieces:
        if text is None:
            continue
        size = len("".join(text.split()))
        chars[i] += size
        link_chars[i] += size if link[i] else 0
    for i in range(n - 1, 0, -1):
        if not out[i]:
            p = parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i] + (tag[i] == "a")
    body = next((i for i in range(n) if tag[i] == "body"), 0)
    if not chars[body]:
        body = 0
    if not chars[body]:
        return ""
    share = link_chars[body] / chars[body]

    def density(i: int) -> float:
        c, t = chars[i], max(tags[i], 1)
        if not c or not share:
            return c / t
        base = log(c / max(c - link_chars[i], 1) * link_chars[i] + share * c + e)
        return c / t * log(c / max(link_chars[i], 1) * t / max(link_tags[i], 1)) / log(base)

    value = [0.0 if out[i] else density(i) for i in range(n)]
    # Inline elements are no subtrees of their own.
    stands = [not out[i] and (tag[i] in BLOCK or i == body) for i in range(n)]
    total = [0.0] * n
    for i in range(1, n):
        if stands[i]:
            total[parent[i]] += value[i]
    for i in range(n):  # a leaf is its own only part
        total[i] = total[i] or value[i]
    inside = [i == body for i in range(n)]
    for i in range(body + 1, n):
        inside[i] = inside[parent[i]]
    best = max((i for i in range(n) if inside[i] and stands[i]), key=lambda i: (total[i], -i))
    threshold, i = value[best], best
    while i != body:
        i = parent[i]
        threshold = min(threshold, value[i])
    # The node of each subtree with the largest sum, found from the leaves up.
    top = list(range(n))
    for i in range(n - 1, body, -1):
        p = parent[i]
        if inside[i] and stands[top[i]] and (not stands[top[p]] or (total[top[i]], -top[i]) > (total[top[p]], -top[p])):
            top[p] = top[i]
    kept = [False] * n
    for i in range(body, n):
        if inside[i] and stands[i] and chars[i] and (value[i] >= threshold or tag[i] == "h1"):
            kept[top[i]] = True
    # A subtree that lies in a marked-up article stands for all of it; the headline belongs to the article.
    holds = list(kept)
    for i in range(n - 1, body, -1):
        if holds[i]:
            kept[i] |= tag[i] in ("article", "main")
            holds[parent[i]] = True
    for i in range(body + 1, n):
        kept[i] = kept[i] or kept[parent[i]]
    blocks, words = [], []
    for i, text in pieces:
        if text is None:
            blocks.append("".join(words))
            words = []
        elif kept[i]:
            words.append(text)
    blocks.append("".join(words))
    return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def _texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for html in batches:
        yield html.map(main_text, na_action=None)


def extract_main_text(pages: DataFrame, html: str = "html", text: str = "text", length: str = "n_chars") -> DataFrame:
    """pages with two columns more: the article of each page's html and its length in code points. No shuffle."""
    extract = F.pandas_udf(_texts, "string")
    return pages.withColumn(text, extract(F.col(html))).withColumn(length, F.length(text).cast("long"))
