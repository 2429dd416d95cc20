"""Main text of web pages by composite text density.

A page becomes a tree of its tags. For every node, characters per tag are weighed by how much of them is link text: many
links in few characters push the composite density down. A node's density sum adds up the densities of its children; the
article's container has the largest one. The lowest density on the path from there to the body is the threshold: inside the
chosen subtree, lists below it that are mostly links go, and so do divs and the like without a heading or paragraph.

Hidden elements, scripts, controls, navigation and the like take no part in the densities. What only names itself as
something else by class, id or role (menus, sidebars, notices, adverts, comments), and forms, take no part either, unless
they hold an h1, a main element, the page's longest article, or most of the body's characters outside links (the last does
not count beside an article or main element that holds text). If nothing else holds text, names do not count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the void elements, and the elements that start a block, of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
# an open element is closed by the start of one of these
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "head": frozenset(["body"]),
}
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
SCOPES = frozenset(["table", "ul", "ol", "dl", "select", "body", "html", "article", "section", "div", "main"])
NEVER_TEXT = frozenset(
    "head title script style noscript template iframe object embed canvas svg math audio video map button input select"
    " textarea label datalist output dialog nav aside footer menu".split()
)
FORMS = frozenset(["form", "fieldset"])
# names of class, id and role (whole ones, or the last word of one) of a part which is not the article
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu menus"
    " breadcrumb breadcrumbs pagination pager sidebar sidebars aside footer foot masthead topbar toolbar comment comments"
    " disqus respond reply replies discussion share sharing social related recommended recommendations newsletter subscribe"
    " subscription signup login search searchbox widget widgets skip complementary contentinfo dialog".split()
)
# words that may follow: related-posts; and words that tell of something beside: no-sidebar, has-comments
PLACES = frozenset(
    "area bar block body box button buttons container content form group holder icon icons inner item items label link links list"
    " outer panel post posts row section slot text title unit wrap wrapper".split()
)
BESIDE = frozenset("no not non without with has have is".split())
LISTS = frozenset("ul ol dl dir menu".split())
GROUPS = frozenset("div section table center details".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figcaption".split())
CONTAINERS = frozenset(["article", "main"])
ROOTS = frozenset(["html", "body", "article", "main"])
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _is_never(tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether the element is no part of an article whatever it holds; ``inside``: within an article or main element."""
    if tag in ROOTS:
        return False
    if tag in NEVER_TEXT or tag == "header" and not inside:
        return True
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if value and name == "style" and _HIDDEN.search(value):
            return True
    return False


def _is_named(tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether the element calls itself something else than an article, or is a form."""
    if tag in ROOTS:
        return False
    if tag in FORMS:
        return True
    for name, value in attributes:
        if value and name in ("class", "id", "role"):
            for own in value.split():
                words = _WORDS.findall(_CAMEL.sub(" ", own).lower())
                telling = [w in NOT_ARTICLE or w == "header" and not inside for w in words]
                if any(telling) and BESIDE.isdisjoint(words):
                    if telling[-1] or all(t or w in PLACES for t, w in zip(telling, words, strict=True)):
                        return True
    return False


class _Tree(HTMLParser):
    """Nodes in page order: ``parent`` comes before child; ``parts`` are (node, text or None at a block's edge)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.inside = ["#"], [-1], [False]
        self.never, self.named, self.other = [False], [False], [False]
        self.open = [0]
        self.parts: list[tuple[int, str | None]] = []

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        above = self.open[-1]
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(above)
        inside = self.inside[above] or tag in CONTAINERS
        self.inside.append(inside)
        self.never.append(self.never[above] or _is_never(tag, attrs, inside))
        self.named.append(_is_named(tag, attrs, inside))
        if tag in BLOCKS:
            self.parts.append((node, None))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash ends void elements only

    def _close_implied(self, tag):
        if self.tag[self.open[-1]] == "head" and tag not in IN_HEAD:
            self._close_from(len(self.open) - 1)
        if tag in ENDS_P:
            self._close("p", SCOPES)
        for at in range(len(self.open) - 1, 0, -1):
            own = self.tag[self.open[at]]
            if tag in ENDED_BY.get(own, ()):
                self._close_from(at)
            elif own in SCOPES:
                break

    def _close(self, tag, stop=frozenset()):
        for at in range(len(self.open) - 1, 0, -1):
            own = self.tag[self.open[at]]
            if own == tag:
                self._close_from(at)
                return
            if own in stop:
                return

    def _close_from(self, at):
        if any(self.tag[n] in BLOCKS for n in self.open[at:]):
            self.parts.append((self.open[at], None))
        del self.open[at:]

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data):
        if self.tag[self.open[-1]] == "head" and not data.isspace():
            self._close_from(len(self.open) - 1)
        self.parts.append((self.open[-1], data))


def others(tree: _Tree, sizes: list[tuple[int, int]], in_link: list[bool]) -> list[bool]:
    """Whether each node takes no part; ``sizes``: the characters of each text with its node."""
    n = len(tree.tag)
    plain, marked = [0] * n, [False] * n
    for node, size in sizes:
        if not tree.never[node] and not in_link[node]:
            plain[node] += size
    for node in range(n - 1, 0, -1):
        plain[tree.parent[node]] += plain[node]
    articles = [i for i in range(n) if tree.tag[i] == "article" and not tree.never[i]]
    longest = max(articles, key=lambda i: (plain[i], -i), default=None)
    for node in range(n - 1, 0, -1):
        if not tree.never[node] and (tree.tag[node] in ("h1", "main") or node == longest):
            marked[node] = True
        if marked[node]:
            marked[tree.parent[node]] = True
    body = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    told = any(plain[i] and tree.tag[i] in CONTAINERS and not tree.never[i] for i in range(n))
    other = [False] * n
    for node in range(1, n):
        beside = told and not tree.inside[node]  # the article has an element of its own, this one lies outside
        named = tree.named[node] and not marked[node] and (beside or 2 * plain[node] <= plain[body])
        other[node] = other[tree.parent[node]] or tree.never[node] or named
    if plain[body] and not any(size and not other[node] for node, size in sizes):
        return tree.never
    return other


def densities(tree: _Tree) -> tuple[list[float], list[float], list[bool]]:
    """Composite density and density sum of every node, and whether most of its characters are links."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = in_link[tree.parent[node]] or tree.tag[node] == "a"
    sizes = [(node, len("".join(text.split()))) for node, text in tree.parts if text]
    tree.other = others(tree, sizes, in_link)
    for node, size in sizes:
        if not tree.other[node]:
            chars[node] += size
            link_chars[node] += size if in_link[node] else 0
    for node in range(n - 1, 0, -1):
        if tree.other[node]:
            continue
        above = tree.parent[node]
        chars[above] += chars[node]
        link_chars[above] += link_chars[node]
        tags[above] += tags[node] + 1
        link_tags[above] += link_tags[node] + (tree.tag[node] == "a")
    body = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    share = link_chars[body] / max(1, chars[body])
    density, sums = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        if not tree.other[node] and chars[node]:
            c, t = chars[node], max(1, tags[node])
            lc, lt = max(1, link_chars[node]), max(1, link_tags[node])
            base = math.log(c / max(1, c - link_chars[node]) * link_chars[node] + share * c + math.e)
            ratio = c / lc * t / lt
            density[node] = c / t * (math.log(ratio) / math.log(base) if ratio > 1 and base > 1 else 0.0 if ratio <= 1 else math.log(ratio))
            if node:
                sums[tree.parent[node]] += density[node]
    mostly_links = [2 * link_chars[i] > chars[i] for i in range(n)]
    return density, sums, mostly_links


def main_text(page: str | None) -> str:
    """The main text: blocks in page order, joined by a line feed, white space in a block as one space.

    Empty for null and empty pages, for pages without text, and if nothing but menus and the like holds text.
    """
    if not page:
        return ""
    tree = _Tree()
    tree.feed(page)
    tree.close()
    density, sums, mostly_links = densities(tree)
    nodes = range(len(tree.tag))
    body = next((i for i in nodes if tree.tag[i] == "body"), 0)
    best = max((i for i in nodes if i >= body and not tree.other[i]), key=lambda i: (sums[i], -i), default=body)
    if not sums[best]:  # no element holds text: plain text in the body
        best = body
    path, node = [best], best
    while node not in (body, 0):
        node = tree.parent[node]
        path.append(node)
    least = min((density[i] for i in path if density[i]), default=0.0)
    chosen = next((i for i in path if tree.tag[i] == "article"), None) or next((i for i in path if tree.tag[i] == "main"), best)
    prose = [tag in PROSE and not tree.other[i] for i, tag in enumerate(tree.tag)]
    for node in reversed(nodes[1:]):
        prose[tree.parent[node]] = prose[tree.parent[node]] or prose[node]
    kept = [False] * len(tree.tag)
    for node in nodes:
        above = tree.parent[node]
        if node == chosen or node and kept[above] and not tree.other[node]:
            group = tree.tag[node] in LISTS or tree.tag[node] in GROUPS and not prose[node]
            links = group and mostly_links[node] and density[node] < least
            kept[node] = node == chosen or not links
    blocks, words = [], []
    for node, text in tree.parts:
        if text is None:
            blocks.append("".join(words))
            words = []
        elif kept[node]:
            words.append(text)
    blocks.append("".join(words))
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def main_text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text)

    return extracted(F.coalesce(html, F.lit("")).cast("string"))


def extract_pages(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Each page is read whole and by itself; null counts as empty, null ids and repeated rows are kept, very long pages are
    cut nowhere, other columns are not read, and an empty table gives an empty result.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), main_text_column(F.col(html)).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
