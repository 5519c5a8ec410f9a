"""Main text of web pages by composite text density.

Each page becomes a small tree without scripts and styles, and without forms and elements that say of themselves that
they are navigation, adverts, notices or comments, unless these hold the core or most of the text outside links (and
the largest ``article`` or ``main``, if there is one). For every node the composite density is its characters per tag, lowered
by the share of them that is in links; a node's density sum adds up its children. The node with the largest sum is
the core of the article. The lowest density on its path to the body is the threshold by which elements beside that
path belong to the article too; an ``article`` or ``main`` element on the path is taken whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer head iframe input map math menu nav noembed noframes noscript object "
    "optgroup option script select style svg template textarea title video".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search searchbox status tablist toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id values that name what is not the article.
NAMED = frozenset(
    "ad ads adbox adsense adslot advert advertisement advertising adverts banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices "
    "notification notifications pager pagination popup promo promoted promotion recommended related replies reply respond search share "
    "sharing sidebar sidebars signup skyscraper social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
# What an opening tag closes, and the elements that stop the search for it.
CLOSES = {
    **dict.fromkeys("li".split(), (("li",), ("ul", "ol", "menu", "dir"))),
    **dict.fromkeys("dt dd".split(), (("dt", "dd"), ("dl",))),
    **dict.fromkeys("td th".split(), (("td", "th"), ("tr", "table"))),
    **dict.fromkeys("tr".split(), (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot"))),
    **dict.fromkeys("tbody thead tfoot".split(), (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",))),
    **dict.fromkeys("option optgroup".split(), (("option",), ("select", "datalist"))),
}
ENDS_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption legend summary".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_BREAK = -1


def _unwanted(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element goes whatever it holds, and whether it goes unless it holds the article."""
    if tag in DROPPED:
        return True, False
    if tag == "header":
        return not in_article, False  # the heading of an article belongs to it
    named = tag == "form"
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, named
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden":
            return True, False
        if name == "role" and value.strip().lower() in ROLES:
            named = True
        if name in ("class", "id"):
            words = {w.lower() for w in _PARTS.findall(value)}
            if words & NAMED or {"side", "bar"} <= words or ("header" in words and not in_article):
                named = True
    return False, named


class _Tags:
    """Where tags end. A broken page may hold any number of tags that never do; what one search has seen, the next ones do
    not look at again, so that a page is read in linear time."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.mark, self.marked_from, self.bracket = -1, 0, -1
        self.lost: set[int] = set()  # opening quotes from which no tag ends

    def next_bracket(self, at: int) -> int:
        """The next ``>``; there is one."""
        if self.bracket < at:
            self.bracket = self.html.find(">", at)
        return self.bracket

    def _next_mark(self, at: int) -> int:
        found = _MARK.search(self.html, at)
        return found.start() if found else len(self.html)

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``: one outside quotes, else the next one."""
        if not self.marked_from <= at <= self.mark:
            self.marked_from, self.mark = at, self._next_mark(at)
        mark, tried = self.mark, []
        while mark < len(self.html) and mark not in self.lost:
            if self.html[mark] == ">":
                return mark
            tried.append(mark)
            closing = self.html.find(self.html[mark], mark + 1)
            mark = self._next_mark(closing + 1) if closing >= 0 else len(self.html)
        self.lost.update(tried)
        return self.next_bracket(at)


class _Page:
    """The tree as parallel lists; a parent always comes before its children."""

    def __init__(self, html: str):
        self.tags, self.parents, self.drop, self.named, self.own = ["#root"], [0], [False], [False], [0]
        self.items: list[tuple[int, str]] = []  # text in page order with its node, or a break between blocks
        self.stack, self.articles = [0], 0
        # places in the stack of the open elements of each name, and of open blocks
        self.open: dict[str, list[int]] = defaultdict(list)
        self.open_blocks = [0]
        tags, at, look, end = _Tags(html), 0, 0, len(html)
        while at < end:
            i = html.find("<", look)
            if i < 0 or i > tags.last:  # no tag ends from here on; a comment may still begin
                comment = html.find("<!--", i) if i >= 0 else -1
                self.text(html[at:comment if comment >= 0 else end])
                break
            name = None
            if html.startswith("<!--", i):
                stop = html.find("-->", i + 4)
                after = stop + 3 if stop >= 0 else end
            elif name := _NAME.match(html, i):
                stop = tags.end(name.end())
                after = stop + 1
            elif html[i + 1] in "!?/":
                after = tags.next_bracket(i + 2) + 1
            else:
                look = i + 1
                continue
            if i > at:
                self.text(html[at:i])
            at = look = after
            if not name:
                continue
            tag = name[2].lower()
            if name[1]:
                self.close(tag)
                continue
            self.start(tag, html[name.end():stop])
            if tag in RAW:  # no markup inside, up to its own end tag
                found = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                at = look = found.start() if found else end
                if not found:
                    self.close(tag)

    def text(self, raw: str) -> None:
        node = self.stack[-1]
        if not self.drop[node]:
            text = unescape(raw) if "&" in raw else raw
            self.items.append((node, text))
            self.own[node] += len(" ".join(text.split()))

    def pop(self) -> None:
        tag = self.tags[self.stack.pop()]
        self.open[tag].pop()
        self.articles -= tag in ("article", "main")
        if tag in BLOCKS:
            self.open_blocks.pop()
            self.items.append((_BREAK, ""))

    def pop_to(self, names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        """Closes the outermost element of ``names`` that is inside the innermost one of ``stops``."""
        stop = max((self.open[s][-1] for s in stops if self.open[s]), default=0)
        inside = [self.open[n][bisect_right(self.open[n], stop)] for n in names if self.open[n] and self.open[n][-1] > stop]
        while inside and len(self.stack) > min(inside):
            self.pop()

    def start(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P and self.open["p"]:
            self.pop_to(("p",), ("table", "td", "th", "button"))
        if tag in CLOSES:
            self.pop_to(*CLOSES[tag])
        if tag in BLOCKS:
            self.items.append((_BREAK, ""))
        parent = self.stack[-1]
        if tag == "br":
            self.items.append((parent, " "))
        self.tags.append(tag)
        self.parents.append(parent)
        self.own.append(0)
        drop, named = _unwanted(tag, attributes, self.articles > 0)
        self.drop.append(self.drop[parent] or drop)
        self.named.append(named)
        if tag not in VOID:
            self.open[tag].append(len(self.stack))
            if tag in BLOCKS:
                self.open_blocks.append(len(self.stack))
            self.stack.append(len(self.tags) - 1)
            self.articles += tag in ("article", "main")

    def close(self, tag: str) -> None:
        if not self.open[tag] or tag in VOID or tag in ("html", "body"):
            return  # what follows </body> still belongs to the page
        place = self.open[tag][-1]
        if tag not in BLOCKS and place < self.open_blocks[-1]:
            return  # an inline end tag does not reach out of its block
        while len(self.stack) > place:
            self.pop()

    def densities(self, kept: list[bool]) -> tuple[list[int], list[int], list[float], int, int]:
        """Characters, those in links and density of each node, the end of paths, and the core."""
        tags, parents, n = self.tags, self.parents, len(self.tags)
        chars, count, link_chars, link_count = [own if k else 0 for own, k in zip(self.own, kept, strict=True)], [0] * n, [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            if kept[i]:
                up, is_link = parents[i], tags[i] == "a"
                if is_link:
                    link_chars[i], link_count[i] = chars[i], link_count[i] + 1
                chars[up] += chars[i]
                count[up] += count[i] + 1
                link_chars[up] += link_chars[i]
                link_count[up] += link_count[i]
        body = next((i for i in range(n) if tags[i] == "body"), 0)
        top = body if chars[body] == chars[0] else 0
        share = link_chars[top] / max(chars[top], 1)

        def composite(c: int, t: int, lc: int, lt: int) -> float:
            base = log(c / max(c - lc, 1) * max(lc, 1) + share * c + e)
            return c / max(t, 1) * log(1 + c / max(lc, 1) * max(t, 1) / max(lt, 1)) / log(base + 1)

        density = [composite(chars[i], count[i], link_chars[i], link_count[i]) if kept[i] else 0.0 for i in range(n)]
        # text that stands directly in a node counts like a child
        sums = [composite(own, 1, 0, 0) if k and tag != "a" else 0.0 for own, k, tag in zip(self.own, kept, tags, strict=True)]
        for i in range(n - 1, 0, -1):
            if kept[i]:
                sums[parents[i]] += density[i]
        return chars, link_chars, density, top, max(range(n), key=lambda i: (sums[i], -i))

    def main_text(self) -> str:
        tags, parents, n = self.tags, self.parents, len(self.tags)
        kept = [not d for d in self.drop]
        chars, link_chars, density, top, core = self.densities(kept)
        if any(self.named):
            holds = {core}
            while core:
                core = parents[core]
                holds.add(core)
            plain = [c - lc for c, lc in zip(chars, link_chars, strict=True)]
            # a page that marks its article may have longer adverts or comments beside it
            marked = [i for i in range(n) if kept[i] and tags[i] in ("article", "main") and plain[i]]
            article, around = max(marked, key=lambda i: (plain[i], -i), default=0), set()
            at = article
            while at:
                around.add(at)
                at = parents[at]
            for i in range(1, n):
                gone = self.named[i] and not ((i in holds or 2 * plain[i] > plain[0]) and (not article or i in around))
                kept[i] = kept[i] and kept[parents[i]] and not gone
            chars, link_chars, density, top, core = self.densities(kept)
        path = [core]
        while path[-1] != top and path[-1] != 0:
            path.append(parents[path[-1]])
        whole = next((i for i in path if tags[i] == "article"), None) or next((i for i in path if tags[i] == "main"), None)
        if whole is not None:
            taken = {whole}
        else:
            threshold, on_path = min(density[i] for i in path), set(path[1:])
            taken = {core} | {i for i in range(1, n) if kept[i] and parents[i] in on_path and i not in on_path and density[i] >= threshold > 0}
            taken |= {i for i in range(1, core) if kept[i] and tags[i] in HEADINGS and parents[i] in on_path}  # its title, however short
            taken |= {-i - 1 for i in on_path if self.own[i]}  # text that stands directly in an element of the path
        inside = [False] * n
        for i in range(n):
            inside[i] = kept[i] and (i in taken or (i > 0 and inside[parents[i]]))
        blocks, block = [], []
        for node, text in self.items:
            if node == _BREAK:
                if block:
                    blocks.append(" ".join("".join(block).split()))
                    block = []
            elif inside[node] or -node - 1 in taken:
                block.append(text)
        if block:
            blocks.append(" ".join("".join(block).split()))
        return "\n".join(b for b in blocks if b)


def main_text(html: str | None) -> str:
    """The article of a page: one line per block; empty for null, empty and text-free pages."""
    return _Page(html).main_text() if html else ""


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``pages`` with ``text_col`` and ``size_col`` (its code points) in place of ``html_col``.

    Other columns pass through, except ones named like the two new columns, which are replaced. Repeated rows give
    repeated results, a null or empty page an empty text, an empty table no rows. Whole pages of any length and depth are
    read; the work is per row, so nothing is shuffled.
    """
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h) for h in htmls], dtype=object)

    rest = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower(), size_col.lower())]
    # the iterator form lets a worker start once per task; asNondeterministic keeps the text from being computed twice
    out = pages.select(*rest, texts.asNondeterministic()(F.col(html_col)).alias(text_col))
    return out.withColumn(size_col, F.char_length(text_col).cast("long"))
