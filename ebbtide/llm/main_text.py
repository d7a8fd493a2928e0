"""Main text of web pages by tag-path ratios.

Texts of blocks, the leaves, are grouped by their path of tags from the root. A path has a text
ratio (characters by leaf) and a punctuation ratio (marks by leaf); both are smoothed along the
page and fused, and paths above a threshold of the fused ratio hold content. The smallest container of those
nodes is the article; inside it all text counts but elements for something else (`ASIDE`), and
what class, id or role mark as aside or what is a list of links, if its paths hold no content
inside the article either. What readers wrote goes by markup alone: it reads like the article.
"""

import re
from collections import defaultdict
from functools import reduce
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import mapped

# The grammar of tags, and what elements mean.
MARKUP = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S
)
MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea title xmp noframes canvas object audio video".split())
# Of these, what holds text alone, with the pattern of its end tag; in the others tags are tags.
RAW_ENDS = {
    tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in "script style noscript iframe textarea title xmp noframes".split()
}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "td th time tt u var wbr".split()
)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote tr figcaption caption ul ol dl table tbody thead tfoot".split())
# Elements that a start tag of the same kind ends.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table body html div article section main".split())
ASIDE = frozenset("head nav footer aside form button select dialog menu fieldset".split())
ASIDE_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments commentlist reply "
    "replies disqus respond related recommended share sharing social newsletter subscribe subscription signup login pagination pager "
    "toolbar widget widgets skip contentinfo complementary search".split()
)
# What readers write goes wherever it stands; the words behind say whether they may write at all.
COMMENT_MARKS = frozenset("comment comments commentlist commentform disqus respond reply replies responses guestbook".split())
COMMENT_STATES = frozenset("open opened closed enabled disabled allowed on off".split())
# Headings are no widgets; words after these say how a page is laid out, as in no-sidebar.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LAYOUT = frozenset("no not has have with without".split())
PAGE_HEAD = frozenset({"header", "masthead", "banner"})
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
# The share of the mean fused ratio that a path needs, and the smoothing weights along the page.
THRESHOLD, KERNEL = 0.5, np.array([0.25, 0.5, 0.25])
LINKS = 0.8


def marks_of(attributes: str) -> tuple[set[str], bool]:
    """Words of an element's class, id and role names, and whether one of these names reader comments."""
    found, comments = set(), False
    for m in MARKS.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = re.split(r"[^a-z0-9]+", name)
            own = {w for before, w in zip(["", *words], words) if before not in LAYOUT}
            comments = comments or bool(own & COMMENT_MARKS) and not own & COMMENT_STATES
            found |= own
    return found, comments


class Page:
    """Elements (tag, parent, whether aside) and text nodes (element, block, text) of a page."""

    def __init__(self, html: str):
        self.tags, self.parents, self.aside, self.depth = ["#"], [0], [False], [0]
        # The nearest element, itself or above, whose attributes alone say that it is aside.
        self.marked = [0]
        # A number for each path from the root, inline tags left out.
        self.numbers: dict[tuple[int, str], int] = {}
        self.outline, self.linked, self.within = [0], [False], [False]
        self.nodes: list[tuple[int, int, str]] = []
        self.block = 0
        self.stack = [0]
        at, skip, m = 0, None, MARKUP.search(html)
        while m:
            if skip is None:
                self._text(html[at : m.start()])
            at = m.end()
            tag = m[2].lower() if m[2] else None
            closed = tag is not None and m[3].endswith("/")
            if tag in RAW_ENDS and not m[1] and not (closed and skip in ("svg", "math")):
                # Without an end tag it is the rest of the page.
                end = RAW_ENDS[tag].search(html, at)
                if end is None:
                    return
                at = end.end()
                self.block += self.tags[-1] not in INLINE
            elif skip is not None:
                if m[1] and tag == skip:
                    skip = None
                    self.block += self.tags[-1] not in INLINE
            elif tag and m[1]:
                self._end(tag)
            elif tag in RAW:
                skip = None if closed and tag in ("svg", "math") else tag
            elif tag:
                self._start(tag, m[3])
            m = MARKUP.search(html, at)
        if skip is None:
            self._text(html[at:])

    def _text(self, raw: str) -> None:
        if raw:
            self.nodes.append((self.stack[-1], self.block, unescape(raw) if "&" in raw else raw))

    def _pop(self, place: int) -> None:
        if any(self.tags[e] not in INLINE for e in self.stack[place:]):
            self.block += 1
        del self.stack[place:]

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self._text(" ")
            elif tag == "hr":
                self.block += 1
            return
        ended = ENDS.get(tag, set()) if tag in INLINE or tag in ENDS else {"p"}
        if tag not in INLINE:
            ended = ended | {"p"}
        for place in range(len(self.stack) - 1, 0, -1):
            own = self.tags[self.stack[place]]
            if own in ended:
                self._pop(place)
                break
            if own in SCOPES:
                break
        if tag not in INLINE:
            self.block += 1
        elif tag in ("td", "th"):
            self._text(" ")
        parent = self.stack[-1]
        marks, comments = marks_of(attributes) if attributes.strip() else (set(), False)
        inside = self.within[parent]
        part = tag not in ("html", "body", "article", "main") and tag not in HEADINGS
        mark = bool(marks & ASIDE_MARKS) and part
        # An article inside an article is what somebody answered to it, if it is marked so.
        off = tag in ASIDE or comments and (part or tag == "article" and inside)
        off = off or not inside and (tag == "header" or bool(marks & PAGE_HEAD) and tag not in ("html", "body", "main"))
        self.tags.append(tag)
        self.parents.append(parent)
        self.aside.append(self.aside[parent] or off)
        self.marked.append(len(self.tags) - 1 if mark else self.marked[parent])
        self.depth.append(self.depth[parent] + 1)
        self.outline.append(self.outline[parent] if tag in INLINE else self._number(self.outline[parent], tag))
        self.linked.append(self.linked[parent] or tag == "a")
        self.within.append(inside or tag == "article")
        self.stack.append(len(self.tags) - 1)

    def _end(self, tag: str) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            if self.tags[self.stack[place]] == tag:
                self._pop(place)
                return
            if tag in INLINE and self.tags[self.stack[place]] not in INLINE:
                return

    def _number(self, parent: int, tag: str) -> int:
        return self.numbers.setdefault((parent, tag), len(self.numbers) + 1)

    def common(self, a: int, b: int) -> int:
        """The smallest element that holds both."""
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.parents[a]
        return a

    def holders(self, element: int) -> list[int]:
        """The element and its ancestors, the root last."""
        found = [element]
        while element:
            element = self.parents[element]
            found.append(element)
        return found


def content_paths(page: Page, nodes: list[tuple[int, int, str]]) -> set[int]:
    """Outlines whose smoothed and fused ratio reaches the threshold; the text of a block is one node."""
    units: dict[int, list] = {}
    for element, block, text in nodes:
        unit = units.setdefault(block, [page.outline[element], 0, 1])
        unit[1] += len(text.strip())
        unit[2] += len(PUNCTUATION.findall(text))
    paths = [u[0] for u in units.values()]
    total: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for path, size, marks in units.values():
        own = total[path]
        own[0], own[1], own[2] = own[0] + size, own[1] + marks, own[2] + 1
    fused = np.ones(len(paths))
    for k in (0, 1):
        ratio = np.array([total[p][k] / total[p][2] for p in paths])
        fused *= np.convolve(np.pad(ratio, 1, mode="edge"), KERNEL, mode="valid")
    level: dict[int, float] = defaultdict(float)
    for path, value in zip(paths, fused.tolist()):
        level[path] += value / total[path][2]
    sizes = [total[p][0] for p in level]
    least = THRESHOLD * np.average(list(level.values()), weights=sizes)
    return {p for p, v in level.items() if v >= min(least, max(level.values()))}


def article(page: Page, nodes: list[tuple[int, int, str]]) -> int:
    """The element that holds the content."""
    paths = content_paths(page, nodes)
    weight: dict[int, int] = defaultdict(int)
    for element, _, text in nodes:
        if page.outline[element] in paths:
            weight[element] += len(text.strip())
    # An element that is marked up as the article, if it holds most of the content; the only one
    # of a page needs a quarter.
    for tag in ("article", "main"):
        held: dict[int, int] = defaultdict(int)
        for element, n in weight.items():
            marked = [e for e in page.holders(element) if page.tags[e] == tag]
            if marked:
                held[marked[-1]] += n
        best = max(held, key=held.__getitem__, default=None)
        if best is not None and (4 if len(held) == 1 else 2) * held[best] >= sum(weight.values()):
            return best
    common = page.holders(reduce(page.common, weight))
    return next(e for e in common if page.tags[e] not in LEAVES and page.tags[e] not in INLINE)


def main_text(html: str | None) -> str:
    page = Page(html or "")
    nodes = [n for n in page.nodes if not page.aside[n[0]]]
    plain = [n for n in nodes if n[2].strip() and not page.marked[n[0]]]
    if not plain:
        return ""
    root = article(page, plain)
    inside = {root}
    for element in range(1, len(page.tags)):
        if page.parents[element] in inside:
            inside.add(element)
    nodes = [n for n in nodes if n[0] in inside]
    paths = content_paths(page, [n for n in nodes if n[2].strip()])
    # Of what attributes mark as aside, that stays whose text is mostly on content paths and not nearly all links.
    held: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for element, _, text in nodes:
        own = held[page.marked[element]]
        own[0] += len(text.strip()) * (page.outline[element] in paths)
        own[1] += len(text.strip())
        own[2] += len(text.strip()) * page.linked[element]
    stays = {m for m, (good, n, a) in held.items() if m not in inside or m == root or 2 * good >= n and a <= LINKS * n}
    linked: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    lists: dict[int, bool] = {}
    blocks: dict[int, list[str]] = {}
    kinds: dict[int, int] = {}
    for element, block, text in nodes:
        if page.marked[element] in stays:
            kind = page.outline[element]
            if kind not in lists:
                lists[kind] = next(page.tags[e] for e in page.holders(element) if page.tags[e] not in INLINE) in ("li", "div")
            blocks.setdefault(block, []).append(text)
            kinds.setdefault(block, kind)
            size = len(text.strip())
            linked[kind][0] += size * page.linked[element]
            linked[kind][1] += size
            linked[kind][2] += 1
    # Lists of links that no markup names: a path of several nodes, nearly all of it links, that is no content path.
    menus = {k for k, (a, n, count) in linked.items() if count >= 3 and lists[k] and a > LINKS * n and k not in paths}
    lines = (" ".join("".join(b).split()) for i, b in blocks.items() if kinds[i] not in menus)
    return "\n".join(line for line in lines if line)


def extracted(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: `page_id`, `url`, `text` and `n_chars`.

    `text` is the article as blocks joined by \\n, white space inside a block as one space, character
    references decoded; it is empty for null and empty pages and where there is no content. Rows
    are neither joined nor shuffled: repeated rows, null ids and urls and further columns change
    nothing, an empty table gives an empty one. A page is parsed whole, in one pass.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))

    def each(part: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in part.column(2).to_pylist()]
        return {"page_id": part.column(0), "url": part.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return mapped(rows, "page_id long, url string, text string, n_chars long", "html", each)
