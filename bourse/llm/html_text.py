"""Main text of web pages by composite text density.

A page is read into a light tree.  What is marked as not being the article
(menus, adverts, scripts, ...) is set aside.  Every block node gets its
composite text density: characters per tag, adjusted for the share of link text
in the node and in the body.  A node's density sum adds the densities of its
block children.  The node with the largest sum is the centre, and the smallest
density on the path from it to the body is the threshold: the centre is content,
and beside the path every branch that reaches it.

Tags do not choose, they check what the sums chose.  A lone ``main`` with its
share of the text bounds the search.  A centre inside an ``article`` grows to the
whole article, beside which other articles that reach the threshold stay; a
centre around articles that hold most of its text shrinks to those.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values of HTML ------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Content that is text up to the element's own end tag.
RAW = frozenset("script style textarea title xmp noembed noframes iframe noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
# A start tag on the left ends an open element on the right, up to the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Blocks that end an open paragraph.
ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "optgroup", "option", "legend"}

# --- what is not the article -----------------------------------------------------------------------

ASIDE_TAGS = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video nav footer aside form button select "
    "textarea menu dialog fieldset".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
# Words of a class or id (cut at anything but letters) that mark an element as not being the article, as long as
# its text agrees: with the first it is short or mostly links, with the second other text of the page is left.
LAYOUT_WORDS = frozenset(
    "banner sidebar nav navbar navigation menu footer masthead notice notices alert social related recommended widget widgets".split()
)
PURPOSE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion breadcrumb breadcrumbs comment comments respond "
    "disqus cookie cookies consent gdpr popup modal overlay share sharing newsletter subscribe subscription signup login pagination "
    "pager".split()
)
BY_TAG, BY_LAYOUT, BY_PURPOSE = 1, 2, 3  # why an element is set aside
SHORT_TEXT = 300  # characters outside links and white space, below which a name of layout is believed
LINK_SHARE = 0.5  # share of link text above which it is believed too
REST_SHARE = 0.1  # least share of the page's text outside links that is left when a name of purpose is believed
MAIN_SHARE = 0.2  # least share of the page's text outside links with which a lone main bounds the search
ARTICLES_SHARE = 0.5  # least share of the centre's text outside links that articles in it must hold to be the content

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile("[a-z]+")


def _aside(tag: str, attributes: str) -> int:
    """Why an element is set aside, or 0."""
    if tag in ASIDE_TAGS:
        return BY_TAG
    if tag in ("html", "body", "main") or not attributes.strip():
        return 0
    by_name = 0
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "role" and value in ASIDE_ROLES or name == "aria-hidden" and value == "true":
            return BY_TAG
        if name == "style" and "display:none" in value.replace(" ", ""):
            return BY_TAG
        if name in ("class", "id"):
            words = WORDS.findall(value)
            if not PURPOSE_WORDS.isdisjoint(words):
                by_name = BY_PURPOSE
            elif not LAYOUT_WORDS.isdisjoint(words):
                by_name = by_name or BY_LAYOUT
    return by_name


class Page:
    """The tree of a page as parallel lists; a node's children follow it, and ``events`` hold texts and block ends."""

    def __init__(self, html: str):
        self.tag, self.parent, self.aside = ["#root"], [-1], [0]
        self.span = [[0, 0]]  # the node's events
        self.events: list[tuple[int, str | None]] = []  # (node, text), or (node, None) where a block starts or ends
        self.places: dict[str, list[int]] = {}  # per tag, where its open elements stand in the stack
        self._read(html)

    def _open(self, tag: str, attributes: str, stack: list[int]) -> int:
        if tag in ENDS_P:
            self._end({"p"}, stack, {"td", "th", "table", "button", "object"})
        if tag in CLOSES:
            closed, limits = CLOSES[tag]
            while self._end(closed, stack, limits):
                pass
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(stack[-1])
        header = tag == "header" and self._innermost(("article", "main")) < 0
        self.aside.append(BY_TAG if header else _aside(tag, attributes))
        if tag in BLOCK:
            self.events.append((node, None))
        self.span.append([len(self.events), len(self.events)])
        return node

    def _innermost(self, tags) -> int:
        """The place in the stack of the innermost open element of these tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _push(self, node: int, stack: list[int]) -> None:
        self.places.setdefault(self.tag[node], []).append(len(stack))
        stack.append(node)

    def _end(self, tags, stack: list[int], limits=frozenset()) -> bool:
        """End the innermost open element of these tags and all inside it, if no limit stands between."""
        place = self._innermost(tags)
        if place < 0 or place < self._innermost(limits):
            return False
        while len(stack) > place:
            node = stack.pop()
            self.places[self.tag[node]].pop()
            self._close(node)
        return True

    def _close(self, node: int) -> None:
        self.span[node][1] = len(self.events)
        if self.tag[node] in BLOCK:
            self.events.append((node, None))

    def _read(self, html: str) -> None:
        stack, at, n = [0], 0, len(html)
        text_from = 0

        def text(upto: int) -> None:
            if upto > text_from:
                self.events.append((stack[-1], unescape(html[text_from:upto])))

        while True:
            at = html.find("<", at)
            if at < 0:
                text(n)
                break
            if html.startswith("<!--", at):
                text(at)
                end = html.find("-->", at + 4)
                at = text_from = n if end < 0 else end + 3
                continue
            m = TAG.match(html, at)
            if m is None:
                after = html[at + 1 : at + 3]
                if after[:1] in ("!", "?") or after[:1] == "/" and not after[1:2].isalpha():
                    text(at)  # a declaration or a bogus comment
                    end = html.find(">", at)
                    at = text_from = n if end < 0 else end + 1
                elif after[:1].isalpha() and after[:1].isascii() or after[:1] == "/":
                    text(at)  # a tag that the page's end cuts off
                    break
                else:
                    at += 1
                continue
            text(at)
            at = text_from = m.end()
            slash, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            tag = tag.lower()
            if slash:
                if tag not in VOID:
                    self._end((tag,), stack)
                continue
            node = self._open(tag, attributes, stack)
            if tag in VOID:
                if tag == "br":
                    self.events.append((stack[-1], " "))
                self._close(node)
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = text_from = end.start() if end else n
                self._push(node, stack)
            else:
                self._push(node, stack)
        for node in reversed(stack):
            self._close(node)

    def main_text(self) -> str:
        count = len(self.tag)
        # asides that hold an article are not asides, nor is a form around a whole page
        holds, paragraphs = [t in ("article", "main") for t in self.tag], [int(t == "p") for t in self.tag]
        for i in range(count - 1, 0, -1):
            p = self.parent[i]
            holds[p] |= holds[i] and not (self.tag[i] == "article" and self.aside[i])
            paragraphs[p] += paragraphs[i]
        in_link = [False] * count
        for i in range(1, count):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
        sizes = [(node, len("".join(text.split()))) for node, text in self.events if text is not None]
        out = [False] * count

        def set_aside(reasons) -> None:
            for i in range(1, count):
                inside = holds[i] and self.tag[i] != "article" or self.tag[i] in ("form", "fieldset") and paragraphs[i] >= 3
                out[i] = out[self.parent[i]] or self.aside[i] in reasons and not inside

        set_aside({BY_TAG})
        if any(a > BY_TAG for a in self.aside):
            self._believe_names(sizes, in_link, out)
            set_aside({BY_TAG, BY_LAYOUT, BY_PURPOSE})
        chars, tags, link_chars, link_tags = [0] * count, [0] * count, [0] * count, [0] * count
        for i in range(1, count):
            if not out[i]:
                tags[i] = 1
                link_tags[i] = int(self.tag[i] == "a")
        for node, size in sizes:
            if not out[node]:
                chars[node] += size
                link_chars[node] += size if in_link[node] else 0
        for i in range(count - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i]
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
        share = link_chars[0] / chars[0] if chars[0] else 0.0

        def density(i: int) -> float:
            c, lc = chars[i], link_chars[i]
            if not c:
                return 0.0
            t = max(1, tags[i] - 1)  # the tags inside
            base = math.log(math.log(c / max(1, c - lc) * lc + share * c + math.e + 1))
            return c / t * max(0.0, math.log(c / max(1, lc) * t / max(1, link_tags[i]))) / base

        blocks = [i for i in range(count) if not out[i] and (i == 0 or self.tag[i] in BLOCK)]
        dense = {i: density(i) for i in blocks}
        up = self.parent[:]  # the nearest block above
        for i in range(1, count):
            while up[i] > 0 and up[i] not in dense:
                up[i] = up[up[i]]
        total: dict[int, float] = {}
        for i in blocks:
            if i:
                total[up[i]] = total.get(up[i], 0.0) + dense[i]
        sums = {i: total.get(i, dense[i]) for i in blocks}
        return self._render(self._content(blocks, dense, sums, up, [c - k for c, k in zip(chars, link_chars, strict=True)]), out)

    def _believe_names(self, sizes: list[tuple[int, int]], in_link: list[bool], out: list[bool]) -> None:
        """Clear the marks by a name that the text of the element contradicts; ``out`` is set aside for other reasons."""
        count = len(self.tag)
        plain, links = [0] * count, [0] * count
        for node, size in sizes:
            if not out[node]:
                (links if in_link[node] else plain)[node] += size
        for i in range(count - 1, 0, -1):
            plain[self.parent[i]] += plain[i]
            links[self.parent[i]] += links[i]
        for i in range(1, count):
            if self.aside[i] == BY_LAYOUT and plain[i] >= SHORT_TEXT and links[i] <= LINK_SHARE * (plain[i] + links[i]):
                self.aside[i] = 0
            elif self.aside[i] == BY_PURPOSE and plain[i] and plain[0] - plain[i] < REST_SHARE * plain[0]:
                self.aside[i] = 0

    def _content(self, blocks: list[int], dense: dict, sums: dict, up: list[int], plain: list[int]) -> list[int]:
        """The nodes whose text is the content, in order; ``plain`` is the nodes' text outside links."""
        inside = {name: self._outermost(name) for name in ("article", "main")}
        mains = {inside["main"][i] for i in blocks if plain[i]} - {-1}
        top = min(mains) if len(mains) == 1 else 0
        if top not in dense or plain[top] < MAIN_SHARE * plain[0]:
            top = 0
        within = [i for i in blocks if top in (0, inside["main"][i])]
        centre = max(within, key=lambda i: (sums[i], -i))
        path = [centre]
        while path[-1] > top:
            path.append(up[path[-1]])
        body = [i for i in path if i and self.tag[i] not in ("html",)] or [0]
        threshold = max(min(dense[i] for i in body), 1e-9)
        articles = [i for i in within if inside["article"][i] == i and plain[i]]
        home = inside["article"][centre]
        if home >= 0:
            return [i for i in articles if i == home or dense[i] >= threshold] or [home]
        under = self._under(centre)
        below = [i for i in articles if under[i]]
        if below and sum(plain[i] for i in below) >= ARTICLES_SHARE * plain[centre]:
            return below
        on_path = set(path)
        above = on_path - {centre}
        return [i for i in within if i == centre or i not in on_path and up[i] in above and dense[i] >= threshold]

    def _outermost(self, name: str) -> list[int]:
        """Per node the outermost element of that name around it or itself, else -1."""
        out = [-1] * len(self.tag)
        for i in range(1, len(out)):
            above = out[self.parent[i]]
            out[i] = above if above >= 0 else i if self.tag[i] == name else -1
        return out

    def _under(self, top: int) -> list[bool]:
        """Per node whether it is ``top`` or lies in it."""
        out = [False] * len(self.tag)
        out[top] = True
        for i in range(top + 1, len(out)):
            out[i] = out[self.parent[i]]
        return out

    def _render(self, roots: list[int], out: list[bool]) -> str:
        lines: list[str] = []
        for root in roots:
            held: list[str] = []
            low, high = self.span[root]
            for node, text in [*self.events[low:high], (root, None)]:
                if text is not None:
                    if not out[node]:
                        held.append(text)
                elif held:
                    line = " ".join("".join(held).split())
                    held = []
                    if line:
                        lines.append(line)
        return "\n".join(lines)


def main_text(html: str) -> str:
    """The main text of one page: its blocks, white space in each made one space, one a line."""
    return Page(html).main_text()


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row, from the whole html, without a shuffle.

    Null and empty pages, and pages without content, have an empty text; null
    ids and urls stay null; repeated rows give their text each; other columns are not read.
    """

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                texts = [main_text(h) if h else "" for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
