"""Main text of web pages by composite text density.

A page is parsed into a DOM. Elements that hold no article text by their tag, role or name
(menus, footers, adverts, forms, comments and the like) are cut out; a name is a whole class or id
or a compound that begins or ends with one, but no layout's ("no-sidebar", "with-sidebar"), no
article's own header, and, as a compound, not that of a node with most of the page's text. Every remaining node has
its characters, tags, link characters and link tags; its composite density is the characters per
tag, weighted by a logarithm that falls with the share of links. A node's density sum adds up its
children's densities. The subtree with the largest sum holds the text; on the way up to the body,
a parent takes its place as long as the parent is inside an article element, or adds nothing that
is less dense than the threshold, the least density on the path from the body to that subtree.

The text's blocks come in page order, character references decoded, white space inside a block
as one space, joined by an empty line.

Defined results: NULL, empty and unparsable html (no text) give an empty text; broken markup is
closed as browsers do; repeated rows are pages of their own; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without an end tag, with raw text, and by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose start ends an open element of the second set.
ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset(["ul", "ol", "dl", "table", "body", "select"])
NOT_TEXT = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript template svg math canvas audio video object nav footer aside form "
    "button select option input label fieldset dialog menu".split()
)
NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Words of class and id values that name parts of a page beside its article.
NOT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent "
    "disqus disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup "
    "promo promoted promotion related recommended recommendations replies respond share sharing sidebar skyscraper social sponsor sponsored "
    "subscribe subscription toolbar topbar widget".split()
)
# Names that are whole in one part only, or judged like the header tag.
HEADERS = frozenset(["header", "masthead"])
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
# Parts of a compound that say that the element is something else: a layout with or without a part, or an article's own header.
LAYOUTS = frozenset("no not non has have with without".split())
OWN = frozenset("article entry headline post section story title".split())
ARTICLE = frozenset(["article", "main"])
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)(?=[a-zA-Z])", re.S)
_NAME_END = re.compile(r"[\s/>]|\Z")
_TAG_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Tags:
    """Finds where tags end, in one pass over a source however it is broken: what led nowhere once is
    not searched again."""

    def __init__(self, source: str):
        self.source, self.dead, self.nothing_from, self.name_end = source, set(), len(source), -1

    def after_name(self, at: int) -> int:
        """The end of the tag name that begins at ``at``; calls go forward."""
        if at > self.name_end:
            self.name_end = _NAME_END.search(self.source, at).start()
        return self.name_end

    def close(self, at: int) -> int:
        """The place of the ">" that ends a tag whose attributes begin at ``at``, past quoted
        values; -1 if a quote stays open or none comes."""
        seen = []
        while at < self.nothing_from:
            m = _TAG_END.search(self.source, at)
            if m is None:
                self.nothing_from = at
                break
            if m.start() in self.dead:
                break
            if m[0] == ">":
                return m.start()
            seen.append(m.start())
            at = self.source.find(m[0], m.end()) + 1
            if not at:
                break
        self.dead.update(seen)
        return -1


class Page:
    """A page's nodes in page order: tag, parent, and the pieces of text with their nodes."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes = ["#page"], [0], [""]
        self.pieces: list[tuple[int, str]] = []  # (node, text); at an opened or closed block: (node, None)
        self.first, self.last = [0], [0]  # of each node's pieces
        self.plain: list[int] | None = None
        self.opened: Counter[str] = Counter()  # tags on the stack
        stack, at, look, end, tags = [0], 0, 0, len(source), Tags(source)
        while at < end:
            m = _TOKEN.search(source, look)
            is_tag, closed = m is not None and m[2] is not None, -1
            if is_tag:
                named = tags.after_name(m.end())
                closed = tags.close(named)
                if closed < 0:  # no tag: its "<" is text
                    look = m.start() + 1
                    continue
            if (m.start() if m else end) > at:
                self.pieces.append((stack[-1], source[at : m.start() if m else end]))
            if not m:
                break
            at = look = closed + 1 if is_tag else m.end()
            if m[1] is not None:
                self.pieces.append((stack[-1], m[1].replace("&", "&amp;")))
            if not is_tag:
                continue
            tag, attributes = source[m.end() : named].lower(), source[named:closed]
            if m[2]:
                if self.opened[tag]:
                    while self.tags[stack[-1]] != tag:
                        self._close(stack)
                    self._close(stack)
                elif tag == "p" or tag == "br":
                    self.pieces.append((stack[-1], " "))
                continue
            self._make_room(stack, tag)
            node = len(self.tags)
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.attributes.append(attributes)
            if tag in BLOCKS:
                self.pieces.append((node, None))
            elif tag == "br":
                self.pieces.append((stack[-1], " "))
            self.first.append(len(self.pieces))
            self.last.append(len(self.pieces))
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                continue
            stack.append(node)
            self.opened[tag] += 1
            if tag in RAW:  # its content is text up to the end tag
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
                self.pieces.append((node, source[at : close.start() if close else end]))
                at = look = close.end() if close else end
                self._close(stack)
        while len(stack) > 1:
            self._close(stack)
        self.last[0] = len(self.pieces)

    def _close(self, stack):
        node = stack.pop()
        self.opened[self.tags[node]] -= 1
        self.last[node] = len(self.pieces)
        if self.tags[node] in BLOCKS:
            self.pieces.append((node, None))

    def _make_room(self, stack, tag):
        """Closes what a start tag ends: an open paragraph, list item, cell or row."""
        if tag in BLOCKS and self.opened["p"]:
            for k in range(len(stack) - 1, 0, -1):
                t = self.tags[stack[k]]
                if t == "p":
                    while len(stack) > k:
                        self._close(stack)
                    break
                if t in BLOCKS:
                    break
        ends = ENDS.get(tag, frozenset())
        if any(self.opened[t] for t in ends):
            for k in range(len(stack) - 1, 0, -1):
                t = self.tags[stack[k]]
                if t in ends:
                    while len(stack) > k:
                        self._close(stack)
                elif t in SCOPES:
                    break

    def left_out(self) -> list[bool]:
        """The nodes that hold no article text, with all below them."""
        n = len(self.tags)
        holds, inside = [False] * n, [False] * n
        for k in range(n - 1, 0, -1):
            if holds[k] or self.tags[k] in ARTICLE:
                holds[self.parents[k]] = True
        out = [False] * n
        for k in range(1, n):
            tag, up = self.tags[k], self.parents[k]
            inside[k] = inside[up] or tag in ARTICLE
            if out[up] or tag in NOT_TEXT or (tag == "header" and not inside[k] and not holds[k]):
                out[k] = True
            elif self.attributes[k] and tag not in ARTICLE and tag not in ("html", "body"):
                out[k] = not holds[k] and (self._hidden(self.attributes[k]) or self._named(k, inside[k]))
        return out

    def _plain(self) -> list[int]:
        """Of every node, the characters outside links and outside elements that are no text by tag."""
        n = len(self.tags)
        skip, plain = [False] * n, [0] * n
        for k in range(1, n):
            skip[k] = skip[self.parents[k]] or self.tags[k] == "a" or self.tags[k] in NOT_TEXT
        for node, text in self.pieces:
            if text and not skip[node]:
                plain[node] += len("".join(text.split()))
        for k in range(n - 1, 0, -1):
            plain[self.parents[k]] += plain[k]
        return plain

    def _named(self, node: int, in_article: bool) -> bool:
        """Whether a class or id names a part beside the article: by a whole name, or by a compound
        that begins or ends with one, unless the node holds most of the page's plain text."""
        for m in _ATTRIBUTE.finditer(self.attributes[node]):
            if m[1].lower() not in ("class", "id"):
                continue
            for token in next((v for v in m.groups()[1:] if v is not None), "").split():
                parts = [w.lower() for w in _NAME.findall(token)]
                if not parts or not LAYOUTS.isdisjoint(parts):
                    continue
                # A widget is named first (widget_search); builders end the names of all their boxes with it.
                ends = {parts[0], parts[-1]} - ({"widget"} if parts[0] != "widget" else set())
                names = ends & NOT_NAMES
                if names and names <= HEADERS and (in_article or not OWN.isdisjoint(parts)):
                    continue
                if names and len(parts) > 1 and COMMENTS.isdisjoint(names):
                    if self.plain is None:
                        self.plain = self._plain()
                    if 2 * self.plain[node] > self.plain[0]:
                        continue
                if names:
                    return True
        return False

    @staticmethod
    def _hidden(attributes: str) -> bool:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), next((v for v in m.groups()[1:] if v is not None), "")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return True
            if name == "role" and value.lower() in NOT_ROLES:
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        return False


def densities(page: Page, out: list[bool]) -> tuple[list[float], list[float]]:
    """Composite density of every node, and the sum of its children's."""
    n = len(page.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        if text and not out[node]:
            chars[node] += len("".join(text.split()))
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = in_link[page.parents[k]] or page.tags[k] == "a"
    for k in range(n - 1, 0, -1):
        if out[k]:
            continue
        if in_link[k]:
            link_chars[k] = chars[k]
        up = page.parents[k]
        chars[up] += chars[k]
        tags[up] += tags[k] + 1
        link_chars[up] += link_chars[k]
        link_tags[up] += link_tags[k] + (page.tags[k] == "a")
    body_chars, body_links = max(chars[0], 1), link_chars[0]
    density, sums = [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        if out[k] or not chars[k]:
            continue
        c, t, lc, lt = chars[k], max(tags[k], 1), link_chars[k], max(link_tags[k], 1)
        plain = max(c - lc, 1)
        base = math.log(c / plain * lc + body_links / body_chars * c + math.e)
        density[k] = max(c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0) + 1e-9) / math.log(max(base, 1.0) + math.e - 1), 0.0)
        if k:
            sums[page.parents[k]] += density[k]
    return density, sums


def main_node(page: Page, out: list[bool]) -> int:
    """The subtree with the largest density sum, raised by the body-path threshold."""
    density, sums = densities(page, out)
    best = max(range(len(sums)), key=lambda k: (sums[k], -k))
    if not sums[best]:
        return 0
    path = [best]
    while path[-1]:
        path.append(page.parents[path[-1]])
    threshold = min(density[k] for k in path)
    children: dict[int, list[int]] = {}
    for k in range(1, len(sums)):
        children.setdefault(page.parents[k], []).append(k)
    top = max((i for i, k in enumerate(path) if page.tags[k] in ARTICLE), default=0)
    for i in range(top + 1, len(path)):
        if top:  # an article element is whole as it is
            break
        others = [k for k in children[path[i]] if k != path[i - 1] and density[k] > 0]
        if any(density[k] < threshold for k in others):
            break
        top = i if page.tags[path[i]] not in ("body", "html", "#page") else top
    return path[top]


def main_text(source: str | None) -> str:
    page = Page(source or "")
    out = page.left_out()
    node = main_node(page, out)
    blocks: list[list[str]] = [[]]
    for owner, text in page.pieces[page.first[node] : page.last[node]]:
        if text is None:
            blocks.append([])
        elif not out[owner]:
            blocks[-1].append(text)
    clean = (" ".join(references.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column("html")]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(i) for i in range(b.num_columns - 1)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            [*b.schema.names[:-1], "text", "n_chars"],
        )


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """``keep`` plus the main text and its number of code points."""
    rows = pages.select(*keep, F.col(html_col).alias("html"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["text string, n_chars bigint"])
    return rows.mapInArrow(_extract, schema)
