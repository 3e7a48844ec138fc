"""Operator 6: main text of web pages by composite text density.

A page becomes a tree. For every node, the composite text density is its characters per tag,
adjusted by its links: with C characters, T tags, LC link characters, LT link tags and the
body's ratio LCb / Cb,

    density = C / T * log(C * T / (LC * LT)) / log(log(C * LC / (C - LC) + LCb * C / Cb + e))

(counts of zero as one), so menus and link lists score low and running text high. The sum of
its children's densities tells how much text sits right below a node; inline elements (no block,
and none inside) are text of their block, so only what holds blocks has a sum. The node of the largest
sum is the content's heart; the threshold is the smallest density on the path from it up to
the body. Going down from the body through nodes of at least that density, the subtree of the
largest sum in each is taken, widened to the outermost article around it, or else the outermost
main, if the page names one. Elements that by tag, role or class are menus, headers, footers,
sidebars, notices, adverts, forms or reader comments are left out, as are scripts and styles,
which never enter the tree. A class, id, role or form alone says little of an element that holds
most of the characters outside links, a main element or the page's only article: its density decides.

Character references are decoded, white space inside a block becomes one space, blocks are
trimmed, empty ones skipped, and the rest joined in page order by two line feeds. Embedded media
that no end tag closes are empty; the text after them belongs to the page.

Map-only: a page is read by its own task, batch by batch; all walks are loops, so nesting
is no limit. Null and empty pages give an empty text; pages without a body element use the
whole page; equal rows give equal texts; other columns pass through (the output columns
replace columns of their names).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm.tables import column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head title".split())
#: Those of them that hold nothing where they are left open.
EMBEDDED = frozenset("svg math object canvas audio video".split())
#: Elements that start and end a block of text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
                  "select summary table tbody td tfoot th thead tr ul".split())
#: Elements that are never main text.
BOILERPLATE = frozenset("nav header footer aside form button select textarea dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Words of class and id names that mark what is no main text.
_NAMES = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|newsletter|"
                    r"subscribe|subscription|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget|footer|header|"
                    r"masthead|toolbar|pagination|pager|related|recommend\w*|share|sharing|social|comments?|commentlist|disqus|"
                    r"respond|replies|login|signup)(?:$|[^a-z])")
#: Open elements that a start tag of the key closes, up to the nearest of the second set.
_P = (frozenset({"p"}), frozenset("body html table td th button caption object".split()))
_CLOSES = {t: _P for t in BLOCK - {"body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}} | {
    "tr": (frozenset({"tr"}), frozenset({"table"})), "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "option": (frozenset({"option"}), frozenset({"select"}))}
_ITEMS = {"li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
          "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}))}


class _Node:
    __slots__ = ("tag", "parent", "children", "out", "named", "plain", "chars", "tags", "link_chars", "link_tags", "inline", "density", "sum",
                 "best")

    def __init__(self, tag: str, parent: _Node | None, out: bool, named: bool = False):
        self.tag, self.parent, self.out, self.named = tag, parent, out, named
        self.children: list[_Node | str] = []


#: Names of reader comments, which can be longer than what they comment on.
_COMMENTS = re.compile(r"(?:^|[^a-z])(?:comments?|commentlist|disqus|respond|repl(?:y|ies))(?:$|[^a-z])")


def _is_out(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether an element is no main text, and whether only its name, role or being a form says so."""
    if tag in BOILERPLATE and tag != "form":
        return True, False
    if tag in ("html", "body"):
        return False, False
    named = tag == "form"
    for name, value in attrs:
        if name == "hidden" and tag not in ("main", "article"):
            return True, False
        if not value:
            continue
        if tag in ("main", "article"):  # named after what surrounds them at times; only comments are not main text
            if name in ("class", "id") and re.search(r"(?:^|[^a-z])(?:comments?|repl(?:y|ies))(?:$|[^a-z])", value.lower()):
                return True, False
            continue
        if name == "aria-hidden" and value.lower() == "true":
            return True, False
        if name == "role" and value.strip().lower() in _ROLES:
            named = True
        if name in ("class", "id"):
            words = re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()
            if _COMMENTS.search(words):
                return True, False
            named = named or bool(_NAMES.search(words))
    return named, named


_EMBEDDED_END = re.compile(f"</({'|'.join(sorted(EMBEDDED))})(?=[\\s/>])", re.I)


class _Tree(HTMLParser):
    """Builds the tree; closes what HTML closes by itself, ignores end tags of nothing open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("#root", None, False)
        self.body: _Node | None = None
        self.open: dict[str, int] = {}
        self.silent = 0
        self.silent_tag = ""
        self.ends: Counter[str] = Counter()

    def feed(self, data: str) -> None:
        """Read a whole page."""
        self.ends = Counter(t.lower() for t in _EMBEDDED_END.findall(data))  # those still to come
        super().feed(data)

    def _up(self, node: _Node) -> None:
        """Leave everything up to and including ``node``."""
        while True:
            left = self.at
            self.open[left.tag] -= 1
            self.at = left.parent
            if left is node:
                return

    def _close(self, tags: frozenset[str], until: frozenset[str]) -> None:
        if not any(self.open.get(t) for t in tags):
            return
        node = self.at
        while node is not self.root and node.tag not in until:
            if node.tag in tags:
                self._up(node)
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            self.silent += tag == self.silent_tag
            return
        if tag in ("html", "body") and self.open.get(tag):
            return
        if tag in SILENT:
            if tag in EMBEDDED and not self.ends[tag]:
                return
            self.silent, self.silent_tag = 1, tag
            if tag == "head":
                self.silent = 0  # what it holds is silent by itself
            return
        for rule in (_CLOSES.get(tag), _ITEMS.get(tag)):
            if rule:
                self._close(*rule)
        node = _Node(tag, self.at, *_is_out(tag, attrs))
        self.at.children.append(node)
        if tag in VOID:
            return
        if tag == "body":
            self.body = node
        self.open[tag] = self.open.get(tag, 0) + 1
        self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        self.ends[tag] -= tag in EMBEDDED
        if self.silent:
            self.silent -= tag == self.silent_tag
            if tag == self.silent_tag and tag in EMBEDDED and not self.ends[tag]:
                self.silent = 0
            return
        if tag in ("html", "body"):
            return  # what follows still belongs to the page
        if not self.open.get(tag):
            return
        node = self.at
        while node.tag != tag:
            node = node.parent
        self._up(node)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.at.children.append(data)


def _post_order(top: _Node) -> list[_Node]:
    order, stack = [], [top]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if type(c) is _Node)
    order.reverse()
    return order


def _readmit(body: _Node) -> None:
    """Let the density decide on elements out by name alone that hold most of the page's text, unless
    the page names articles or a main element apart from them."""
    order, articles, mains = _post_order(body), [], []
    for node in order:
        node.plain = 0
        if node.out and not node.named or node.tag == "a":
            continue
        for c in node.children:
            node.plain += c.plain if type(c) is _Node else len("".join(c.split()))
    # parents first: what is below an element that is out for good tells nothing
    seen, inside = {body.parent}, set()
    for node in reversed(order):
        if node.parent not in seen or node.out and not node.named:
            continue
        seen.add(node)
        if node.tag in ("main", "article"):
            (mains if node.tag == "main" else articles).append(node)
        if node.tag in ("main", "article") or node.parent in inside:
            inside.add(node)
    holding = _above(*mains, *(articles if len(articles) == 1 else []))
    near = inside | _above(*articles, *mains)
    for node in order:
        if node.named and (node in holding or 2 * node.plain > body.plain and (node in near or not near)):
            node.out = False


def _above(*nodes: _Node | None) -> set[_Node]:
    """The nodes and all that they stand in."""
    found: set[_Node] = set()
    for node in nodes:
        while node is not None and node not in found:
            found.add(node)
            node = node.parent
    return found


def _measure(body: _Node) -> None:
    """Counts, densities and density sums of all nodes below and including ``body``."""
    order = _post_order(body)
    for node in order:
        chars = tags = link_chars = link_tags = 0
        node.inline = node.tag not in BLOCK and node is not body
        for c in node.children:
            if type(c) is _Node:
                node.inline = node.inline and c.inline
                if c.out:  # never main text, so it should not make its parents look like it
                    continue
                chars, tags = chars + c.chars, tags + c.tags + 1
                link_chars, link_tags = link_chars + c.link_chars, link_tags + c.link_tags + (c.tag == "a")
            else:
                chars += len("".join(c.split()))
        if node.tag in ("a", "button", "select"):
            link_chars = chars
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    body_ratio = body.link_chars / max(1, body.chars)
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        node.density = 0.0
        if c:
            plain = max(1, c - node.link_chars)
            base = math.log(c / plain * lc + body_ratio * c + math.e)
            node.density = c / t * math.log(max(1.0, c / lc * t / lt)) / math.log(max(base, 1.0 + 1e-9) + 1e-9) if base > 1 else 0.0
        node.sum, node.best = 0.0, node
        for child in node.children:
            if type(child) is _Node and not child.out and not child.inline:
                node.sum += child.density
        for child in node.children:
            if type(child) is _Node and not child.out and child.best.sum > node.best.sum:
                node.best = child.best


def _content(body: _Node) -> list[_Node]:
    """The subtrees that hold the main text, in page order."""
    _readmit(body)
    _measure(body)
    heart = body.best
    threshold, node = heart.density, heart
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    found, stack = [], [body]
    while stack:
        node = stack.pop()
        if node.out or node.density < threshold:
            continue
        if node.best.sum >= heart.sum or node is heart:
            top = node.best
            if top is not node and any(type(c) is _Node and not c.out and c.best is top for c in node.children):
                stack.extend(c for c in reversed(node.children) if type(c) is _Node)
                continue
            found.append(top)
        else:
            found.append(node)
    return _widened(found or [heart])


def _widened(found: list[_Node]) -> list[_Node]:
    """Each node, or the outermost article around it, or else the outermost main; none within another."""
    tops: dict[_Node, None] = {}
    for node in found:
        named: dict[str, _Node] = {}
        at: _Node | None = node
        while at is not None:
            if at.tag in ("article", "main"):
                named[at.tag] = at
            at = at.parent
        tops[named.get("article") or named.get("main") or node] = None
    return [t for t in tops if not (_above(t.parent) & tops.keys())]


def _blocks(top: _Node) -> list[str]:
    """The blocks of a subtree in page order, boilerplate left out."""
    blocks, now = [], []

    def end() -> None:
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            blocks.append(text)

    stack: list[_Node | str | None] = [top]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif type(x) is str:
            now.append(x)
        elif x.tag == "br":
            now.append(" ")
        elif not x.out or x is top:
            if x.tag in BLOCK:
                end()
                stack.append(None)
            stack.extend(reversed(x.children))
    end()
    return blocks


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    body = tree.body or tree.root
    blocks: list[str] = []
    for top in _content(body):
        blocks += _blocks(top)
    return "\n\n".join(blocks)


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """Add ``text_col``, the main text of each page, and ``chars_col``, its code points."""
    kept = [c for c in df.columns if c not in (text_col, chars_col)]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text_col, T.StringType(), False),
                           T.StructField(chars_col, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(html_col)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*kept, text_col, chars_col])

    return df.select([column(c) for c in kept]).mapInArrow(run, schema)
