"""Main text of web pages by composite text density.

The DOM is built without the parts that are never the article: by element (menus,
page headers and footers, sidebars, forms, scripts, styles), by role, and by class names
and ids made of furniture words (adverts, notices, reader comments, and so on). If no ``article``, ``main`` or ``h1``
is left outside of these, one that holds such an element or most of the page's unlinked text is opened, and the furniture
within it is judged in its stead. For every
remaining node the density is characters per tag, adjusted for links::

    density = C / T * log(C / LC' * T / LT', base ln(C * LC / C' + LCb * C / Cb + e))

(C characters, T tags, LC and LT those within links, C' characters outside links, b the
whole page with its furniture; a primed or missing count is at least 1). The sums of the children's densities point to the
subtree with the largest sum; the smallest density on the path from the body to it is
the threshold, and every node at or above it yields the largest-sum subtree below it.
A subtree inside an ``article`` or ``main`` stands for that whole element, and headings directly
before a chosen subtree belong to it. Outside of these, chosen subtrees are parts of one text: on the way from each up to
their common container (of a single one: its parent) the siblings belong to it as well, however short, unless
most of their text is linked. Short blocks outside of article elements that read as a notice (rights, cookies) are removed first.

Text: character references decoded, white space inside a block turned into one space and trimmed, blocks
joined in page order by one newline; nothing else is dropped.

Defined cases: a null or empty page, one without text, or one that is only furniture has empty text;
broken markup (unclosed, misnested or stray tags, a page that ends inside a tag) is read as far as it
goes; text outside any element counts as the body's; ties of the largest sum go to the first in page order.
Columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter "
                   "progress q ruby rb rp rt s samp small span strike strong sub sup time td th tt u var wbr "
                   "math mi mo mn ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mspace".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
FURNITURE = frozenset("head title nav aside footer form script style noscript template iframe object embed applet canvas "
                      "svg button select option textarea input label datalist dialog audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                  "toolbar form tooltip note status".split())
#: Words of class and id attributes that mark page furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner banners promo promos promotion "
    "promoted sponsor sponsored sponsors nav navbar navigation menu menus breadcrumb breadcrumbs crumbs sidebar "
    "sidebars aside header masthead topbar toolbar footer bottombar colophon copyright comment comments commentlist "
    "disqus discussion replies reply respond cookie cookies consent gdpr notice notices alert alerts disclaimer popup "
    "thread threads remark remarks reader readers feedback responses cookiebar cookiebanner cookienotice commentbox "
    "modal overlay newsletter subscribe subscription signup login signin share sharing social related recommended "
    "recommendations widget widgets pagination pager search searchbox toc tags tagcloud hidden skip".split())
ARTICLE_WORDS = frozenset("article content entry post story".split())
#: Words that say where or of what a marked part is: "site-footer", "comments-area"; not "has-sidebar".
PLACES = frozenset(
    "site page main global top bottom left right primary secondary inner outer article entry post story area bar block body box "
    "button buttons col column container group inline item items link links list panel row section slot text unit wrap wrapper".split())
#: Marks that a section of an article may have for its name.
SECTION_WORDS = frozenset("discussion notice notices alert alerts disclaimer copyright promotion search social sharing "
                          "navigation subscription consent tags".split())
#: What makes a short block outside the article a notice, whatever its names.
NOTICE = re.compile(r"©|\(c\) \d{4}|all rights reserved|\b(we|site) uses? cookies\b|\baccept (all )?cookies\b", re.I)
NOTICE_CHARS = 300
#: Parts that are opened only with most of the page's text: by element, and by words, as their entries may be articles.
ASIDES = frozenset(("nav", "aside", "footer", "header", "dialog", "menu"))
THREADS = frozenset("thread threads remark remarks comment comments commentlist disqus replies reply respond related recommended recommendations "
                    "promo promos promoted sponsored ad ads".split())
#: What is never opened, besides hidden elements.
CLOSED = FURNITURE - ASIDES - {"form"}
LANDMARKS = {"article": 2, "main": 2, "h1": 1}
#: Elements whose start closes an open paragraph, and what an element of a kind closes in its own list.
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "thead": ("tbody", "tfoot"), "tbody": ("thead", "tbody"), "tfoot": ("tbody",)}
SCOPES = frozenset(("table", "ul", "ol", "dl", "select", "article", "section", "main", "div", "body", "td", "th", "blockquote", "#root"))


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "total", "best", "chosen",
                 "text", "rank")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.best: Node = self
        self.chosen = False
        self.text = self.rank = 0

    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.at = self.root
        self.chars = self.link_chars = self.open_links = 0

    def _close(self, names: tuple[str, ...]) -> None:
        """Close the nearest open element of ``names`` within the current scope."""
        node = self.at
        while node.parent is not None:
            if node.tag in names:
                self.at = node.parent
                return
            if node.tag in SCOPES:
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close(("p",))
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag])
        node = Node(tag, dict(attrs), self.at)
        self.at.items.append(node)
        if tag not in VOID:
            self.at = node
        self.open_links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        self.open_links = max(0, self.open_links - (tag == "a"))
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.items.append(data)
        if self.at.tag not in ("script", "style", "title"):
            n = len("".join(data.split()))
            self.chars += n
            self.link_chars += n * (self.open_links > 0)


def _is_hidden(node: Node) -> bool:
    return "hidden" in node.attrs or (node.attrs.get("aria-hidden") or "").lower() == "true" or bool(
        re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", node.attrs.get("style") or ""))


def _names(node: Node) -> list[set[str]]:
    """The words of each class name and of the id."""
    named = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}"
    return [set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())) for name in named.split()]


def _is_furniture(node: Node) -> bool:
    if node.tag in FURNITURE:
        return True
    if node.tag in ("#root", "html", "body", "main", "article"):
        return False
    inside = node.parent
    while inside is not None and inside.tag not in ("article", "main"):
        inside = inside.parent
    if node.tag == "header":
        return inside is None
    if node.tag == "menu" and inside is None:
        return True
    if node.tag in HEADINGS:
        return False
    if (node.attrs.get("role") or "").lower() in ROLES or _is_hidden(node):
        return True
    names = _names(node)
    own: set[str] = set()
    if inside is not None or any(words & ARTICLE_WORDS for words in names):
        own.add("header")  # the article's own, with its title
    if inside is not None and node.tag == "section":
        own |= SECTION_WORDS
    return any(words & MARKS - own and words <= MARKS | PLACES for words in names)


def _walk(root: Node) -> list[Node]:
    """All nodes in page order, parents before children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed(node.children()))
    return order


def _prune(root: Node) -> None:
    """Remove the furniture, but for elements that hold the article: those are opened and pruned inside."""
    for node in reversed(_walk(root)):
        node.text, node.rank = 0, LANDMARKS.get(node.tag, 0)
        if node.tag in CLOSED or _is_hidden(node):
            node.rank = 0
            continue
        for x in node.items:
            node.text += len("".join(x.split())) if isinstance(x, str) else x.text
            node.rank = max(node.rank, 0 if isinstance(x, str) else x.rank)
        if node.tag == "a":
            node.text = 0
    outside, removed, opened = 0, [], [root]
    while opened:
        stack = opened
        while stack:
            for x in stack.pop().children():
                if _is_furniture(x):
                    removed.append(x)
                else:
                    outside = max(outside, LANDMARKS.get(x.tag, 0))
                    stack.append(x)
        opened = [x for x in removed if _holds_article(x, outside, 2 * x.text > root.text)]
        kept = set(map(id, opened))
        removed = [x for x in removed if id(x) not in kept]
    gone = set(map(id, removed))
    for parent in {id(x.parent): x.parent for x in removed}.values():
        parent.items = [x for x in parent.items if isinstance(x, str) or id(x) not in gone]


def _holds_article(node: Node, outside: int, most: bool) -> bool:
    """Whether a part taken for furniture holds the article; ``outside`` is the best landmark left without it, ``most`` of the text is in it."""
    if outside == 2 or node.tag in CLOSED or _is_hidden(node):
        return False
    if node.tag in ASIDES:
        return most and node.rank == 2
    if any(words & THREADS for words in _names(node)):
        return most and not outside
    return most and node.rank == 2 if outside else most or node.rank > 0


def _measure(order: list[Node], body_share: float) -> None:
    """Counts, densities and density sums; ``body_share`` is the share of link characters in the whole page."""
    for node in reversed(order):
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for x in node.items:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            else:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    for node in order:
        if not node.chars:
            node.density = 0.0
            continue
        tags, links = max(1, node.tags), max(1, node.link_tags)
        base = math.log(node.chars * node.link_chars / max(1, node.chars - node.link_chars) + body_share * node.chars + math.e)
        ratio = max(1.0, node.chars / max(1, node.link_chars) * tags / links)
        adjust = math.log(ratio) / math.log(base) if base > 1 + 1e-9 else 1.0  # 1: the page has no links
        node.density = node.chars / tags * adjust
    for node in reversed(order):
        own = len("".join("".join(x.split()) for x in node.items if isinstance(x, str)))
        node.total = own + sum(x.density for x in node.children())
        node.best = node
        for x in node.children():
            if x.best.total > node.best.total:
                node.best = x.best


def _choose(order: list[Node], body: Node) -> list[Node]:
    top, path = body.best, body.best
    threshold = top.density
    while path is not body and path.parent is not None:
        path = path.parent
        threshold = min(threshold, path.density)
    chosen, stack = [], [body]
    while stack:
        node = stack.pop()
        if node.chars and not node.chosen and node.density >= threshold:
            chosen.append(node.best)
            _mark(node.best)
            stack.extend(reversed(node.children()))
    lifted = []
    for node in chosen:
        outer, up = node, node
        while up.parent is not None:
            if up.tag in ("article", "main"):
                outer = up
            up = up.parent
        lifted.append(outer)
    return lifted


def _path(node: Node, top: Node) -> list[Node]:
    """From ``node`` up to ``top``."""
    path = [node]
    while path[-1] is not top and path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def _said(node: Node) -> str:
    return " ".join("".join(x for n in _walk(node) for x in n.items if isinstance(x, str)).split())


def _drop_notices(body: Node) -> bool:
    """Remove short blocks outside ``article`` and ``main`` that read as a notice and are the lesser part of the page; whether there were any."""
    gone, stack = [], [body]
    while stack:
        for x in stack.pop().children():
            if x.tag in ("article", "main") or x.tag in INLINE or not x.chars:
                continue
            if x.chars < NOTICE_CHARS and 2 * x.chars < body.chars and NOTICE.search(_said(x)):
                gone.append(x)
            else:
                stack.append(x)
    for x in gone:
        x.parent.items = [y for y in x.parent.items if y is not x]
    return bool(gone)


def _add_siblings(chosen: list[Node], body: Node) -> None:
    """Mark what stands beside the chosen subtrees, up to their common container."""
    free = [n for n in chosen if n is not body and n.tag not in ("article", "main")]
    if not free or len(free) < len(chosen):
        return
    paths = [_path(n, body)[::-1] for n in free]
    common = 0
    while all(len(p) > common + 1 and p[common] is paths[0][common] for p in paths):
        common += 1
    # A container that is itself chosen is whole already; of a single one the parent is the container.
    container = paths[0][common - 1] if all(p[common - 1] is paths[0][common - 1] for p in paths) else body
    inner = [container]
    for path in paths:
        inner.extend(path[path.index(container) + 1:-1])
    for node in {id(n): n for n in inner}.values():
        for x in node.children():
            if x.chars and not any(n.chosen for n in _walk(x)) and 2 * x.link_chars <= x.chars:
                _mark(x)


def _mark(root: Node) -> None:
    for node in _walk(root):
        node.chosen = True


def _add_headings(order: list[Node]) -> None:
    for node in order:
        pending: list[Node] = []
        for x in node.children():
            if x.tag in HEADINGS and not x.chosen:
                pending.append(x)
            elif x.chosen:
                for h in pending:
                    _mark(h)
                pending = []
            elif x.chars:
                pending = []


def _blocks(root: Node) -> list[str]:
    """Texts of the blocks under ``root`` that are chosen, in page order."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    stack: list[Node | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag in INLINE:
            if x.tag in ("br", "td", "th"):
                run.append(" ")
            stack.extend(y for y in reversed(x.items) if x.chosen or isinstance(y, Node))
        else:
            flush()
            stack.append(None)
            stack.extend(y for y in reversed(x.items) if x.chosen or isinstance(y, Node))
    flush()
    return blocks


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and re.match(r"</?[a-zA-Z]", html[last:last + 3]):
        html = html[:last]  # the page ends inside a tag
    tree = _Tree()
    tree.feed(html)
    tree.close()
    root = tree.root
    body = next((n for n in _walk(root) if n.tag == "body"), root)
    _prune(root)
    if body is not root and not any(n is body for n in _walk(root)):
        body = root
    order = _walk(body)
    _measure(order, tree.link_chars / max(1, tree.chars))
    if not body.chars:
        return ""
    if _drop_notices(body):
        order = _walk(body)
        _measure(order, tree.link_chars / max(1, tree.chars))
    chosen = _choose(order, body)
    for node in chosen:
        _mark(node)
    _add_siblings(chosen, body)
    _add_headings(order)
    return "\n".join(_blocks(body))


def html_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages``."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [main_text(h.as_py()) for h in rows.column("html")]
            yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    rows = own_columns(pages, ["page_id", "url", "html"]).withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(extract, "page_id long, url string, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
