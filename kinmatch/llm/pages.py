"""Main text of web pages by composite text density (Sun, Song and Liao 2011)."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

# Fixed values of HTML: what the element names mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements that end an open one of the same kind, up to the element that bounds them.
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Never part of an article.
DROPPED = frozenset("head script style noscript template nav footer aside form button select option textarea input iframe object embed svg canvas audio video dialog menu title xmp noembed noframes".split())
#: Words of class or id, and roles, of what surrounds an article.
SURROUNDING = frozenset(
    "ad ads advert adverts advertisement advertisements adbox banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay nav navbar navigation menu menus sidebar rail footer masthead breadcrumb breadcrumbs comment comments commentary discussion disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar pagination pager skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _surrounds(tag: str, attributes: str, within: bool) -> bool:
    """Whether an element is none of the article's; ``within``: it stands in an article or main element."""
    if tag in DROPPED or tag == "header" and not within:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            # sidebars and comments may be articles; an article's other classes say nothing
            words = set(_WORD.findall(value))
            if tag == "article":
                words &= {"comment", "comments", "related", "sponsored", "ad", "advert"}
            if words & SURROUNDING:
                return True
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def parse(source: str) -> Node:
    """The tree of a page without what surrounds its article; end tags may be missing or astray."""
    root = Node("html", None)
    body = node = Node("body", root)
    root.children.append(body)
    skip: list[str] = []  # open elements from a dropped one on
    articles = at = 0
    end = len(source)

    def close(upto: Node) -> Node:
        nonlocal articles
        x = node
        while x is not upto:
            articles -= x.tag in ("article", "main")
            x = x.parent
        return x

    while at < end:
        m = _TOKEN.search(source, at)
        stop = m.start() if m else end
        if stop > at and not skip:
            node.children.append(html.unescape(source[at:stop]))
        if not m:
            break
        at = m.end()
        if source.startswith("<![CDATA[", stop):
            if not skip:
                node.children.append(source[stop + 9 : at].removesuffix("]]>"))
            continue
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), (m[3] or m[6] or "")
        if tag in ("html", "body"):
            continue
        if not closing and tag in RAW:
            over = re.compile(rf"</{tag}\s*>|\Z", re.I).search(source, at)
            at = over.end()
            continue  # scripts, styles, forms' texts: never an article's
        if skip:
            if not closing:
                if tag not in VOID and not attributes.endswith("/"):
                    skip.append(tag)
            elif tag in skip:
                while skip.pop() != tag:
                    pass
            elif tag in ("article", "main") or node.tag == tag:  # a dropped element that was never closed ends with what holds it
                x = node
                while x is not body and x.tag != tag:
                    x = x.parent
                if x is not body:
                    skip = []
                    node = close(x.parent)
            continue
        if closing:
            x = node
            while x is not body and x.tag != tag:
                x = x.parent
            if x is not body:
                node = close(x.parent)
            elif tag == "br":
                node.children.append(Node("br", node))
            continue
        if tag in ENDS_P:
            x = node
            while x is not body and x.tag != "p" and x.tag in INLINE:
                x = x.parent
            if x.tag == "p":
                node = close(x.parent)
        if tag in SIBLINGS:
            same, bounds = SIBLINGS[tag]
            x = node
            while x is not body and x.tag not in same.split() and x.tag not in bounds:
                x = x.parent
            if x.tag in same.split():
                node = close(x.parent)
        if _surrounds(tag, attributes, articles > 0):
            if tag not in VOID and not attributes.endswith("/"):
                skip = [tag]
            continue
        child = Node(tag, node)
        node.children.append(child)
        if tag not in VOID:
            node = child
            articles += tag in ("article", "main")
    return body


def _measure(body: Node) -> list[Node]:
    """Counts characters, tags, link characters and link tags of every node; nodes with parents before children."""
    order, stack = [], [(body, False)]
    linked = {}
    while stack:
        x, in_link = stack.pop()
        order.append(x)
        linked[x] = in_link or x.tag == "a"
        stack += [(c, linked[x]) for c in x.children if isinstance(c, Node)]
    for x in reversed(order):
        own = sum(len(_SPACE.sub(" ", c).strip()) for c in x.children if isinstance(c, str))
        x.chars += own
        if linked[x]:
            x.link_chars = x.chars
            x.link_tags = x.tags
        if (p := x.parent) is not None:
            p.chars += x.chars
            p.tags += x.tags + 1
            p.link_chars += x.link_chars
            p.link_tags += x.link_tags + (x.tag == "a")
    return order


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters a tag, adjusted for links by the ``share`` that links have of the page's characters."""
    if not chars:
        return 0.0
    lc, t, lt, plain = max(1, link_chars), max(1, tags), max(1, link_tags), max(1, chars - link_chars)
    base = math.log(chars / plain * link_chars + share * chars + math.e)
    return chars / t * math.log(max(1.0, chars / lc * (t / lt))) / math.log(max(base, 1.000001))


def _weigh(order: list[Node]) -> None:
    """Composite text density of every node, and the sum of those of its blocks.

    Inline elements are part of the text that they stand in, so they are no
    children to be summed; text beside blocks is a block without a name.
    """
    body = order[0]
    share = body.link_chars / max(1, body.chars)
    for x in order:
        x.density = _density(x.chars, x.tags, x.link_chars, x.link_tags, share)
    for x in order:
        if x.tag in INLINE:
            continue
        blocks = [c for c in x.children if isinstance(c, Node) and c.tag not in INLINE and c.tag != "br"]
        if blocks:
            links = sum(c.link_chars for c in blocks)
            x.sum = sum(c.density for c in blocks) + _density(x.chars - sum(c.chars for c in blocks), 1, x.link_chars - links, 1, share)


def main_nodes(body: Node) -> list[Node]:
    """The subtrees that hold the article.

    The node whose blocks' densities have the greatest sum, and the least
    density on its path to the body as threshold: of each subtree at or over
    it, the node of greatest sum. Nodes that stand in one element below the body
    are taken with what is between them: the least element that holds them all.
    """
    order = _measure(body)
    if not body.chars:
        return []
    _weigh(order)
    best = max(order, key=lambda x: x.sum)
    if not best.sum or best is body:
        # density can't tell parts of the page apart; only here do elements that hold half of it say what is the article
        return [x for x in order if x.tag in ("article", "main") and 2 * x.chars >= body.chars][:1] or [body]
    threshold, x = best.density, best
    while x is not None and x.parent is not None and x is not body:
        threshold = min(threshold, x.density)
        x = x.parent
    # greatest sum in each subtree, bottom up
    top = {}
    for x in reversed(order):
        found = x
        for c in x.children:
            if isinstance(c, Node) and top[c].sum > found.sum:
                found = top[c]
        top[x] = found
    chosen = {top[x] for x in order if x is not body and x.density >= threshold and top[x].sum > 0} or {best}
    chosen.add(best)
    shared = _holder(body, chosen)
    if shared is not body:
        return [shared]
    out = []
    for x in order:  # the outermost ones
        p = x.parent
        while p is not None and p not in chosen:
            p = p.parent
        if x in chosen and p is None:
            out.append(x)
    return out


def _holder(body: Node, nodes: set[Node]) -> Node:
    """The least element that holds all of some nodes."""
    shared: list[Node] | None = None
    for x in nodes:
        path = []
        while x is not None and x is not body:
            path.append(x)
            x = x.parent
        path.reverse()
        if shared is None:
            shared = path
        else:
            n = next((k for k, (a, b) in enumerate(zip(shared, path, strict=False)) if a is not b), min(len(shared), len(path)))
            shared = shared[:n]
    return shared[-1] if shared else body


def blocks(top: Node) -> list[str]:
    """Texts of the blocks in page order, white space collapsed."""
    out, now = [], []

    def flush():
        if text := _SPACE.sub(" ", "".join(now)).strip():
            out.append(text)
        now.clear()

    stack: list = [top]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            now.append(x)
        elif x.tag == "br":
            now.append(" ")
        else:
            block = x.tag not in INLINE
            if block:
                flush()
                stack.append(None)
            stack += reversed(x.children)
    flush()
    return out


def main_text(source: str | None) -> str:
    """The article's text of a page: its blocks joined by one space. Empty for a page without text."""
    body = parse(source or "")
    found = main_nodes(body)
    place = {id(x): k for k, x in enumerate(_in_order(body))} if len(found) > 1 else {}
    return " ".join(t for x in sorted(found, key=lambda x: place.get(id(x), 0)) for t in blocks(x))


def _in_order(body: Node) -> Iterator[Node]:
    stack = [body]
    while stack:
        x = stack.pop()
        yield x
        stack += [c for c in reversed(x.children) if isinstance(c, Node)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every row of ``pages``.

    A null html counts as empty and has an empty text; page_id and url pass
    as they are, null or repeated. Other columns are not read. Pages are
    parsed whole, one at a time. No pages give no rows.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield batch(schema, page_id=b.column(0), url=b.column(1), text=texts, n_chars=[len(t) for t in texts])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(apply, "page_id long, url string, text string, n_chars long")
