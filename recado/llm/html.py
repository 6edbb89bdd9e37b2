"""Main text of web pages by composite text density.

A page becomes a tree of its elements; parts that are never article text (scripts, controls, hidden parts,
by element, role, attribute or style) are left out of it. Menus, headers, footers and the like go, unless the article lies in them. Class and id names, and forms,
only mark parts (adverts, notices, comments): such
a part goes unless it holds an article or a main element, or most of the page's text that is not linked. Every node gets its characters per tag, adjusted for
linked characters and linked tags; the node with the largest sum of its children's densities holds the article. Other parts
belong to it where they are at least as dense as the thinnest node on the way from the body to that node; an article or main
element on that way is taken, but for blocks of links inside it that are thinner than that, and parts beside it by the same rule.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recado.llm.words import by_batch

#: A comment, a declaration, or a tag with its attributes; a page may end inside any of them. Quotes count at the start of a value only.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                   r"((?:[^>=]+|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
BLANK = re.compile(r"[ \t\n\r\f\v]+")

#: Elements whose text is not markup; it ends at their end tag only.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
DROPPED = {"script", "style", "noscript", "template", "head", "title", "button", "select", "textarea", "iframe", "object", "embed", "svg", "canvas",
           "audio", "video", "map", "xmp", "noembed", "noframes", "input"}
#: Elements that go unless the article lies in them; a form is judged like a marked part.
ASIDE = {"nav", "header", "footer", "aside", "dialog", "menu"}
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
MENU_LINKS = 3  # a block inside an article with as many links, and little else, is a menu
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "menu", "menubar", "alert"}
#: Words of class and id names that mark what is not the article.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|advertising|adverts|banner|sponsor|sponsored|promo|promotion|breadcrumbs?|comments?|replies|"
    r"disqus|respond|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|nav|navbar|navigation|menu|"
    r"sidebar|aside|footer|masthead|related|recommended|share|sharing|social|widget|toolbar|pagination|pager|skip|hidden)(?:$|[\s_-])", re.I)
ARTICLE = {"article", "main"}
#: An element of the left kind closes open ones of the right kind, down to the nearest of the last.
_LIST, _TABLE = ("ul", "ol"), ("table",)
CLOSES = {"li": (("li",), _LIST), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), _TABLE),
          "td": (("td", "th"), ("tr", *_TABLE)), "th": (("td", "th"), ("tr", *_TABLE)), "option": (("option",), ("select",))}


class Node:
    __slots__ = ("name", "parent", "parts", "children", "chars", "tags", "linked", "link_tags", "density", "total", "dropped", "marked", "aside")

    def __init__(self, name: str, parent: Node | None) -> None:
        self.name, self.parent = name, parent
        self.parts: list[Node | str] = []
        self.children: list[Node] = []
        self.chars = self.tags = self.linked = self.link_tags = 0
        self.density = self.total = 0.0
        self.dropped = self.marked = self.aside = False


def _is_dropped(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if not attributes.strip() or name in ("html", "body"):
        return False
    for a in ATTRIBUTE.finditer(attributes):
        value = html.unescape(a[2] or a[3] or a[4] or "")
        key = a[1].lower()
        if key == "role" and value.lower().strip() in ROLES or key == "aria-hidden" and value.lower() == "true" or key == "style" and UNSEEN.search(value):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", QUOTED.sub("", attributes), re.I))


def _is_marked(name: str, attributes: str) -> bool:
    return name == "form" or name not in ("html", "body") and any(
        a[1].lower() in ("class", "id") and MARKED.search(html.unescape(a[2] or a[3] or a[4] or "")) for a in ATTRIBUTE.finditer(attributes))


def _inside_article(node: Node | None) -> bool:
    while node is not None and node.name not in ARTICLE:
        node = node.parent
    return node is not None


def parse(page: str) -> Node:
    """The tree of a page, without what is dropped, marked parts still in it; a page that ends early is closed there."""
    root = body = Node("html", None)
    node, at = root, 0
    depth = 0  # of nested dropped elements
    opened: Counter[str] = Counter()  # open elements by name, so that a stray end tag costs no search
    while at < len(page):
        token = TOKEN.search(page, at)
        end = token.start() if token else len(page)
        if end > at and not depth:
            node.parts.append(html.unescape(page[at:end]))
        if token is None:
            break
        at = token.end()
        name = (token[2] or "").lower()
        if not name or name in ("html", "body") or (not token[4] and at == len(page)):
            continue
        if token[1]:
            if not opened[name]:
                if name == "p" and not depth:
                    node.parts.append("\n")
                continue
            up = node
            while up.name != name and not (name in INLINE and up.name not in INLINE):
                up = up.parent
            if up.name != name:
                continue  # a stray end of an inline element does not close blocks
            node, depth = _left(node, up.parent, depth, opened)
            continue
        if name not in INLINE and name not in VOID and name not in RAW:
            node, depth = _closed_before(node, name, depth, opened)
        if name in RAW:
            close = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            stop = close.start() if close else len(page)
            tail = page.find(">", stop)
            at = len(page) if not close or tail < 0 else tail + 1
            continue
        child = Node(name, node)
        if name in VOID:
            if not depth:
                node.parts.append(child)
                node.children.append(child)
            continue
        child.dropped = _is_dropped(name, token[3])
        child.marked = _is_marked(name, token[3])
        child.aside = name in ASIDE and not (name == "header" and _inside_article(node))  # an article's own header is its title
        if not depth and not child.dropped:
            node.parts.append(child)
            node.children.append(child)
        depth += child.dropped
        if not token[3].rstrip().endswith("/") or name not in ("svg", "path"):
            node = child
            opened[name] += 1
        else:
            depth -= child.dropped
    return body


def _left(node: Node, to: Node, depth: int, opened: Counter[str]) -> tuple[Node, int]:
    """The node ``to``, with all that is open inside it closed."""
    while node is not to:
        depth -= node.dropped
        opened[node.name] -= 1
        node = node.parent
    return node, depth


def _closed_before(node: Node, name: str, depth: int, opened: Counter[str]) -> tuple[Node, int]:
    """The node that an element of this name opens in: it ends an open paragraph, and its like in lists and tables."""
    kinds, bounds = CLOSES.get(name, ((), ()))
    kinds = [k for k in kinds if opened[k]]
    up, found = node, None
    while up is not None and up.parent is not None and up.name not in bounds:
        if up.name == "p" or up.name in kinds:
            found = up
        if up.name not in INLINE and up.name != "p" and not kinds:
            break
        up = up.parent
    return _left(node, found.parent, depth, opened) if found is not None else (node, depth)


def _remove(nodes: list[Node]) -> None:
    """Takes the nodes out of the tree."""
    for node in nodes:
        node.dropped = True
    for node in {id(n.parent): n.parent for n in nodes}.values():
        node.children = [c for c in node.children if not c.dropped]
        node.parts = [p for p in node.parts if isinstance(p, str) or not p.dropped]


def _leave_out_asides(root: Node) -> None:
    """Takes menus, headers, footers and the like out, but for those that hold an article or main element and most of the page's
    text that is not linked."""
    order = _order(root)
    asides = [n for n in order if n.aside]
    if asides:
        _count(order)
        holding: set[int] = set()
        for node in order:
            if node.name in ARTICLE and node.chars > 2 * node.linked:
                _add_way_up(node, holding)
        _remove([n for n in asides if id(n) not in holding or 2 * (n.chars - n.linked) <= root.chars - root.linked])


def _leave_out_marked(root: Node) -> None:
    """Takes marked parts out of the tree, the smallest first.

    One stays if it holds an article or main element (not counting marked ones inside marked parts) or a part that stays, or if
    it holds most of the text that is left and not linked, or nothing else there is nearly as dense: "there" is the article or
    main element around it, or the page. What is outside such elements, where there are any, goes whatever its size.
    """
    order = _order(root)
    marked = [n for n in reversed(order) if n.marked]
    if not marked:
        return
    _count(order)
    _densities(order)
    named = [n for n in order if n.name in ARTICLE and n.chars > 2 * n.linked]
    stay: set[int] = set()
    under: set[int] = set()  # nodes inside marked ones
    for node in order:
        if node.parent is not None and (node.parent.marked or id(node.parent) in under):
            under.add(id(node))
    named = [n for n in named if not n.marked or id(n) not in under] or named
    for node in named:
        _add_way_up(node, stay)
    scopes = {id(n) for n in named or [root]}
    gone: dict[int, int] = {}
    for node in sorted(marked, key=lambda n: n.chars - n.linked):
        if id(node) in stay:
            continue
        here = node.chars - node.linked - gone.get(id(node), 0)
        scope: Node | None = node.parent
        while scope is not None and id(scope) not in scopes:
            scope = scope.parent
        left = scope.chars - scope.linked - gone.get(id(scope), 0) if scope is not None else 0
        if here and scope is not None and (2 * here > left or 4 * here > left and _is_densest(node, scope)):
            _add_way_up(node, stay)
            continue
        node.dropped = True
        up: Node | None = node
        while here and up is not None:
            gone[id(up)] = gone.get(id(up), 0) + here
            up = up.parent
    _remove([n for n in marked if n.dropped])


def _add_way_up(node: Node | None, ids: set[int]) -> None:
    while node is not None and id(node) not in ids:
        ids.add(id(node))
        node = node.parent


def _is_densest(node: Node, scope: Node) -> bool:
    """Whether no other part of ``scope`` has half the sum of child densities that a node of this part has."""
    order = _order(scope)
    inside = {id(n) for n in _order(node)}
    way: dict[int, float] = {}
    child = node
    while child is not scope and child.parent is not None:
        way[id(child.parent)] = child.density
        child = child.parent
    most = max(n.total for n in order if id(n) in inside)
    return most > 2 * max((n.total - way.get(id(n), 0.0) for n in order if id(n) not in inside and not n.dropped), default=0.0)


def _order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.children)
    return order


def _count(order: list[Node]) -> None:
    """Characters and tags of nodes, all and linked; ``order`` has parents before their children."""
    for node in reversed(order):
        node.tags = node.linked = node.link_tags = 0
        node.density = node.total = 0.0
        node.chars = sum(len(BLANK.sub(" ", p).strip()) for p in node.parts if isinstance(p, str))
        for child in node.children:
            node.chars += child.chars
            node.tags += child.tags + 1
            node.linked += child.linked
            node.link_tags += child.link_tags + (child.name == "a")
        if node.name == "a":
            node.linked = node.chars


def _densities(order: list[Node]) -> None:
    root = order[0]
    share = root.linked / root.chars if root.chars else 0.0
    for node in order:
        if not node.chars:
            continue
        tags, linked, link_tags = max(1, node.tags), max(1, node.linked), max(1, node.link_tags)
        plain = max(1, node.chars - node.linked)
        base = math.log(node.chars / plain * node.linked + share * node.chars + math.e)
        ratio = (node.chars / linked) * (tags / link_tags)
        node.density = max(0.0, node.chars / tags * (math.log(ratio) / math.log(base) if ratio > 1 and base > 1 else 0.0))
    for node in order:
        node.total = sum(c.density for c in node.children)


def main_nodes(root: Node) -> list[Node]:
    """Roots of the subtrees that hold the article, in page order. Menus inside an article or main element are taken out."""
    _leave_out_asides(root)
    _leave_out_marked(root)
    order = _order(root)
    _count(order)
    _densities(order)
    best = max(order, key=lambda n: n.total)
    if best.total <= 0:
        return [root]
    path = []
    up: Node | None = best
    while up is not None:
        path.append(up)
        up = up.parent
    least = min(n.density for n in path[:-1]) if len(path) > 1 else root.density
    if best is root:
        return [root]
    named = [k for k, n in enumerate(path) if n.name in ARTICLE]
    if named:
        path = path[named[-1]:]
    chosen = {id(path[0])}
    above = {id(n) for n in path}
    # siblings of the way down that are dense themselves; what holds the chosen one is not taken whole
    for n in path[1:]:
        chosen.update(id(c) for c in n.children if id(c) not in above and c.name not in INLINE and c.density >= least > 0)
    if named:
        _remove([n for n in _order(path[0])[1:] if n.name not in INLINE and n.link_tags >= MENU_LINKS
                 and 4 * n.linked >= 3 * n.chars and n.density < least])
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in chosen:
            out.append(node)
        else:
            stack.extend(reversed(node.children))
    return out


def _text(roots: list[Node]) -> str:
    blocks: list[list[str]] = [[]]
    for root in roots:
        stack: list[Node | str | None] = [root]
        while stack:
            part = stack.pop()
            if part is None:
                blocks.append([])
            elif isinstance(part, str):
                blocks[-1].append(part)
            elif part.name in INLINE:
                stack.extend(reversed(part.parts))
            else:
                blocks.append([])
                stack.append(None)
                stack.extend(reversed(part.parts))
    joined = (BLANK.sub(" ", "".join(b)).strip(" ") for b in blocks)
    return " ".join(b for b in joined if b)


def main_text(page: str) -> str:
    """The article of one page: blocks in page order, white space inside as one space, joined by one space."""
    return _text(main_nodes(parse(page))) if page else ""


def extract(pages: DataFrame, row_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``row_id``, ``url``, ``text`` (empty if there is none) and ``n_chars`` of each row.

    A NULL page is an empty one; a repeated row gives its text again; an empty table gives no rows. Pages are worked through one by
    one, whole; other columns play no part. Non-breaking blanks are characters like others and stay as they are.
    """
    used = pages.select(F.col(row_id).alias("_id"), F.col(url).alias("_url"), F.col(source).alias("_page"))
    schema = used.select(F.col("_id").alias(row_id), F.col("_url").alias(url)).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) if p else "" for p in batch.column("_page").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return by_batch(used, run, schema)
