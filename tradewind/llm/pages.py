r"""Main text of web pages by composite text density.

A page becomes a tree of its block elements; inline elements count as tags of the block they stand in. Elements that are
no article by their tag, role, class or id (menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts, styles) are left out. A whole token of class or role has to say so (``site-footer`` does, ``social-impact``
does not); an id counts on a ``div``, and outside articles on a ``section`` and lists, as ids of headings and what stands
under them are slugs of titles; an id that names comments counts in articles too. A form goes unless it wraps the page: it
stays if an ``article`` or ``main`` stands in it, or half of the page's characters with a paragraph. For every remaining
node

    density = C/T * log base ln(C/nLC * LC + LCb/Cb * C + e) of (C/LC * T/LT)

with C characters, T tags, LC characters and LT tags of links, nLC characters outside links, b the body; a zero counts
as one. The node with the largest sum of its children's densities is the main text; the smallest density on its path to
the body is the threshold, and further nodes at or above it add their own largest-sum subtrees. Density alone loses titles
and short sections of an article, so every outer ``article`` or ``main`` with text is taken whole besides.

Defined results: null or empty html, or html without text in its body, gives an empty text. Broken html is read as
browsers do in the common cases (unclosed p, li, td; stray end tags; end of file anywhere; elements without a body). From a
tag on whose quotes never close, tags end at the next ``>``; a tag that never ends is text. Time follows the length of a page.
Repeated rows are extracted one by one. Depth is limited by nothing but memory: no step is recursive.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of HTML elements, and words of class, id and role that name what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg canvas object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("nav header footer aside form button menu dialog head".split())
WHOLE = frozenset("article main".split())
CLOSES = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"),
          "dd": ("dt", "dd"), "option": ("option",)}
HOLDS = frozenset("ul ol table dl body html article section div main".split())
OUTSIDE_IDS = frozenset("div section ul ol dl table".split())
BAD_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored banner promo promotion sidebar side "
    "aside comment comments disqus respond replies cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related recommended "
    "newsletter subscribe subscription widget toolbar pagination pager login signin signup search complementary contentinfo "
    "skip".split())
#: Words that say only where or in what form something is: they may stand beside the others.
LAYOUT_WORDS = frozenset(
    "site page main global top bottom left right primary secondary inline box wrapper wrap container area region section block "
    "holder panel bar list item items links link buttons button icons slot unit banner menu form thread posts articles".split())
COMMENT_WORDS = frozenset("comment comments".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")  # of a tag, behind its name
_PLAIN_REST = re.compile(r"([^>]*+)>")
_TELLING = re.compile(r"class|id|role|style", re.I)  # in attributes that can leave an element out (hidden has id too)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_WORDS = re.compile(r"[A-Za-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total", "bad")

    def __init__(self, tag: str, parent: Node | None, bad: bool = False):
        self.tag, self.parent, self.bad = tag, parent, bad
        self.children: list[Node] = []
        self.parts: list = []  # texts and child nodes in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name; of repeated names the first counts."""
    out: dict[str, str] = {}
    for found in _ATTRIBUTE.finditer(raw):
        out.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
    return out


def _names_bad(token: str, inside: bool, words: frozenset = BAD_WORDS) -> bool:
    """Whether a token as a whole names boilerplate: by such words, and besides them words of layout and numbers alone."""
    parts = {w.lower() for w in _WORDS.findall(token)}
    said = parts & words
    if not said or inside and said <= {"header"}:
        return False
    return all(w in LAYOUT_WORDS or w.isdigit() for w in parts - words)


def _is_bad(tag: str, raw: str, inside: bool) -> bool:
    if tag in ("main", "body", "html"):
        return False
    if tag in NEVER:
        return not (tag == "header" and inside or tag == "form" and not inside)
    if not _TELLING.search(raw):
        return False
    given = _attributes(raw)
    tokens = given.get("class", "").split()
    if tag == "article":  # comments are often marked up as articles of their own
        return any(_names_bad(x, inside, COMMENT_WORDS) for x in tokens)
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or _NONE.search(given.get("style", "")):
        return True
    if any(_names_bad(x, inside) for x in tokens + given.get("role", "").split()):
        return True
    if tag in OUTSIDE_IDS and _names_bad(given.get("id", "").strip(), inside, COMMENT_WORDS):
        return True
    titled = tag != "div" or any(x.lower() == "section" for x in tokens)  # its id can be the slug of a title
    if titled and (inside or tag not in OUTSIDE_IDS):
        return False
    return _names_bad(given.get("id", "").strip(), inside)


def parse(page: str) -> Node:
    """The tree of block elements, with boilerplate marked ``bad`` (what stands in it is dropped at once)."""
    root = Node("html", None)
    stack: list[tuple[str, Node]] = [("html", root)]  # open elements and the block each writes to
    links = whole = 0
    at, end = 0, len(page)
    opened = Counter(["html"])
    unclosed: set[str] = set()  # kinds of raw elements that do not end in the rest of the page
    forms: list[Node] = []
    rest_of = _REST

    def text(raw: str) -> None:
        node = stack[-1][1]
        if node.bad or not raw:
            return
        got = entities.unescape(raw) if "&" in raw else raw
        node.parts.append(got)
        n = len(got.strip())
        node.chars += n
        if links:
            node.link_chars += n

    def pop() -> None:
        nonlocal links, whole
        tag, _ = stack.pop()
        opened[tag] -= 1
        links -= tag == "a"
        whole -= tag in WHOLE

    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at:found.start()])
        at = found.end()
        if not found[2]:
            if found[0].startswith("<![CDATA["):
                text(found[0][9:-3])
            continue
        rest = rest_of and rest_of.match(page, at)
        if rest_of is _REST and not rest:
            rest_of = _PLAIN_REST
            rest = rest_of.match(page, at)
        if not rest:
            rest_of = None
            text(found[0])
            continue
        at, raw = rest.end(), rest[1]
        tag, closing = found[2].lower(), found[1]
        if closing and not opened[tag]:
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        pop()
                    break
                if tag in INLINE and stack[k][0] not in INLINE or tag in CLOSES and stack[k][0] in HOLDS and stack[k][0] != tag:
                    break
            continue
        if tag in RAW:
            stop = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if not stop:
                unclosed.add(tag)
            at = stop.end() if stop else (end if tag in ("script", "style", "textarea", "title") else at)
            continue
        if tag in ("html", "body"):
            if tag == "body" and stack[-1][0] != "body" and all(t != "body" for t, _ in stack):
                while len(stack) > 1:
                    pop()
                stack.append(("body", root))
                opened["body"] += 1
            continue
        if tag in INLINE or tag in VOID:
            node = stack[-1][1]
            node.tags += 1
            if tag == "a":
                node.link_tags += 1
            if tag == "br":
                node.parts.append(" ")
            if tag == "hr":
                node.parts.append(Node("hr", node))
            if tag not in VOID and not raw.endswith("/"):
                if tag == "a":
                    links += 1
                stack.append((tag, Node("bad", node, True) if node.bad or _is_bad(tag, raw, whole > 0) else node))
                opened[tag] += 1
            continue
        ended = opened["p"] or any(opened[x] for x in CLOSES.get(tag, ()))
        for k in range(len(stack) - 1 if ended else 0, 0, -1):  # a block ends an open paragraph; list items and cells end their like
            open_tag = stack[k][0]
            if open_tag == "p" or open_tag in CLOSES.get(tag, ()):
                while len(stack) > k:
                    pop()
                if open_tag == "p":
                    continue
            if open_tag in HOLDS:
                break
        above = stack[-1][1]
        node = Node(tag, above, above.bad or _is_bad(tag, raw, whole > 0))
        if tag == "form" and not node.bad:
            forms.append(node)
        if not node.bad:
            above.children.append(node)
            above.parts.append(node)
        elif not above.bad:
            above.parts.append(Node("bad", above, True))  # it still parts the text around it
        if raw.endswith("/") and tag not in HOLDS:
            continue
        whole += tag in WHOLE
        stack.append((tag, node))
        opened[tag] += 1
    _drop_forms(root, forms)
    return root


def _drop_forms(root: Node, forms: list[Node]) -> None:
    """Empties and detaches ``forms`` that do not wrap the page."""
    if not forms:
        return
    nodes = _ordered(root)
    chars, wraps = {id(x): x.chars for x in nodes}, {id(x): (x.tag in WHOLE, x.tag == "p") for x in nodes}
    for node in reversed(nodes):
        for child in node.children:
            chars[id(node)] += chars[id(child)]
            wraps[id(node)] = tuple(a or b for a, b in zip(wraps[id(node)], wraps[id(child)], strict=True))
    for form in forms:
        has_whole, has_paragraph = wraps[id(form)]
        if not (has_whole or has_paragraph and 2 * chars[id(form)] >= chars[id(root)]):
            form.bad, form.parts, form.children = True, [], []
            form.chars = form.tags = form.link_chars = form.link_tags = 0
    for parent in {id(x.parent): x.parent for x in forms}.values():
        parent.children = [x for x in parent.children if not x.bad]


def _ordered(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out = [root]
    for node in out:
        out.extend(node.children)
    return out


def main_nodes(root: Node) -> list[Node]:
    nodes = _ordered(root)
    for node in reversed(nodes):
        for child in node.children:
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.link_tags += child.link_tags
    if not root.chars:
        return []
    share = root.link_chars / root.chars
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + share * c + math.e)
            ratio = max(c / lc * t / lt, 1.0)
            node.density = c / t * (math.log(ratio) / math.log(base) if base > 1 + 1e-9 else math.log(ratio + math.e))
        node.total = sum(x.density for x in node.children)
    best = max(nodes, key=lambda x: x.total)
    if not best.total:
        best = max(nodes, key=lambda x: x.density)
    path = _path(best)
    least = min(x.density for x in path)
    taken, queue = [], [root]
    best_path = set(map(id, path))
    for node in queue:
        if node is best:
            taken.append(node)
        elif id(node) in best_path:
            queue.extend(node.children)
        elif node.density >= least and node.total > 0 and node.density > 0:
            taken.append(max(_ordered(node), key=lambda x: x.total))
        elif node.density >= least and node.density > 0 and not node.children:
            taken.append(node)
        else:
            queue.extend(node.children)
    queue = [root]
    for node in queue:  # articles are whole, also what of them is below the threshold
        if node.tag in WHOLE and node.chars:
            taken.append(node)
        else:
            queue.extend(node.children)
    return taken


def _path(node: Node | None) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def blocks(root: Node, chosen: list[Node]) -> list[str]:
    """The texts of the chosen subtrees in page order: runs of text between block borders, white space made single."""
    wanted, out, run = set(map(id, chosen)), [], []

    def close() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    todo: list[tuple[object, bool]] = [(root, False)]
    while todo:
        part, inside = todo.pop()
        if isinstance(part, str):
            if inside:
                run.append(part)
            continue
        if part is None:
            close()
            continue
        inside = inside or id(part) in wanted
        close()
        todo.append((None, inside))
        todo.extend((x, inside) for x in reversed(part.parts))
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    return "\n\n".join(blocks(root, main_nodes(root)))


def _run(batches):
    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id bigint, url string, text string, n_chars bigint")
