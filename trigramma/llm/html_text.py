"""Main text of web pages by scoring the tree of their elements.

Every block of text earns points for its length and its commas, discounted by the share of
its text that is inside links, and passes them up to all its ancestors. Names of classes that
menus, adverts and comments go by lower what is inside; the elements made for articles raise
it. The smallest container that holds the main share of the page's points is kept, with those of its
siblings that belong to it, whole but for what has a lowered score inside.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# One token of markup. Quantifiers do not give back, so a stray quote or "<" costs no more
# than the characters it is followed by.
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title|select|object)\b[^>]*+>"
    r"(?:(?<=/>)|.*?</(?P=raw)\s*>|.*)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|</?[a-z][^<>]*$",
    re.I | re.S,
)
_HINT = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
# Elements that are never part of an article.
LEFT_OUT = frozenset("nav header footer aside form button menu dialog head fieldset audio video canvas".split())
# Elements made for the article: these are not looked into for a smaller container.
ARTICLE = frozenset("article main".split())
# Words of a class, id or role that lower a score where the whole name consists of them and of `NEUTRAL`.
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promotion"
    " banner cookie cookies consent gdpr notice notices alert popup modal overlay menu menus nav navbar navigation"
    " breadcrumb breadcrumbs footer header masthead sidebar sidebars aside widget widgets comment comments"
    " commentlist respond reply replies disqus discussion share sharing social related recommended recommendations"
    " newsletter subscribe subscription signup login search pagination pager toolbar toc complementary"
    " contentinfo skip".split()
)
NEUTRAL = frozenset(
    "area bar block bottom box container content footer group inner left link links list main outer page panel right"
    " section site small top unit wrap wrapper".split()
)
WHOLE = frozenset(["html", "body", "main", "article"])
# What names and elements do to points; the share of all points that the container holds; the share of its
# points from which a sibling of another kind belongs to it, and from which a lowered part stays.
LOWERED = 0.1
RAISED = 4.0
MAIN_SHARE = 0.6
SIBLING = 0.2
PART = 0.5
# An open element of the first group ends where one of its second group starts.
ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
# An open element of these groups is not closed from inside these.
SCOPE = frozenset("ul ol dl table body html article section div main blockquote".split())
PARAGRAPHS = frozenset("p td pre li dd blockquote".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "points", "weighted", "factor", "chars", "linked", "out", "names", "lowered")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent = tag, parent
        self.parts: list[Node | str] = []
        self.points = self.weighted = 0.0
        self.chars = self.linked = 0
        self.out = tag in LEFT_OUT or tag not in WHOLE and bool(attrs) and bool(_HIDDEN.search(attrs))
        self.names = [found[1].strip("\"'") for found in _HINT.finditer(attrs)] if attrs else []
        self.lowered = tag not in WHOLE and any(_lowers(name) for names in self.names for name in names.split())


def _lowers(name: str) -> bool:
    """A name of nothing but words that lower a score, one at least."""
    words = {w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w}
    return not words.isdisjoint(LEFT_OUT_WORDS) and words <= LEFT_OUT_WORDS | NEUTRAL


def parse(page: str) -> Node:
    """The tree of a page; end tags that are missing or too many are made up for."""
    root = Node("#root", None)
    at = root
    spot = 0
    for token in _TOKEN.finditer(page):
        if token.start() > spot:
            at.parts.append(page[spot : token.start()])
        spot = token.end()
        tag = token["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if token["close"]:
            open_one = at
            while open_one.parent and open_one.tag != tag:
                # An inline end tag does not end blocks.
                if tag in INLINE and open_one.tag not in INLINE:
                    break
                open_one = open_one.parent
            if open_one.parent and open_one.tag == tag:
                at = open_one.parent
            continue
        if tag not in INLINE:
            # A block ends the paragraph it is in, with all that is open inside.
            open_one = at
            while open_one.parent and (open_one.tag in INLINE):
                open_one = open_one.parent
            if open_one.tag == "p":
                at = open_one.parent
        for ended in ENDS:
            if tag in ENDS[ended]:
                open_one = at
                while open_one.parent and open_one.tag != ended and open_one.tag not in SCOPE:
                    open_one = open_one.parent
                if open_one.tag == ended:
                    at = open_one.parent
        node = Node(tag, at, token["attrs"])
        at.parts.append(node)
        if tag not in VOID and not token["attrs"].endswith("/"):
            at = node
    if spot < len(page):
        at.parts.append(page[spot:])
    return root


def _walk(root: Node) -> Iterator[Node]:
    """Nodes that are not left out, parents first; without recursion, however deep they are."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.out)


def _measure(root: Node) -> list[Node]:
    order = list(_walk(root))
    for node in reversed(order):
        own = sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        node.chars += own
        if node.tag == "a":
            node.linked = node.chars
        if node.parent:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    return order


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _own_text(node: Node) -> str:
    """Text of a block without that of blocks inside."""
    pieces: list[str] = []
    waiting: list[Node | str] = list(reversed(node.parts))
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            pieces.append(part)
        elif part.tag in INLINE and not part.out:
            waiting.extend(reversed(part.parts))
    return " ".join("".join(pieces).split())


def _score(root: Node) -> None:
    """Points of every subtree, as earned and as weighted by names and elements."""
    order = _measure(root)
    for node in order:
        above = node.parent.factor if node.parent else 1.0
        raised = node.tag in ARTICLE and above < RAISED
        node.factor = above * (LOWERED if node.lowered else 1.0) * (RAISED if raised else 1.0)
        text = "" if node.tag in INLINE else _own_text(node)
        if text:
            points = min(len(text) / 100, 3) + (1 + text.count(",") if len(text) >= 25 else 0)
            node.points = points * (1 - _own_density(node))
            node.weighted = node.points * node.factor
    for node in reversed(order):
        if node.parent:
            node.parent.points += node.points
            node.parent.weighted += node.weighted


def _own_density(node: Node) -> float:
    """Share of a block's own text that is inside links."""
    own = linked = 0
    waiting: list[tuple[Node | str, bool]] = [(part, node.tag == "a") for part in node.parts]
    while waiting:
        part, link = waiting.pop()
        if isinstance(part, str):
            own += len(part.strip())
            linked += len(part.strip()) * link
        elif part.tag in INLINE and not part.out:
            waiting.extend((inner, link or part.tag == "a") for inner in part.parts)
    return linked / own if own else 0.0


def _belongs(part: Node, best: Node) -> bool:
    """Whether a sibling is kept with the best container."""
    if part.lowered or _density(part) >= 0.5:
        return False
    if part.tag in PARAGRAPHS or re.fullmatch("h[1-6]", part.tag):
        return best.tag not in ARTICLE
    alike = part.tag == best.tag and part.names == best.names and bool(best.names or best.tag == "section")
    return alike and part.points > 0 or part.weighted >= SIBLING * best.weighted


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings to keep with it, in page order."""
    _score(root)
    if not root.weighted:
        return [root]
    best = root
    while best.tag not in ARTICLE:
        inside = [p for p in best.parts if isinstance(p, Node) and not p.out and p.tag not in INLINE]
        # Paragraphs, lists and tables are parts of a text, not what holds it.
        inside = [p for p in inside if p.tag not in PARAGRAPHS and p.tag not in ("ul", "ol", "dl", "table")]
        largest = max(inside, key=lambda n: n.weighted, default=None)
        if largest is None or largest.weighted < MAIN_SHARE * root.weighted or re.fullmatch("h[1-6]", largest.tag):
            break
        best = largest
    around = best.parent.parts if best.parent else [best]
    kept = [p for p in around if p is best or isinstance(p, Node) and not p.out and _belongs(p, best)]
    for top in kept:
        for node in _walk(top):
            if node.lowered and node is not top and node.weighted < PART * top.weighted:
                node.out = True
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks, in page order."""
    found: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            found.append(text)
        held.clear()

    waiting: list[Node | str | None] = list(reversed(nodes))
    while waiting:
        part = waiting.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            held.append(part)
        elif part.tag in ("br", "wbr"):
            held.append(" " if part.tag == "br" else "")
        elif not part.out:
            inline = part.tag in INLINE
            if not inline:
                flush()
                waiting.append(None)
            waiting.extend(reversed(part.parts))
    flush()
    return found


def main_text(page: str | None) -> str:
    return "\n".join(blocks(main_nodes(parse(page)))) if page else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Inside what is kept, nothing is left out but elements that are never part of an article
    (`LEFT_OUT`), hidden ones, and those whose lowered score is less than half of its own.
    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined by a line feed. Null and empty pages, and pages without text of
    their own, give an empty text. Of equally good containers the first wins. Cut-off
    pages are read as far as they go. Rows are independent, so repeated rows repeat their
    result; an empty table gives an empty result; extra columns are not read.
    """
    some = pages.select("page_id", "url", "html")
    kind = some.schema["page_id"].dataType.simpleString()
    return some.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
