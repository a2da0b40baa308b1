"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Scripts, styles, forms, menus and other furniture are
left out by element and by class or id. Each paragraph earns points for its length and
commas and passes them to its ancestors, the nearer the more; a container's points are
discounted by its share of link text; points reach ``REACH`` levels up. A best container within an article or main element stands
for all of that element; any other is kept with those siblings that score well or read like text. Null and empty html, and pages without text, give an empty
string. A class, id or role that names layout (a sidebar, a menu), a form, or a page header does not drop what
holds the page's only article or main element or, without such elements, most of its paragraph points.
Broken markup is closed where the next block or the parent's end shows it; an
unclosed script or style reaches to the end, and a tag that never ends is text. The time is
in proportion to the page, however broken it is. Each page is handled alone, so repeated rows
stay repeated rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import takewhile

from pyspark.sql import DataFrame, SparkSession

from cdcmart.llm.common import map_rows, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg math object".split())
#: Elements that never hold main text.
DROP = RAW | frozenset("head nav footer aside button select option dialog menu canvas audio video label".split())
#: Levels that a paragraph's points reach.
REACH = 64
#: Words that name furniture as a part of a class, id or role token, as in main-nav or ad-slot.
_FURNITURE = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|footer|header|masthead|"
    r"related|recommend\w*|sharing|share|social|widget|toolbar|pagination|pager|copyright|disclaimer"
)
#: Words that do so only as a whole token; in side-by-side they are said of the layout.
_ALONE = frozenset("side foot skip legal tags rating reply respond alert".split())
#: What holds words, but never those of the page.
_NEVER = re.compile(
    r"cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscribe|signup|login|comments?|commentlist|replies|disqus"
)
_OUT_OF_SIGHT = frozenset("hidden is-hidden visually-hidden visuallyhidden".split())
#: What follows these in a token is said of the layout: has-sidebar, no-comments.
_STATES = frozenset("has have with without no".split())
_STORY = frozenset("article entry post story content".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPACE = re.compile(r"[\s/]*")
_KEY = re.compile(r"[^\s=>/][^\s=>/]*|=[^\s=>/]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")
#: What an opening tag closes when it is still open.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "article", "section", "main", "div", "body", "td", "th", "li", "blockquote", "aside", "nav", "header", "footer", "form"}
_PARAGRAPH_END = BLOCK - {"br"}


KEPT, LAYOUT, GONE = 0, 1, 2


class Node:
    """``dropped``: KEPT, LAYOUT (furniture by its looks, unless it holds the page's text), or GONE."""

    __slots__ = ("children", "dropped", "inside", "name", "parent", "score")

    def __init__(self, name: str, parent: Node | None, dropped: int = KEPT):
        self.name, self.parent, self.dropped, self.score = name, parent, dropped, 0.0
        self.inside = name in ("article", "main") or (parent is not None and parent.inside)
        self.children: list[Node | str] = []


class Page:
    """Where quotes and tag ends are last found in a page, so that none is looked for twice in vain."""

    def __init__(self, text: str):
        self.text, self.size = text, len(text)
        self.last = {mark: text.rfind(mark) for mark in ("'", '"', ">", "-->")}

    def find(self, mark: str, at: int) -> int:
        """The next place of a mark, or -1."""
        return -1 if at > self.last[mark] else self.text.find(mark, at)

    def attributes(self, at: int) -> tuple[list[tuple[str, str]], bool, int]:
        """Attributes of a tag from behind its name, whether it closes itself, and the place behind the tag (-1: it has no end)."""
        text, found = self.text, []
        if self.find(">", at) < 0:
            return found, False, -1
        while True:
            space = _SPACE.match(text, at)
            at = space.end()
            if at >= self.size:
                return found, False, -1
            if text[at] == ">":
                return found, space[0].endswith("/"), at + 1
            key = _KEY.match(text, at)
            at = key.end()
            value = ""
            if equals := _EQUALS.match(text, at):
                at = equals.end()
                quote = text[at : at + 1]
                if quote in ("'", '"') and (end := self.find(quote, at + 1)) >= 0:
                    value, at = text[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(text, at)
                    value, at = bare[0], bare.end()
            found.append((key[0].lower(), value))


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b[^>]*>", re.I)


class _Open:
    """The open elements, and how many of each name there are."""

    def __init__(self, root: Node):
        self.stack, self.counts = [root], Counter()
        #: Depths of open paragraphs, and of elements that a new block does not look past.
        self.paragraphs: list[int] = []
        self.scopes: list[int] = []

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def push(self, node: Node) -> None:
        if node.name == "p":
            self.paragraphs.append(len(self.stack))
        elif node.name in _SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append(node)
        self.counts[node.name] += 1

    def pop(self) -> Node:
        node = self.stack.pop()
        self.counts[node.name] -= 1
        for depths in (self.paragraphs, self.scopes):
            if depths and depths[-1] == len(self.stack):
                depths.pop()
        return node

    def close(self, name: str) -> bool:
        """Close the innermost element of this name, and what is open in it."""
        if not self.counts[name]:
            return False
        while self.pop().name != name:
            pass
        return True

    def end_paragraph(self) -> None:
        if self.paragraphs and (not self.scopes or self.paragraphs[-1] > self.scopes[-1]):
            self.close("p")

    def end_items(self, names: set[str]) -> None:
        """Close the innermost of these items unless another container lies between."""
        if not any(self.counts[name] for name in names):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth].name
            if name in names:
                while len(self.stack) > depth:
                    self.pop()
                return
            if name in _SCOPE and name not in ("li", "td", "th"):
                return


def parse(page: str) -> Node:
    """The tree of a page; text is still encoded, furniture is marked as dropped."""
    root = Node("#root", None)
    opened, told, at = _Open(root), Page(page), 0
    while at < told.size:
        start = page.find("<", at)
        if start < 0:
            break
        if start > at:
            opened.top.children.append(page[at:start])
        at = start
        mark = page[start + 1 : start + 2]
        if mark in ("!", "?"):
            comment = page.startswith("<!--", start)
            end = told.find("-->" if comment else ">", start + 2)
            if end < 0 and not comment:
                break
            at = told.size if end < 0 else end + (3 if comment else 1)
            continue
        closing = mark == "/"
        named = _NAME.match(page, start + 1 + closing)
        if not named:
            opened.top.children.append("<")
            at = start + 1
            continue
        attributes, alone, end = told.attributes(named.end())
        if end < 0:
            # No tag ends any more: the rest is text.
            break
        name, at = named[0].lower(), end
        if closing:
            if not opened.close(name) and name == "p":
                opened.top.children.append(Node("p", opened.top))
            continue
        if name in _PARAGRAPH_END:
            opened.end_paragraph()
        if name in _CLOSES:
            opened.end_items(_CLOSES[name])
        node = Node(name, opened.top, _dropped(name, attributes, opened.top))
        opened.top.children.append(node)
        if name in RAW:
            finish = None if alone else _raw_end(name).search(page, at)
            at = at if alone else finish.end() if finish else told.size
        elif name not in VOID and not alone:
            opened.push(node)
    if at < told.size:
        opened.top.children.append(page[at:])
    _rescue(root)
    return root


def _points(length: int, commas: int) -> float:
    return 1 + commas + min(length / 100, 3)


def _rescue(root: Node) -> None:
    """Keep what looks like furniture but holds the page's text."""
    nodes: list[Node] = [root]
    seen = {id(root): KEPT}  # the worst mark on the way to a node
    for node in nodes:
        for child in node.children:
            if not isinstance(child, str) and child.dropped != GONE:
                nodes.append(child)
                seen[id(child)] = max(seen[id(node)], child.dropped)
    if all(mark == KEPT for mark in seen.values()):
        return
    stories = [node for node in nodes if node.name in ("article", "main")]
    if any(seen[id(node)] == KEPT for node in stories):
        return
    # Points of the paragraphs (or bare texts) below each node.
    points = dict.fromkeys(seen, 0.0)
    for node in reversed(nodes):
        own = [child.strip() for child in node.children if isinstance(child, str)]
        length = sum(map(len, own))
        if length and node.name != "a":
            points[id(node)] += _points(length, sum(text.count(",") for text in own)) if length >= 25 else length / 100
        if node.parent is not None:
            points[id(node.parent)] += points[id(node)]
    if stories:
        best: Node | None = max(stories, key=lambda node: points[id(node)])
        while best is not None:
            best.dropped = KEPT
            best = best.parent
        return
    for node in nodes:  # parents come first
        if node.dropped == LAYOUT and points[id(node)] > points[id(root)] / 2:
            node.dropped = KEPT


@lru_cache(1 << 16)
def _furniture(value: str, inside: bool) -> int:
    """What a class, id or role says; ``inside`` an article or main element headers do not name furniture."""
    worst = KEPT
    for token in value.lower().split():
        if token in _OUT_OF_SIGHT:
            return GONE
        if token in _ALONE:
            worst = LAYOUT
        parts = re.split("[-_]+", token)
        for part in takewhile(lambda part: part not in _STATES, parts):
            if _NEVER.fullmatch(part):
                return GONE
            if _FURNITURE.fullmatch(part) and not (part == "header" and (inside or _STORY.intersection(parts))):
                worst = LAYOUT
    return worst


def _dropped(name: str, attributes: list[tuple[str, str]], parent: Node) -> int:
    if name in DROP:
        return GONE
    worst = LAYOUT if name == "form" or (name == "header" and not parent.inside) else KEPT
    if name not in ("html", "body", "article", "main"):
        for key, value in attributes:
            told = value.strip().lower()
            if key == "hidden" and not told.startswith("until"):
                return GONE
            if key == "aria-hidden" and told == "true":
                return GONE
            if key == "style" and _NO_DISPLAY.search(told):
                return GONE
            if key in ("class", "id", "role"):
                worst = max(worst, _furniture(value, parent.inside))
    return worst


def blocks(node: Node) -> list[tuple[Node, str, int]]:
    """(block element, text, length of its link text) in page order, furniture left out."""
    found: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    links = 0
    owner = node

    def close() -> None:
        nonlocal links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append((owner, text, min(links, len(text))))
            parts.clear()
        links = 0

    # An explicit stack: pages may be nested deeper than Python's calls.
    stack: list[tuple[Node, int, bool]] = [(node, 0, node.name == "a")]
    owners = [node]
    while stack:
        here, i, linked = stack.pop()
        if i == 0 and here.name in BLOCK:
            close()
            if here.name != "br":
                owners.append(here)
            owner = owners[-1]
        if i < len(here.children):
            stack.append((here, i + 1, linked))
            child = here.children[i]
            if isinstance(child, str):
                parts.append(child)
                if linked:
                    links += len(child.strip())
            elif not child.dropped:
                if child.children or child.name in BLOCK:
                    stack.append((child, 0, linked or child.name == "a"))
        elif here.name in BLOCK:
            close()
            if here.name != "br" and len(owners) > 1:
                owners.pop()
            owner = owners[-1]
    close()
    return found


def main_text(page: str | None) -> str:
    """Blocks of the best container (of all its article or main element) and of its text-like siblings, joined by spaces."""
    if not page:
        return ""
    root = parse(page)
    found = blocks(root)
    if not found:
        return ""
    # Nodes in page order, parents first.
    nodes: list[Node] = [root]
    for node in nodes:
        nodes.extend(child for child in node.children if not isinstance(child, str) and not child.dropped)
    sizes: dict[int, list[int]] = {}
    for block, text, linked in found:
        total = sizes.setdefault(id(block), [0, 0])
        total[0] += len(text)
        total[1] += linked
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        headline = block.name in ("h1", "h2", "h3", "h4", "h5", "h6")
        up, level = (block.parent if block.name in ("p", "li", "pre", "td", "blockquote") or headline else block), 0
        # To the parent all points, to the next half of them, then less.
        while up is not None and level < REACH:
            up.score += points * (1.0 if level == 0 else 0.5 if level == 1 else 1 / (level * 3))
            up, level = up.parent, level + 1
    for node in reversed(nodes):
        if id(node) in sizes and node.parent is not None:
            total = sizes.setdefault(id(node.parent), [0, 0])
            total[0] += sizes[id(node)][0]
            total[1] += sizes[id(node)][1]
    touched = [node for node in nodes if id(node) in sizes or node.score]

    def density(node: Node) -> float:
        total = sizes.get(id(node))
        return total[1] / total[0] if total and total[0] else 0.0

    def final(node: Node) -> float:
        weight = {"article": 1.5, "main": 1.2}.get(node.name, 1.0)
        return node.score * weight * (1 - density(node))

    candidates = [n for n in touched if n.name not in ("p", "li", "ul", "ol", "a", "span", "b", "i", "em", "strong")]
    best = max(candidates or touched, key=final)
    bound = max(10.0, 0.2 * final(best))
    # The outermost article or main element is kept whole: its parts need no score.
    up = best
    while up is not None:
        if up.name in ("article", "main"):
            best = up
        up = up.parent
    keep = {id(best)}
    if best.parent is not None:
        for sibling in best.parent.children:
            if isinstance(sibling, str) or id(sibling) not in sizes or sibling is best:
                continue
            length, dense = sizes[id(sibling)][0], density(sibling)
            if final(sibling) >= bound or (sibling.name == "p" and dense < 0.25 and length >= 80):
                keep.add(id(sibling))
    for node in nodes:
        if node.parent is not None and id(node.parent) in keep:
            keep.add(id(node))
    return " ".join(text for block, text, _ in found if id(block) in keep)


def extract(frame: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """``keys`` and the main text of each row."""

    def work(row: dict) -> Iterator[tuple]:
        text = main_text(row[html])
        yield *[row[key] for key in keys], text, len(text)

    kept = ", ".join(f"`{key}` {frame.schema[key].dataType.simpleString()}" for key in keys)
    return map_rows(frame.select(*keys, html), work, f"{kept}, text string, n_chars bigint")


def op7_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
