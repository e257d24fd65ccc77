"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks, each with its path of open elements. A logistic
classifier over the path and the text gives every block a probability p of being content;
-log p and -log(1 - p) are the capacities to the two terminals. Smoothness edges join
neighbours on the page (less, the farther apart they are in the tree) and neighbours
under one parent. The minimum cut, found by maximum flow, separates content from the rest:
it minimizes classifier cost plus the capacity between differently labelled blocks.

Null and empty pages, and pages without content, give the empty text. Pages may be cut
off anywhere; open elements then end with the page. Every page is read whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from starledger.llm.base import texts_of

# Element classes of HTML and of common page templates.
SKIPPED = {
    "script", "style", "noscript", "template", "head", "title", "iframe", "object", "svg",
    "math", "canvas", "audio", "video", "textarea", "select", "button", "datalist",
}
#: What may stand in a head; other start tags, and text, end one that is open.
IN_HEAD = {
    "html", "head", "base", "basefont", "bgsound", "link", "meta", "title", "noscript", "noframes",
    "style", "script", "template",
}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "input", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
EMPTY = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track",
    "wbr",
}
#: An opening tag also ends an open element of these names, up to the nearest container.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"},
}
#: Block elements that end an open paragraph.
ENDS_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre",
    "section", "table", "ul",
}
SCOPES = {"ul", "ol", "dl", "table", "body", "article", "section", "div", "main", "html"}

# Weights of the classifier, in log-odds of content.
BIAS = -1.0
CONTENT_TAGS = {"article": 5.0, "main": 3.0}
REST_TAGS = {
    "nav": -9.0, "header": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0,
    "dialog": -9.0,
}
CONTENT_NAMES = re.compile(r"(?:^|[-_])(?:article|post|entry|story|content|main)(?:$|[-_])")
REST_NAMES = re.compile(
    r"(?:^|[-_])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|cookies?|"
    r"disclaimer|footer|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    r"notices?|pagination|popup|promo|promoted|related|replies|respond|share|sharing|sidebar|"
    r"signup|social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[-_])"
)
REST_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "form"}
CONTENT_NAME, REST_NAME, HIDDEN = 2.0, -9.0, -12.0
PER_LOG_WORD, LINKED, SENTENCE, HEADING = 0.7, -5.0, 0.8, 0.3

#: Capacities of the smoothness edges.
NEXT_ON_PAGE, NEXT_UNDER_PARENT = 0.6, 0.8
#: Capacities are whole numbers of this fraction.
SCALE = 1000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only behind an equals sign.
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Elements whose content is plain text up to their own end tag, and that tag.
RAW_END = {
    name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in ("script", "style", "textarea", "title")
}


@dataclass
class Element:
    name: str
    weight: float
    depth: int
    skipped: bool
    parent: Element | None


@dataclass
class Block:
    parent: Element
    text: list[str] = field(default_factory=list)
    linked: int = 0


def _weight(name: str, attributes: str) -> float:
    weight = CONTENT_TAGS.get(name, 0.0) + REST_TAGS.get(name, 0.0)
    if not attributes.strip():
        return weight
    rest = False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id"):
            names = value.split()
            if any(REST_NAMES.search(x) for x in names):
                rest = True
            elif any(CONTENT_NAMES.search(x) for x in names):
                weight += CONTENT_NAME
        elif key == "role" and value in REST_ROLES:
            rest = True
        elif key == "role" and value in ("main", "article"):
            weight += CONTENT_TAGS["main"]
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            weight += HIDDEN
    return weight + (REST_NAME if rest and name not in ("html", "body") else 0.0)


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; the text of a block is not decoded yet."""
    top = Element("#page", 0.0, 0, False, None)
    stack, blocks, block = [top], [], None
    open_count: dict[str, int] = {}
    links = at = 0

    def text(piece: str) -> None:
        nonlocal block
        if stack[-1].name == "head" and piece.strip():
            close(len(stack) - 1)
        if stack[-1].skipped or not piece:
            return
        if block is None:
            if piece.isspace():
                return
            block = Block(next(e for e in reversed(stack) if e.name not in INLINE))
            blocks.append(block)
        block.text.append(piece)
        if links:
            block.linked += len(piece)

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            gone = stack.pop()
            open_count[gone.name] -= 1
            links -= gone.name == "a"

    def ends_head(name: str, at: int) -> bool:
        """Whether a start tag ends the open head; one inside a closed noscript does not."""
        if name in IN_HEAD or not open_count.get("head"):
            return False
        inside = [x for x in ("noscript", "template") if open_count.get(x)]
        if inside and not last_end:
            last_end[""] = 0  # searched for once
            for end in re.finditer(r"</(noscript|template)\b", page, re.I):
                last_end[end[1].lower()] = end.start()
        return name == "body" or not any(last_end.get(x, 0) > at for x in inside)

    last_end: dict[str, int] = {}
    search_from = 0
    while match := TOKEN.search(page, search_from):
        text(page[at : match.start()])
        at = search_from = match.end()
        if not match[2]:
            continue
        name = match[2].lower()
        if not match[1] and ends_head(name, at):
            close(max(i for i, e in enumerate(stack) if e.name == "head"))
        if name == "br":
            text(" ")
            continue
        if name not in INLINE:
            block = None
        if match[1]:
            if open_count.get(name):
                close(max(i for i, e in enumerate(stack) if e.name == name))
            continue
        ended = CLOSES.get(name) or ({"p"} if name in ENDS_P else None)
        if ended and any(open_count.get(x) for x in ended):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in SCOPES and name in CLOSES:
                    break
                if stack[i].name in ended:
                    close(i)
        if name in EMPTY or match[3].rstrip().endswith("/"):
            continue
        above = stack[-1]
        weight = above.weight + _weight(name, match[3])
        stack.append(Element(name, weight, above.depth + 1, above.skipped or name in SKIPPED, above))
        open_count[name] = open_count.get(name, 0) + 1
        links += name == "a"
        if name in RAW_END:
            end = RAW_END[name].search(page, at)
            if not end:  # the rest of the page belongs to it
                return blocks
            search_from = end.start()
    text(page[at:])
    return blocks


def log_odds(block: Block, text: str) -> float:
    """The classifier's log-odds that a block is content."""
    words = text.count(" ") + 1
    linked = min(1.0, block.linked / max(1, len(text)))
    odds = BIAS + block.parent.weight + PER_LOG_WORD * math.log1p(words) + LINKED * linked
    odds += SENTENCE * (text[-1] in ".!?\"…" or text[-1] == "”")
    return odds + HEADING * (len(block.parent.name) == 2 and block.parent.name[0] == "h")


def tree_distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks with their capacities."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            apart = tree_distance(blocks[i - 1].parent, block.parent)
            edges.append((i - 1, i, NEXT_ON_PAGE / (1 + apart)))
        above = block.parent.parent if block.parent.parent else block.parent
        before = last.get(id(above))
        if before is not None and blocks[before].parent.name == block.parent.name:
            edges.append((before, i, NEXT_UNDER_PARENT))
        last[id(above)] = i
    return edges


def minimum_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source side; `gains` are source less sink capacities.

    Maximum flow by shortest augmenting paths in phases. Where both labels cost the same,
    a node goes to the sink side.
    """
    left = [round(gain * SCALE) for gain in gains]
    if not any(x > 0 for x in left) or not any(x < 0 for x in left):
        return [x > 0 for x in left]
    n = len(left)
    near: list[list[int]] = [[] for _ in range(n)]
    room, ends = [], []
    for a, b, capacity in edges:
        near[a].append(len(room))
        near[b].append(len(room) + 1)
        room += [round(capacity * SCALE)] * 2
        ends += [b, a]
    while True:
        level = [0 if x > 0 else -1 for x in left]
        queue = deque(i for i in range(n) if left[i] > 0)
        reached = False
        while queue:
            node = queue.popleft()
            reached |= left[node] < 0
            for edge in near[node]:
                if room[edge] and level[ends[edge]] < 0:
                    level[ends[edge]] = level[node] + 1
                    queue.append(ends[edge])
        if not reached:
            return [depth >= 0 for depth in level]
        tried = [0] * n
        for source in range(n):
            while left[source] > 0 and level[source] == 0:
                if not _augment(source, left, near, room, ends, level, tried):
                    break


def _augment(source, left, near, room, ends, level, tried) -> bool:
    """Send flow along one path of rising levels from the source to a node with sink room."""
    path: list[int] = []
    node = source
    while True:
        if left[node] < 0:
            flow = min([left[source], -left[node], *(room[e] for e in path)])
            left[source] -= flow
            left[node] += flow
            for edge in path:
                room[edge] -= flow
                room[edge ^ 1] += flow
            return True
        while tried[node] < len(near[node]):
            edge = near[node][tried[node]]
            if room[edge] and level[ends[edge]] == level[node] + 1:
                path.append(edge)
                node = ends[edge]
                break
            tried[node] += 1
        else:
            if not path:
                return False
            node = ends[path.pop() ^ 1]
            tried[node] += 1


def extract(page: str | None) -> str:
    """The main text of one page, a block a line."""
    if not page:
        return ""
    found = [(b, " ".join(html.unescape("".join(b.text)).split())) for b in blocks_of(page)]
    found = [(block, text) for block, text in found if text]
    gains = [log_odds(block, text) for block, text in found]
    keep = minimum_cut(gains, smoothness([block for block, _ in found]))
    return "\n".join(text for (_, text), kept in zip(found, keep) if kept)


def main_text(page: Column) -> Column:
    """Main text of a column of HTML."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([extract(page) for page in texts_of(column).to_pylist()], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(page)
