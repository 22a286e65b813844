"""Main text of web pages: blocks labelled by a minimum cut."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of HTML: elements without an end, elements whose content is no text of the page,
#: and elements that run inside a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg iframe object math canvas audio video textarea title".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())

#: Names in tags, classes and ids that speak for or against content, with their cost in nats.
AGAINST_TAGS = {"nav": 6.0, "footer": 6.0, "aside": 6.0, "form": 6.0, "menu": 6.0, "dialog": 6.0, "button": 6.0, "select": 6.0, "header": 4.0, "head": 9.0}
FOR_TAGS = {"article": 4.0, "main": 3.0}
AGAINST_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notice|gdpr|popup|modal|overlay|comments?|disqus|replies|sidebar|side|menu|nav\w*"
    r"|breadcrumbs?|footer|foot|header|masthead|topbar|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|widget|toolbar|pagination|pager|tags|copyright)(?:$|[\s_-])",
    re.I,
)
FOR_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main|text|body)(?:$|[\s_-])", re.I)
NAME_COST = 6.0
#: Smoothness between neighbours, lessened by their distance in the tree.
SMOOTH, FAR = 0.9, 0.6
SCALE = 1000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


class Block:
    """Text between two block boundaries, and where it hangs in the tree."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple, text: str, linked: int) -> None:
        self.path, self.text, self.linked = path, text, linked


def blocks_of(page: str) -> list[Block]:
    """The page's blocks, in order. Elements are (number, tag, names); broken markup is read
    as browsers do where that is simple: ends without a start are ignored, a start of a block
    ends an open paragraph, an element without an end runs to its parent's."""
    blocks: list[Block] = []
    stack: list[tuple[int, str, str]] = []
    parts: list[str] = []
    linked = count = position = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(tuple(x for x in stack if x[1] not in INLINE), text, linked))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw)
            parts.append(text)
            if any(x[1] == "a" for x in stack):
                linked += len(text.strip())

    while position < len(page):
        found = _TOKEN.search(page, position)
        if found is None:
            add(page[position:])
            break
        add(page[position : found.start()])
        position = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        tag, ending = name.lower(), bool(found[1] or found[4])
        if not ending and tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, position)
            position = end.end() if end else len(page)
            continue
        if tag == "br" or tag == "hr":
            parts.append(" ")
            if tag == "hr":
                close()
            continue
        if tag in VOID:
            continue
        if ending:
            if any(x[1] == tag for x in stack):
                if tag not in INLINE:
                    close()
                while stack.pop()[1] != tag:
                    pass
            continue
        if tag not in INLINE:
            close()
            while stack and (stack[-1][1] in INLINE or stack[-1][1] == "p") and any(x[1] == "p" for x in stack):
                stack.pop()
        count += 1
        attributes = found[3] or found[6] or ""
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
        if attributes and _HIDDEN.search(attributes):
            names += " popup"
        stack.append((count, tag, names))
    close()
    return blocks


def content_cost(block: Block, marked: bool) -> float:
    """Log odds that the block is content. ``marked``: the page has an article or main element."""
    odds, inside = 0.0, False
    for _, tag, names in block.path:
        odds += FOR_TAGS.get(tag, 0.0)
        inside = inside or tag in FOR_TAGS
        if tag in AGAINST_TAGS and not (tag == "header" and inside):
            odds -= AGAINST_TAGS[tag]
        if names and tag not in ("html", "body"):
            if AGAINST_NAMES.search(names):
                odds -= NAME_COST
            elif FOR_NAMES.search(names):
                odds += 1.0
    if marked and not inside:
        odds -= 3.0
    size = len(block.text)
    density = block.linked / size
    ends = sum(block.text.count(x) for x in ".!?;:")
    odds += 2.0 * min(1.0, size / 200) + 0.8 * min(2, ends) - 4.0 * (density > 0.5)
    tag = block.path[-1][1] if block.path else ""
    odds += {"p": 1.0, "h1": 1.5, "h2": 1.0, "h3": 1.0, "blockquote": 1.0, "pre": 1.0}.get(tag, 0.0)
    return odds - 1.0


def min_cut(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut (Dinic's algorithm).

    Node i hangs at the source with capacity ``odds[i]`` if that is positive, else at the sink;
    ``edges`` join nodes both ways."""
    n = len(odds)
    source, sink = n, n + 1
    links: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        links[a].append(len(to))
        to.append(b)
        room.append(there)
        links[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, value in enumerate(odds):
        if value > 0:
            join(source, i, value, 0)
        elif value < 0:
            join(i, sink, -value, 0)
    for a, b, weight in edges:
        join(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in links[a]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] == 0)
                node = to[path[first] ^ 1]
                del path[first:]
                continue
            while at[node] < len(links[node]):
                e = links[node][at[node]]
                if room[e] > 0 and level[to[e]] == level[node] + 1:
                    break
                at[node] += 1
            else:
                if node == source:
                    break
                node = to[path.pop() ^ 1]
                at[node] += 1
                continue
            path.append(e)
            node = to[e]


def tree_distance(one: tuple, two: tuple) -> int:
    same = 0
    for a, b in zip(one, two):
        if a[0] != b[0]:
            break
        same += 1
    return len(one) + len(two) - 2 * same


def main_text(page: str | None) -> str:
    """The page's content blocks, in order, joined by one space."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    marked = any(x[1] in FOR_TAGS for b in blocks for x in b.path)
    odds = [round(SCALE * content_cost(b, marked)) for b in blocks]
    edges = []
    last_of: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            gap = tree_distance(blocks[i - 1].path, block.path)
            edges.append((i - 1, i, round(SCALE * SMOOTH * FAR**gap)))
        parent = block.path[-2][0] if len(block.path) > 1 else 0
        if parent in last_of and last_of[parent] < i - 1:  # nearest block of the same parent
            edges.append((last_of[parent], i, round(SCALE * SMOOTH * FAR**2)))
        last_of[parent] = i
    if all(x > 0 for x in odds):
        chosen = [True] * len(odds)
    else:
        chosen = min_cut(odds, [e for e in edges if e[2] > 0])
    return " ".join(b.text for b, keep in zip(blocks, chosen) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks are text between boundaries of block elements. A fixed linear classifier over tags,
    class names, link density, length and punctuation gives each block's log odds, which become
    capacities to the terminals; neighbours in the page and in the tree are joined by smoothness
    edges; the minimum cut parts content from the rest. A null or empty page has an empty text;
    a page of any length is read whole; repeated rows and null ids keep a row each; further
    columns play no part; an empty table gives an empty result.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
