"""Operator 4: main text of web pages. Blocks are told apart by a minimum cut over classifier costs and the page's shape."""

from __future__ import annotations

import html
import itertools
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

TAG = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style|template|noscript|svg|iframe|textarea|select|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[a-z/!?][^>]*(?:>|$)",
    re.I | re.S,
)
NAMED = re.compile(r"\b(?:class|id|role|aria-label|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that end an open element of these names.
ENDS = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

#: The classifier: log-odds of content, added up from the elements around a block and from the block itself, within bounds.
CONTAINER = {"article": 3.0, "main": 2.5, "nav": -5.0, "footer": -5.0, "aside": -4.5, "header": -4.0, "form": -4.5, "menu": -5.0, "dialog": -4.5, "button": -5.0, "head": -8.0, "figure": -0.5} | dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6"), 1.0)
LEAST_PRIOR, MOST_PRIOR = -8.0, 4.0
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|signup|login|"
    r"nav\w*|menu\w*|breadcrumbs?|pagination|pager|toolbar|sidebar\w*|side|widget\w*|footer\w*|header|masthead|copyright|legal|related|recommend\w*|trending|popular|"
    r"share|sharing|social|tags?|comments?|commentlist|respond|replies|reply|discussion|disqus|reviews?|search|hidden|sr-only|skip)(?:$|[\s_-])|display:\s*none",
    re.I,
)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|entry|story|post|body|text|main)(?:$|[\s_-])", re.I)
#: Of these, names of page furniture wherever it stands.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|signup|login|nav\w*|menu\w*|breadcrumbs?|pagination|pager|"
    r"toolbar|sidebar\w*|widget\w*|footer\w*|related|recommend\w*|trending|share|sharing|social|comments?|commentlist|respond|replies|reply|disqus|hidden|sr-only|skip)(?:$|[\s_-])|display:\s*none",
    re.I,
)
BAD, DOUBTFUL, GOOD, VETO = -5.0, -1.5, 1.0, -4.0
BIAS, PER_LENGTH, PER_LINK, SENTENCE = -2.0, 1.1, -4.0, 0.8
#: Smoothness between neighbouring blocks, and what nearness in the tree adds.
ADJACENT, NEAR = 0.5, 2.0


@dataclass(slots=True)
class Node:
    """An element that is not inline, by its parent: a path of any depth costs a pointer."""

    parent: Node | None
    depth: int


@dataclass
class Block:
    text: str
    score: float
    node: Node


@dataclass(slots=True)
class _Open:
    name: str
    prior: float
    node: Node
    inside: bool  # of an article or main


def _named(attrs: str, inside: bool) -> float:
    names = " ".join(next((x for x in m.groups() if x), m[0]) for m in NAMED.finditer(attrs)) if "=" in attrs or "hidden" in attrs.lower() else ""
    if not names:
        return 0.0
    if BAD_NAME.search(names):
        # within an article, names that may be its subject say less than names of page furniture
        return DOUBTFUL if inside and not FURNITURE.search(names) else BAD
    return GOOD if GOOD_NAME.search(names) else 0.0


def _score(text: str, linked: int, prior: float) -> float:
    share = min(1.0, linked / len(text))
    return prior + _length(len(text)) + PER_LINK * share + (SENTENCE if text[-1] in ".!?…:;\"'" else 0.0)


def _length(n: int) -> float:
    return PER_LENGTH * min(4.0, math.log2(1 + n / 20))


def blocks(page: str) -> list[Block]:
    """The page's blocks of text: what stands between tags that are not inline, references decoded, white space made single."""
    out: list[Block] = []
    stack = [_Open("", 0.0, Node(None, 0), False)]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked, at, longest = 0, 0, 0

    def flush() -> None:
        nonlocal linked, longest
        text = " ".join("".join(parts).split())
        if text:
            # inline elements carry the prior and node of the block that they stand in
            out.append(Block(text, _score(text, linked, stack[-1].prior), stack[-1].node))
            if stack[-1].prior >= 0 and 2 * linked < len(text):
                longest = max(longest, len(text))
        parts.clear()
        linked = 0

    def pop(n: int) -> None:
        opened.subtract(x.name for x in stack[n:])
        del stack[n:]

    def take(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if opened["a"]:
                linked += len(text.strip())

    for m in TAG.finditer(page):
        take(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        inline = name in INLINE
        if not inline:
            flush()
        if m["end"]:
            if opened[name] > 0:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        pop(k)
                        break
            continue
        if not inline:
            ended = ENDS.get(name) or (("p",) if name in CLOSES_P else ())
            if any(opened[x] > 0 for x in ended):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in ended:
                        pop(k)
                        break
                    if stack[k].name in CONTAINER or stack[k].name in ("ul", "ol", "table", "div", "section"):
                        break
        if name in VOID or m["attrs"].endswith("/"):
            continue
        up = stack[-1]
        opened[name] += 1
        if inline:
            stack.append(_Open(name, up.prior, up.node, up.inside))
        else:
            own = CONTAINER.get(name, 0.0)
            if name == "header" and up.inside:
                own = 0.0  # the article's own heading
            attrs = m["attrs"]
            if attrs and not (own > 0 and up.prior >= 0 and name in ("article", "main")):
                own += _named(attrs, up.inside)
            # page furniture within an article has nothing of the article's credit
            prior = max(LEAST_PRIOR, min(MOST_PRIOR, own + (min(0.0, up.prior) if own <= VETO else up.prior)))
            stack.append(_Open(name, prior, Node(up.node, up.node.depth + 1), up.inside or name in ("article", "main")))
    take(page[at:])
    flush()
    # a block is short only against the page's longest one that is neither furniture nor links
    bias = max(BIAS, -_length(longest) / 2) if longest else BIAS
    for b in out:
        b.score += bias
    return out


def apart(a: Node, b: Node, most: int = 64) -> int:
    """Steps from a to b through the tree, as far as `most`, beyond which nearness does not count."""
    steps = 0
    while a is not b and steps < most:
        if a.depth >= b.depth:
            a, steps = a.parent, steps + 1
        else:
            b, steps = b.parent, steps + 1
    return steps


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: between neighbours in page order, stronger the nearer in the tree; and to the last block of the same parent."""
    near = lambda a, b: NEAR / (1 + apart(a, b))
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            out.append((i - 1, i, ADJACENT + near(found[i - 1].node, b.node)))
        parent = id(b.node.parent)
        j = last.get(parent)
        if j is not None and j != i - 1:
            out.append((j, i, near(found[j].node, b.node)))
        last[parent] = i
    return out


def minimum_cut(score: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut: positive scores are capacities from the source, negative ones to the sink.

    A node whose own capacity exceeds all its smoothness is decided at once, and hands its links to its neighbours as
    capacities. One with at most two neighbours is taken out: the least cost that it leaves to them is again a capacity of each
    and a link between them, and its own side follows from theirs. Chains, ladders and whatever else these two steps use up take
    time in proportion; the maximum flow through the rest decides it. Of several minimum cuts it is the one with the fewest on the source's side.
    """
    n = len(score)
    own, near = list(score), [{} for _ in range(n)]
    for i, j, w in links:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    gone: list[tuple[int, dict[int, float]]] = []
    out, queue = [False] * n, deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or out[i]:
            continue
        around = near[i]
        if not around or abs(own[i]) > sum(around.values()):
            label[i] = own[i] > 0
            for j, w in around.items():
                del near[j][i]
                own[j] += w if label[i] else -w
        elif len(around) <= 2:
            out[i] = True
            gone.append((i, around))
            _take_out(i, own, near)
        else:
            continue
        queue.extend(around)
        near[i] = {}
    left = [i for i in range(n) if label[i] is None and not out[i]]
    if left:
        kept = _source_side(left, own, near)
        for i in left:
            label[i] = i in kept
    for i, around in reversed(gone):
        label[i] = own[i] + sum(w if label[j] else -w for j, w in around.items()) > 0
    return [bool(x) for x in label]


def _take_out(i: int, own: list[float], near: list[dict[int, float]]) -> None:
    """Hands the least cost of node i, as a function of its one or two neighbours' sides, to them."""
    u = own[i]
    if len(near[i]) == 1:
        ((j, a),) = near[i].items()
        del near[j][i]
        own[j] += max(-a, min(a, u))
        return
    (j, a), (k, b) = near[i].items()
    del near[j][i], near[k][i]
    neither, both, one, other = min(0.0, a + b - u), min(a + b, -u), min(a, b - u), min(b, a - u)
    link = max(0.0, (one + other - neither - both) / 2)
    own[j] -= one - neither - link
    own[k] -= other - neither - link
    if link > 0:
        near[j][k] = near[j].get(k, 0.0) + link
        near[k][j] = near[k].get(j, 0.0) + link


def _source_side(left: list[int], own: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow, found by blocking flows through levels of equal distance."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in left} | {source: {}, sink: {}}
    for i in left:
        a, b = (source, i) if own[i] > 0 else (i, sink)
        room[a][b] = abs(own[i])
        room[b].setdefault(a, 0.0)
    while True:
        level, line = {source: 0}, deque([source])
        while line:
            i = line.popleft()
            for j, c in room[i].items():
                if c > 1e-9 and j not in level:
                    level[j] = level[i] + 1
                    line.append(j)
        if sink not in level:
            return set(level)
        ahead, at = {i: [j for j in room[i] if level.get(j) == level[i] + 1] for i in level}, dict.fromkeys(level, 0)
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                steps = list(itertools.pairwise(path))
                flow = min(room[a][b] for a, b in steps)
                for a, b in steps:
                    room[a][b] -= flow
                    room[b][a] += flow
                # back to before the first edge that is full
                del path[next(k for k, (a, b) in enumerate(steps) if room[a][b] <= 1e-9) + 1 :]
                continue
            while at[i] < len(ahead[i]) and room[i][ahead[i][at[i]]] <= 1e-9:
                at[i] += 1
            if at[i] < len(ahead[i]):
                path.append(ahead[i][at[i]])
            else:
                path.pop()
                if path:
                    at[path[-1]] += 1


def main_text(page: str | None) -> str:
    """The page's content blocks in page order, one a line. A null or empty page, and one without content, has an empty text."""
    if not page:
        return ""
    found = blocks(page)
    keep = minimum_cut([b.score for b in found], edges(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of (page_id, url, html, ...). Repeated rows and null ids stay; nothing is shuffled.

    Null and empty pages have an empty text, an empty table gives an empty result, and other columns are not read, whatever
    their names. Pages of any length and depth take memory in proportion, and time too where the cut needs no flow (see
    minimum_cut); a text is never cut.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
