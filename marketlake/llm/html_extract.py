"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes blocks of text in page order. A logistic classifier gives each block the cost of
either label: these are the capacities from the content terminal and to the boilerplate terminal.
Neighbouring blocks, and blocks next to each other under one parent or grandparent, are joined by
smoothness edges, the cost of labelling them differently. The minimum cut is the labelling of least
total cost. A block whose own cost outweighs all its edges has that label in every minimum cut, so
it is folded into its terminal first; only the rest goes through max-flow, page by page.

The classifier is trained here, on the blocks of at most about ``sample_pages`` pages chosen by a
hash of page_id (at most 64 evenly spaced blocks of each; these bounded rows reach the driver). It
learns from pages that mark their article or main part, once with and once without sight of the
containers, so that it also judges pages without such marks. Containers that mean boilerplate by
the standard (navigation, footers, forms, asides), and class and id words for adverts, notices and
reader comments, add fixed costs. Inside an article, words that its own sections may have too
("discussion", "related", "notice") add a small cost only, which the cut can outweigh. Extraction is
one narrow stage, and parsing takes time in proportion to the page, whatever is left open in it.

Text is taken from the whole page: scripts, styles, comments and other raw elements are left out,
character references decoded, white space inside a block made one space. A line break element
is white space inside its block.

Defined results: a null or empty page has an empty text; a page without text too; rows that repeat
count each; nulls in other columns stay; an empty table gives no rows and needs no training.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 2000
SAMPLE_BLOCKS = 64

#: Smoothness of neighbours in page order, of one parent, of one grandparent.
ADJACENT, SIBLING, COUSIN = 0.5, 1.0, 0.3

NAME = r"[a-zA-Z][^\s/>]*"
TOKEN = re.compile(
    rf"<!--|<(/?)({NAME})((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)({NAME})([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
COMMENT = "<!--"
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HINTED = ("class", "id", "role", "style", "hidden", "aria-hidden", "aria-label", "itemprop")

#: Elements of the standard, by what they do to text.
RAW = frozenset("script style textarea title iframe template noembed noframes xmp datalist audio video head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - frozenset("caption tbody td tfoot th thead tr li dd dt option optgroup html body".split())
CLOSES_SAME = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
}
PARAGRAPH, PARAGRAPH_SCOPE = frozenset(["p"]), frozenset(["button", "td", "th", "table", "caption"])
LIST_SCOPE = frozenset("ul ol dl table select menu".split())

CONTENT_TAGS = frozenset(["article", "main"])
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog button fieldset search".split())
CONTENT_HINT = re.compile(r"\b(?:article|main|content|post|entry|story|body-?text)\b|articlebody", re.I)
OUTSIDE_WORD = (
    r"(?:ads?|adverts?|advertisements?|banner|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|gdpr|"
    r"notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|"
    r"related|recommend(?:ed|ations?)?|side-?bar|widgets?|menus?|nav(?:bar|igation)?|breadcrumbs?|"
    r"pagination|pager|foot(?:er)?|masthead|topbar|toolbar|comments?|comment-?list|respon(?:d|ses)|replies|reply|"
    r"disqus|discussion|copyright|disclaimer|hidden|sr-only|complementary|contentinfo|search)\d*"
)
#: What sections of an article may be called as well.
AMBIGUOUS_WORD = (
    r"(?:banner|notices?|alert|related|recommend(?:ed|ations?)?|share|sharing|social|search|"
    r"respon(?:d|ses)|replies|reply|discussion|copyright|disclaimer|foot(?:er)?)\d*"
)
AMBIGUOUS_HINT = re.compile(rf"(?:^|\s){AMBIGUOUS_WORD}(?=\s|$)", re.I)
#: Names made of such words and numbers only: "has-sidebar" and "no-comments" say something else.
OUTSIDE_HINT = re.compile(rf"(?:^|\s){OUTSIDE_WORD}(?:[_-](?:{OUTSIDE_WORD}|\d+))*(?=\s|$)", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    inside: frozenset[str]
    hint: float
    parent: int
    grandparent: int


@dataclass(eq=False)
class _Element:
    """An open element; ``block`` is the nearest block from it up, ``above`` the next one."""

    name: str
    number: int
    inside: frozenset[str]
    hint: float
    depth: int = 0
    block: _Element | None = None
    above: _Element | None = None


#: The hint of a container in an article that has an ambiguous name.
UNSURE = -0.25


def _hint(name: str, attributes: str, in_article: bool = False) -> float:
    """1 for a container of content, -1 for one of boilerplate, by what its attributes say."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return 0
    found = {}
    for key, value in ATTRIBUTE.findall(attributes):
        if key.lower() in HINTED:
            found.setdefault(key.lower(), value.strip("\"'"))
    if not found:
        return 0
    if "hidden" in found or found.get("aria-hidden") == "true" or HIDDEN.search(found.get("style", "")):
        return -1
    words = " ".join(re.sub(r"([a-z])([A-Z])", r"\1-\2", found.get(k, "")) for k in ("class", "id", "role", "aria-label"))
    if name in ("html", "body", "article", "main"):
        return 1 if CONTENT_HINT.search(words) else 0
    if in_article and (unsure := AMBIGUOUS_HINT.search(words)):
        rest = words[: unsure.start()] + " " + words[unsure.end() :]
        return -1 if OUTSIDE_HINT.search(rest) else UNSURE
    if OUTSIDE_HINT.search(words):
        return -1
    return 1 if CONTENT_HINT.search(words + " " + found.get("itemprop", "")) else 0


class _Stack:
    """The open elements, with the depths of each name."""

    def __init__(self) -> None:
        self.root = _Element("", 0, frozenset(), 0)
        self.root.block = self.root.above = self.root
        self.elements = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.made = 0

    @property
    def top(self) -> _Element:
        return self.elements[-1]

    def push(self, name: str, inside: frozenset[str], hint: float) -> None:
        self.made += 1
        top, own = self.top, _Element(name, self.made, inside, hint, len(self.elements))
        own.block = own if name in BLOCK else top.block
        own.above = top.block if name in BLOCK else top.above
        self.depths.setdefault(name, []).append(own.depth)
        self.elements.append(own)

    def pop_to(self, depth: int) -> int:
        """Close all elements from a depth on; returns how many of them were links."""
        links = 0
        while len(self.elements) > depth:
            name = self.elements.pop().name
            self.depths[name].pop()
            links += name == "a"
        return links

    def deepest(self, names: frozenset[str]) -> int:
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def nearest(self, names: frozenset[str], scope: frozenset[str]) -> int:
        """Depth of the innermost element of these names with none of ``scope`` inside it, or 0."""
        depth = self.deepest(names)
        barrier = (self.top.block.depth if scope is BLOCK else self.deepest(scope)) if depth else 0
        return depth if depth > barrier else 0


def blocks_of(page: str) -> list[Block]:
    """The blocks of text of a page, in page order."""
    blocks: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                # What matters is where a paragraph stands, not that each is an element of its own.
                top = stack.top
                own, above = top.block, top.block.above
                blocks.append(
                    Block(text, linked, own.name, top.inside, top.hint, above.number, above.above.number)
                )
            parts.clear()
        linked = 0

    at, size = 0, len(page)
    # No tag ends after the last bracket, and an element without an end tag has none further on.
    last_end = page.rfind(">")
    endless: set[str] = set()
    lowered = None
    while at < size:
        match = TOKEN.search(page, at, last_end + 1) if at <= last_end else None
        upto = match.start() if match else page.find(COMMENT, at)
        upto = size if upto < 0 else upto
        if upto > at:
            text = page[at:upto]
            parts.append(text)
            if in_link:
                linked += len(text.strip())
        if not match:
            break
        at = match.end()
        if match.group() == COMMENT:
            end = page.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        closing, name, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            if name not in BLOCK and name != "a":
                if depth := stack.nearest(frozenset([name]), BLOCK):
                    in_link -= stack.pop_to(depth)
                continue
            if name in BLOCK:
                flush()
            if depth := stack.deepest(frozenset([name])):
                in_link -= stack.pop_to(depth)
            continue
        if name in RAW:
            if name == "head":
                continue
            lowered = page.lower() if lowered is None else lowered
            end = -1 if name in endless else lowered.find(f"</{name}", at)
            if end < 0:
                endless.add(name)
                end = size if name in ("script", "style", "textarea", "title", "xmp") else at
            if name == "xmp":
                flush()
                parts.append(page[at:end].replace("&", "&amp;"))
                flush()
            at = end
            continue
        if name == "br" or name == "wbr":
            if name == "br":
                parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name in CLOSES_P:
                if depth := stack.nearest(PARAGRAPH, PARAGRAPH_SCOPE):
                    in_link -= stack.pop_to(depth)
            if name in CLOSES_SAME:
                while depth := stack.nearest(CLOSES_SAME[name], LIST_SCOPE):
                    in_link -= stack.pop_to(depth)
        if name in VOID or name in ("svg", "math") and attributes.rstrip().endswith("/"):
            continue
        if name == "a":
            if depth := stack.nearest(frozenset(["a"]), BLOCK):
                in_link -= stack.pop_to(depth)
            in_link += 1
        above = stack.top
        inside = above.inside
        in_article = not inside.isdisjoint(CONTENT_TAGS)
        if name in CONTENT_TAGS or name in OUTSIDE_TAGS or name in ("header", "li", "table", "blockquote", "pre"):
            inside = inside | {name}
        hint = _hint(name, attributes, in_article)
        # The outermost article or main part is judged by the cut, whatever its wrappers are called.
        inherited = 0 if name in CONTENT_TAGS and not in_article else above.hint
        hint = min(hint, inherited) if min(hint, inherited) < 0 else max(hint, inherited)
        stack.push(name, inside, hint)
    flush()
    return blocks


# --- costs ----------------------------------------------------------------------------

FEATURES = 17


def block_features(blocks: list[Block], containers: bool = True) -> np.ndarray:
    out = np.zeros((len(blocks), FEATURES))
    for k, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        size = len(b.text)
        out[k, :11] = (
            1.0,
            min(np.log1p(words), 5.0),
            min(b.linked / size, 1.0),
            words < 6,
            words > 25,
            min(sum(b.text.count(c) for c in ".,;:") / words, 1.0),
            b.text[-1] in ".!?:\"»”",
            min(b.text.count("|") / words, 1.0),
            b.tag == "p",
            b.tag in HEADINGS,
            b.tag in ("li", "td", "th"),
        )
        if containers:
            inside = b.inside
            out[k, 11:] = (
                not inside.isdisjoint(CONTENT_TAGS),
                "nav" in inside or "menu" in inside,
                "footer" in inside,
                "header" in inside and inside.isdisjoint(CONTENT_TAGS),
                "aside" in inside or "form" in inside,
                b.hint,
            )
    return out


#: Where nothing is known of containers: long text with few links is content.
DEFAULT_WEIGHTS = np.array([-1.5, 0.8, -3.0, -0.5, 1.0, 0.5, 0.7, -0.3, 1.0, 0.5, -0.7, 3.0, -3, -3, -2, -3, 2.0])


UNSURE_COST = 2.0


def fixed_costs(blocks: list[Block]) -> np.ndarray:
    """What the standard's containers and attribute words add to the cost of content."""
    out = np.zeros(len(blocks))
    for k, b in enumerate(blocks):
        if b.hint < 0:
            out[k] -= 12.0 if b.hint <= -1 else UNSURE_COST
        if not b.inside.isdisjoint(OUTSIDE_TAGS):
            out[k] -= 12.0
        if "header" in b.inside and b.inside.isdisjoint(CONTENT_TAGS):
            out[k] -= 8.0
    return out


def weak_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels of a page that marks its main part: inside it or not."""
    inside = np.array([not b.inside.isdisjoint(CONTENT_TAGS) for b in blocks])
    if not inside.any():
        return None
    outside = np.array([not b.inside.isdisjoint(OUTSIDE_TAGS) or b.hint <= -1 for b in blocks])
    return (inside & ~outside).astype(float)


def train(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic classifier by Newton's method, pulled to the default weights."""
    w = DEFAULT_WEIGHTS.copy()
    if not len(y):
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * (w - DEFAULT_WEIGHTS)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


# --- minimum cut ----------------------------------------------------------------------

SCALE = 10_000


def edges_of(blocks: list[Block]) -> dict[tuple[int, int], int]:
    edges: dict[tuple[int, int], int] = {}
    last: dict[tuple[str, int], int] = {}
    for k, b in enumerate(blocks):
        near = [(k - 1, ADJACENT)] if k else []
        for kind, number, weight in (("p", b.parent, SIBLING), ("g", b.grandparent, COUSIN)):
            if (kind, number) in last:
                near.append((last[kind, number], weight))
            last[kind, number] = k
        for j, weight in near:
            edges[j, k] = edges.get((j, k), 0) + int(weight * SCALE)
    return edges


def minimum_cut(gain: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut.

    ``gain`` is a node's capacity from the content terminal, or to the other one if negative.
    Nodes left on neither side by the flow are boilerplate.
    """
    n = len(gain)
    gain = list(gain)
    links: list[dict[int, int]] = [{} for _ in range(n)]
    for (a, b), weight in edges.items():
        links[a][b] = links[a].get(b, 0) + weight
        links[b][a] = links[b].get(a, 0) + weight
    weight_of = [sum(x.values()) for x in links]
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        k = queue.popleft()
        if label[k] is not None or abs(gain[k]) <= weight_of[k]:
            continue
        label[k] = gain[k] > 0
        for j, weight in links[k].items():
            if label[j] is None:
                # The edge now leads to a terminal.
                gain[j] += weight if label[k] else -weight
                weight_of[j] -= weight
                queue.append(j)
    rest = [k for k in range(n) if label[k] is None]
    if rest:
        place = {k: i for i, k in enumerate(rest)}
        inner = [
            {place[j]: w for j, w in links[k].items() if label[j] is None} for k in rest
        ]
        for k, side in zip(rest, _max_flow([gain[k] for k in rest], inner), strict=True):
            label[k] = side
    return [bool(x) for x in label]


def _max_flow(gain: list[int], links: list[dict[int, int]]) -> list[bool]:
    """Nodes that the source still reaches after Dinic's algorithm."""
    n = len(gain)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def connect(a: int, b: int, there: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, value in enumerate(gain):
        if value > 0:
            connect(source, k, value, 0)
        elif value < 0:
            connect(k, sink, -value, 0)
        for j, weight in links[k].items():
            if j > k:
                connect(k, j, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            k = queue.popleft()
            for e in head[k]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[k] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        k = source
        while True:
            if k == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path.clear()
                k = source
                continue
            while tried[k] < len(head[k]):
                e = head[k][tried[k]]
                if room[e] and level[to[e]] == level[k] + 1:
                    break
                tried[k] += 1
            if tried[k] < len(head[k]):
                path.append(head[k][tried[k]])
                k = to[path[-1]]
            elif path:
                e = path.pop()
                k = to[e ^ 1]
                tried[k] += 1
            else:
                break


def label_blocks(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    gain = block_features(blocks) @ weights + fixed_costs(blocks)
    gain = np.clip(gain, -40, 40) * SCALE
    return minimum_cut([int(g) for g in gain], edges_of(blocks))


def main_text(page: str | None, weights: np.ndarray = DEFAULT_WEIGHTS) -> str:
    """The blocks on the content side, one a line."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n".join(
        b.text for b, keep in zip(blocks, label_blocks(blocks, weights), strict=True) if keep
    )


# --- Spark ----------------------------------------------------------------------------


def learn_weights(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """The classifier's weights from a bounded sample of pages."""
    share = min(1.0, sample_pages / max(1, pages.count()))
    sample = pages.where(
        F.pmod(F.xxhash64(F.col("page_id").cast("long"), F.lit("sample")), F.lit(1_000_000))
        < F.lit(int(share * 1_000_000))
    ).select(F.col("html").cast("string").alias("html"))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for page in frame["html"]:
                blocks = blocks_of(page or "")
                labels = weak_labels(blocks) if blocks else None
                if labels is None:
                    continue
                chosen = np.unique(np.linspace(0, len(blocks) - 1, SAMPLE_BLOCKS).astype(int))
                picked = [blocks[k] for k in chosen]
                x = np.vstack([block_features(picked), block_features(picked, False)])
                y = np.tile(labels[chosen], 2)
                yield pd.DataFrame({"x": list(x), "y": y})

    rows = sample.mapInPandas(measure, "x array<double>, y double").toPandas()
    if not len(rows):
        return DEFAULT_WEIGHTS
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy()
    # Rows arrive in any order; the same sum comes of any of them once they are sorted.
    order = np.lexsort((*x.T, y))
    return train(x[order], y[order])


def extract(pages: DataFrame, *, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    weights = learn_weights(pages, sample_pages)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(p, weights) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array(list(map(len, texts)), pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return source.mapInArrow(scan, "page_id long, url string, text string, n_chars long")
