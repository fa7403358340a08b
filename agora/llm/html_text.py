"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks at block elements. A logistic classifier over a block's text (length, link share, sentence
marks, kind of element) and the cues of the elements around it gives each block a cost for being content and one for
being boilerplate; they are its capacities to the two terminals. Neighbouring blocks, and blocks with the same parent,
are joined by smoothness edges whose capacity grows with their nearness in the document tree. The minimum cut of this
graph labels the blocks. As elements nest, no two edges cross; so the cut, whose value is that of the maximum flow, is
found in time linear in the number of blocks, by taking out one inner block after the other.

All capacities are finite. ``main`` ends every cue of the elements around it but a hidden one's; ``article`` ends those
of names and forms. A class or id counts by whole words of its list. A form or a fieldset is boilerplate if it has a
control for every ``FORM_CHARS`` characters. A name that would take ``HOLDS`` of a page's sentences is not believed,
unless an element names the content or the name is of comments or of consent.

The classifier is fitted to a bounded sample of different pages (``SAMPLE`` at most, in the mean), where blocks inside
elements that name their role are labelled by it. Every page is labelled whole; null and empty pages have the empty
text. Repeated rows are scored each by itself, ids may be null or shared, and other columns play no part.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.text import fitted

SAMPLE = 600
CUE = 6.0  # logit of a named role; elements that are boilerplate by kind have twice as much
FORM_CHARS = 200
HOLDS = 0.7
ADJACENT = 1.5  # smoothness between neighbours with one parent
DISTANT = 0.2  # and between neighbours in different parts of the tree
SIBLING = 1.0  # between blocks of one parent with others between them
_SCALE = 1000  # capacities are whole numbers

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SENTENCE = re.compile(r"[.!?。！？]")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Elements whose content is no text of the page.
_SILENT = frozenset(
    "script style title template noscript iframe svg math canvas object audio video select textarea button datalist".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_ITEM = frozenset("li dd dt td th".split())
_CLOSED_BY_BLOCK = frozenset(["p"])
_FORMS = frozenset("form fieldset".split())
_CONTROLS = frozenset("input select textarea button".split())
#: Elements and roles that name boilerplate, and names of classes and ids that do so.
_AWAY_TAGS = frozenset("nav aside footer menu dialog".split())
_AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
_AWAY_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter "
    "subscribe subscription share sharing social related recommended recommendation recommendations comment comments "
    "commentlist reply replies disqus respond login signup register search pagination pager toolbar widget copyright "
    "legal disclaimer skip".split()
)
_NEVER_CONTENT = frozenset("comment comments commentlist reply replies disqus respond cookie cookies consent gdpr".split())
_HOME_TAGS = frozenset("article main".split())
_HOME_NAMES = frozenset("article content post entry story main text body maincontent articlebody".split())
#: Words that may stand beside those in a class or id: "site-footer", "comment-list".
_BESIDE = frozenset(
    "site page main global top bottom left right primary secondary inner outer post article entry content user reader "
    "header list box bar area section container wrapper wrap block form links link item items text unit slot".split()
)


@dataclass
class Block:
    text: str
    link_chars: int
    tag: str
    group: int  # the element that it and its siblings stand in
    depth: int  # block elements around it, its own among them
    shared: int  # and how many of them the block before stands in
    home: bool  # in an element that names content
    away: int  # 0, or the outermost element that is boilerplate by its kind
    named: int  # or by its name
    form: int  # the innermost form
    cue: int = 0  # 1 in an element that names content, -1 by name and -2 by kind in one that names boilerplate


@dataclass
class _Element:
    tag: str
    number: int
    home: bool = False
    away: int = 0
    named: int = 0
    form: int = 0
    hidden: bool = False


def _attributes(raw: str) -> dict[str, str]:
    if not raw.strip("/ \t\r\n\f"):
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _named(attributes: dict[str, str]) -> tuple[set[str], set[str]]:
    """Names of boilerplate and of content among the classes and the id, where every word of one is known."""
    away: set[str] = set()
    home: set[str] = set()
    for one in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = set(_NAME.findall(_CAMEL.sub(" ", one).lower()))
        if words & _AWAY_NAMES and words <= _AWAY_NAMES | _BESIDE:
            away |= words & _AWAY_NAMES
        elif words & _HOME_NAMES and words <= _HOME_NAMES | _BESIDE:
            home |= words & _HOME_NAMES
    return away, home


def _opened(tag: str, raw: str, above: _Element, number: int, never: set[int]) -> _Element:
    """The element with its cues. The numbers of those that name comments or consent join ``never``."""
    attributes = _attributes(raw)
    away_names, home_names = _named(attributes) if tag not in ("html", "body") else (set(), set())
    role = attributes.get("role", "").lower()
    one = _Element(tag, number, above.home, above.away, above.named, above.form, above.hidden)
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    if hidden or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        one.hidden = True
    if tag == "main" or role == "main":
        one.home, one.away, one.named, one.form = True, 0, 0, 0
        away_names = set()
    elif tag == "article" or role == "article":
        # An article in another one may be a comment on it, so it ends nothing.
        if not above.home:
            one.named, one.form = 0, 0
        one.home = True
        if home_names:
            away_names = set()
    elif home_names:
        one.home = True
    if tag in _FORMS or role == "form":
        one.form = number
    header = tag == "header" and not above.home
    if not one.away and (tag in _AWAY_TAGS or role in _AWAY_ROLES or one.hidden or header):
        one.away = number
    if away_names and not one.named:
        one.named = number
        if away_names & _NEVER_CONTENT:
            never.add(number)
    return one


def blocks(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed elements end with what contains them."""
    out: list[Block] = []
    stack = [_Element("", 0)]
    holders = [stack[0]]  # the block elements of the stack
    inside: Counter[str] = Counter()  # open elements by tag
    never: set[int] = set()
    controls: Counter[int] = Counter()  # by form
    held_by: list[tuple[int, int]] = []  # (holder, its parent) of each block
    number, at, n = 0, 0, len(page)
    parts: list[str] = []
    link_chars, lowest = 0, 1

    def flush() -> None:
        nonlocal link_chars, lowest
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            holder, top = holders[-1], stack[-1]
            held_by.append((holder.number, holders[-2].number if len(holders) > 1 else 0))
            links = min(link_chars, len(text))
            out.append(
                Block(text, links, holder.tag, 0, len(holders), lowest, top.home, top.away, top.named, top.form)
            )
            lowest = len(holders)
        link_chars = 0

    def close(index: int) -> None:
        nonlocal lowest
        while len(stack) > index:
            element = stack.pop()
            inside[element.tag] -= 1
            if element is holders[-1]:
                holders.pop()
        lowest = min(lowest, len(holders))

    while at < n:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            parts.append(text)
            if inside["a"]:
                link_chars += len(text)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in _BLOCK:
                flush()
            if inside[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in _CONTROLS and "hidden" not in found[3].lower():
            controls[stack[-1].form] += 1
        if tag in _SILENT:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            parts.append(" ")
            at = end.end() if end else n
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                parts.append(" " if tag == "br" else "")
            continue
        if tag in _BLOCK:
            flush()
            # A block ends an open paragraph and the inline elements in it; an item ends the item before it.
            top = holders[-1]
            if top.tag in _CLOSED_BY_BLOCK or top.tag == tag and tag in _ITEM:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i] is top))
        if found[3].endswith("/") and tag not in _BLOCK:
            continue
        number += 1
        stack.append(_opened(tag, found[3], stack[-1], number, never))
        inside[tag] += 1
        if tag in _BLOCK:
            holders.append(stack[-1])
    flush()
    # Text of an element that holds blocks too is their sibling; any other block is a sibling in its parent.
    holding = {parent for _, parent in held_by}
    for block, (holder, parent) in zip(out, held_by):
        block.group = holder if holder in holding else parent
    _set_cues(out, controls, never)
    return out


def _prose(block: Block) -> int:
    """Characters of a block that has sentences and is no list of links."""
    return len(block.text) if block.link_chars * 2 < len(block.text) and _SENTENCE.search(block.text) else 0


def _set_cues(found: list[Block], controls: Counter[int], never: set[int]) -> None:
    chars: Counter[int] = Counter()
    prose: Counter[int] = Counter()
    whole = 0
    for block in found:
        chars[block.form] += len(block.text)
        size = _prose(block)
        prose[block.named] += size
        whole += size
    forms = {f for f, size in chars.items() if f and size <= FORM_CHARS * controls[f]}
    homes = any(b.home and not (b.away or b.named or b.form in forms) and _prose(b) for b in found)
    doubted = {e for e, size in prose.items() if e and not homes and e not in never and size > HOLDS * whole}
    for block in found:
        if block.away or block.form in forms:
            block.cue = -2
        elif block.named and block.named not in doubted:
            block.cue = -1
        else:
            block.cue = int(block.home)


def block_features(block: Block) -> list[float]:
    text, size = block.text, len(block.text)
    return [
        1.0,
        math.log1p(size) / 5.0,
        block.link_chars / size,
        min(1.0, 10.0 * sum(text.count(c) for c in ".,;!?") / size),
        float(text[-1] in ".!?\"'”»"),
        float(block.tag in _HEADING),
        float(block.tag in _ITEM),
        float(block.tag == "p"),
    ]


#: Used where no block of the sample names its role.
DEFAULT_WEIGHTS = (-2.0, 2.5, -5.0, 0.5, 1.0, 0.5, -1.0, 1.5)


def fit(pages: list[str]) -> np.ndarray:
    """Logistic weights from the blocks of pages that stand inside elements with a named role."""
    rows, labels = [], []
    for page in pages:
        for block in blocks(page):
            if block.cue:
                rows.append(block_features(block))
                labels.append(block.cue > 0)
    x, y = np.array(rows), np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return np.array(DEFAULT_WEIGHTS)
    cost = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = np.array(DEFAULT_WEIGHTS)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (cost * (p - y)) + 1.0 * (w - DEFAULT_WEIGHTS)
        hess = (x * (cost * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges (i, j, capacity): neighbours in page order, and each block with the last one of the same parent."""
    edges, last = [], {}
    for j, block in enumerate(found):
        if j:
            # 1 for blocks with one parent, less for each level up to their common element.
            up, down = found[j - 1].depth - 1, block.depth - 1
            shared = min(block.shared, up, down)
            near = 1.0 / (1 + (up - shared) + (down - shared))
            edges.append((j - 1, j, int(_SCALE * (DISTANT + (ADJACENT - DISTANT) * near))))
        i = last.get(block.group)
        if i is not None and i < j - 1:
            edges.append((i, j, int(_SCALE * SIBLING)))
        last[block.group] = j
    return edges


def minimum_cut(excess: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source side. ``excess``: capacity from the source if positive, to the sink if negative.

    Of several minimum cuts the one with the fewest nodes on the source side counts: what the source still reaches at
    maximum flow. Edges between nodes of a document nest; others are cut by sending the flow.
    """
    ending: dict[int, list[tuple[int, int]]] = {}
    reach: list[int] = []  # right ends of the edges that are open, the innermost last
    for i, j, capacity in sorted(edges, key=lambda e: (e[0], -e[1])):
        while reach and reach[-1] <= i:
            reach.pop()
        if reach and reach[-1] < j:
            return cut_by_flow(excess, edges)
        reach.append(j)
        ending.setdefault(j, []).append((i, capacity))
    return _nested_cut(excess, ending)


def cut_by_flow(excess: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The same for any edges, by shortest augmenting paths from nodes with excess to nodes that lack it."""
    left = list(excess)
    links: list[list[int]] = [[] for _ in left]
    head, room = [], []
    for i, j, capacity in edges:
        links[i].append(len(head))
        head.append(j)
        room.append(capacity)
        links[j].append(len(head))
        head.append(i)
        room.append(capacity)
    while True:
        came = [-2] * len(left)
        queue = deque(i for i, x in enumerate(left) if x > 0)
        for i in queue:
            came[i] = -1
        sink = -1
        while queue and sink < 0:
            i = queue.popleft()
            for e in links[i]:
                j = head[e]
                if room[e] > 0 and came[j] == -2:
                    came[j] = e
                    if left[j] < 0:
                        sink = j
                        break
                    queue.append(j)
        if sink < 0:
            return [c != -2 for c in came]
        path, at = [], sink
        while came[at] != -1:
            path.append(came[at])
            at = head[came[at] ^ 1]
        amount = min([left[at], -left[sink], *(room[e] for e in path)])
        left[at] -= amount
        left[sink] += amount
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


def _nested_cut(excess: list[int], ending: dict[int, list[tuple[int, int]]]) -> list[bool]:
    """The same for edges i < j, by right end, that don't cross.

    Between two nodes that are still there lies a table: what the cut costs among the nodes taken out between them, for
    each choice of sides of the two. A node that no further edge leaves is taken out with its better side for each
    choice. A unit more for each node on the source side settles ties.
    """
    n = len(excess)
    if not n:
        return []
    unit = n + 1
    stay = [max(0, x) * unit for x in excess]  # the cost of the sink's side
    take = [max(0, -x) * unit + 1 for x in excess]
    nodes: list[int] = []
    tables: list[tuple[int, int, int, int]] = []  # from the node before to this one, by their sides
    taken_out: list[tuple[int, int, int, tuple[bool, ...]]] = []

    def take_out() -> None:
        right = tables.pop()
        left = tables.pop()
        j = nodes.pop()
        m = nodes.pop()
        a = [x + stay[m] for x in (left[0], left[2])]
        b = [x + take[m] for x in (left[1], left[3])]
        pairs = [(a[x] + right[y], b[x] + right[2 + y]) for x in (0, 1) for y in (0, 1)]
        taken_out.append((m, nodes[-1], j, tuple(q < p for p, q in pairs)))
        nodes.append(j)
        tables.append(tuple(min(p) for p in pairs))

    for j in range(n):
        nodes.append(j)
        tables.append((0, 0, 0, 0))
        for i, capacity in sorted(ending.get(j, ()), reverse=True):
            while nodes[-2] > i:
                take_out()
            zero, one, two, three = tables[-1]
            tables[-1] = (zero, one + capacity * unit, two + capacity * unit, three)
    while len(nodes) > 2:
        take_out()
    side = [False] * n
    if n == 1:
        return [take[0] < stay[0]]
    ends = [stay[0], take[0]], [stay[-1], take[-1]]
    _, side[0], side[-1] = min((ends[0][x] + tables[-1][2 * x + y] + ends[1][y], bool(x), bool(y)) for x in (0, 1) for y in (0, 1))
    for m, i, j, better in reversed(taken_out):
        side[m] = better[2 * side[i] + side[j]]
    return side


def labels(found: list[Block], weights: np.ndarray) -> list[bool]:
    """Whether each block is content."""
    if not found:
        return []
    logits = np.array([block_features(b) for b in found]) @ weights
    excess = [int(_SCALE * (max(-4.0, min(4.0, x)) + CUE * b.cue)) for x, b in zip(logits.tolist(), found)]
    return minimum_cut(excess, smoothness(found))


def main_text(page: str | None, weights: np.ndarray) -> str:
    found = blocks(page or "")
    return "\n\n".join(b.text for b, good in zip(found, labels(found, weights)) if good)


def learn(pages: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from the different pages whose hash of id and text is below the rate that gives ``sample`` in the mean."""
    key = F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("pages"), F.col("html"))
    whole = pages.where("html is not null").select(key.alias("key"), "html")
    n = whole.agg(F.approx_count_distinct("key")).first()[0]
    picked = whole.where(F.pmod("key", F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, n))))
    # Copies of a row, however many, are one row of the sample.
    return fitted(picked.groupBy("key").agg(F.first("html").alias("html")), lambda rows: fit([page for _, page in rows]))


def extract(pages: DataFrame, weights: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``pages`` (all, or ``keep``) as struct ``row``, and ``text``."""
    keep = pages.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), weights) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["row", "text"])

    packed = pages.select(F.struct(*[pages[c] for c in keep]).alias("row"), pages["html"].alias("html"))
    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, text string")


def page_texts(pages: DataFrame) -> DataFrame:
    """The result of the query."""
    found = extract(pages, learn(pages), keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
