"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text. A classifier over a block's place in the DOM, its links and its
prose gives the cost of either label as a terminal capacity; neighbours in page order, and in the
DOM, are joined by smoothness edges. Both are weights of one model (pagemodel), trained together. The
minimum cut, found by max-flow, is the cheapest labelling; blocks on the source's side are the article.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from facetlake.llm import pagemodel
from facetlake.llm.shared import text_columns

#: Elements whose content is no text of the page, to its end where they are not closed.
_RAW = "script|style|title|textarea"
#: The same, but of one that is not closed only the tag is left out.
_QUIET = frozenset("svg object canvas select audio video annotation annotation-xml noscript iframe template".split())
_ANY_QUIET = re.compile(rf"<(?:{'|'.join(_QUIET)})\b", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<(/?)([a-z][a-z0-9-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-z/!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul button label".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one of the same.
_SELF = frozenset("p li dt dd tr td th option".split())

#: Words in names of containers that speak for the article, and against it.
GOOD = frozenset("article articlebody blog content entry main post story".split())
BAD = frozenset(
    "ad ads adv advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright disclaimer disqus feedback footer header legal login masthead menu modal nav navbar navigation newsletter notice notification outbrain overlay pagination pager popup promo promotion recommended recommendations related replies reply search share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription taboola toolbar tracking widget widgets".split()
)
#: Of these, words that hold whatever follows them; the others count only as the last word that says something.
FIRM = frozenset("breadcrumb breadcrumbs comment comments cookie cookies footer nav navbar newsletter outbrain popup recommended related sidebar sponsored taboola".split())
#: First words that speak of a state, and last words that say nothing.
STATES = frozenset("has no is with without not js hide show".split())
PLAIN = frozenset("area bar block body bottom box btn button buttons container content desktop group holder inner item items left link links list main mobile outer page panel posts primary right row secondary section slot small text top unit wrap wrapper zone".split())

#: Landmarks, as bits: a block is in each of those that one of the elements around it opens.
IN_ARTICLE, IN_GOOD, IN_NAV, IN_FOOTER, IN_ASIDE, IN_FORM, IN_HEADER, IN_BAD, IN_HIDDEN = (1 << k for k in range(9))
LANDMARKS = 9
ELEMENTS = dict(article=IN_ARTICLE, main=IN_ARTICLE, nav=IN_NAV, menu=IN_NAV, footer=IN_FOOTER, aside=IN_ASIDE, header=IN_HEADER) | dict.fromkeys("form dialog button label search option fieldset legend".split(), IN_FORM)
ROLES = dict(main=IN_ARTICLE, article=IN_ARTICLE, navigation=IN_NAV, contentinfo=IN_FOOTER, complementary=IN_ASIDE, banner=IN_HEADER, search=IN_FORM, form=IN_FORM, dialog=IN_FORM, alert=IN_BAD, menu=IN_NAV)
_AGAINST = ~(IN_ARTICLE | IN_GOOD)
#: Kinds of edges: neighbours in page order of one parent and element, of one parent, of others; children of one parent; and any across a landmark.
SAME, SIBLING, FAR, APART, ACROSS = range(5)
KINDS = 5


def verdict(name: str) -> int:
    """IN_GOOD, IN_BAD or 0: what one name of a container, a single token, says."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[0] in STATES:
        return 0
    said = list(parts)
    while said and said[-1] in PLAIN:
        said.pop()
    if not said:
        return IN_GOOD if any(p in GOOD for p in parts) else 0
    if said[-1] in BAD or any(p in FIRM for p in said):
        return IN_BAD
    return IN_GOOD if said[-1] in GOOD else 0


def landmarks(name: str, attributes: str, around: int) -> int:
    """The landmarks that an element opens, inside of those around it."""
    out = ELEMENTS.get(name, 0)
    if out == IN_HEADER and around & IN_ARTICLE:
        out = 0
    if attributes and name not in ("html", "body"):
        for key, value in _NAMED.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "role":
                out |= ROLES.get(value.strip().lower(), 0)
            elif key == "itemprop":
                out |= IN_ARTICLE if value.strip().lower() == "articlebody" else 0
            else:
                for token in [value] if key == "aria-label" else value.split():
                    v = verdict(token)
                    # What is said to be the article is not undone by another of its names.
                    out |= v if v == IN_GOOD or not out & IN_ARTICLE or name == "article" and token.lower() in ("comment", "reply", "ad", "sponsored") else 0
        if _HIDDEN.search(attributes):
            out |= IN_HIDDEN
    return out


def quiet(page: str, tokens: list[re.Match]) -> dict[int, int]:
    """Start and end of each quiet element that is closed before the block around it is."""
    out: dict[int, int] = {}
    if not _ANY_QUIET.search(page):
        return out
    stack: list[tuple[str, int]] = []
    for m in tokens:
        name = (m.group(3) or "").lower()
        if name not in _QUIET and (name not in BLOCKS or name in _VOID):
            continue
        if not m.group(2):
            if not (name == "svg" and m.group(4).endswith("/")):
                stack.append((name, m.start()))
            continue
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                if name in _QUIET:
                    out[stack[k][1]] = m.end()
                del stack[k:]
                break
    return out


class Block:
    """Text of a block, what the classifier sees of it, the numbers of the elements around it, its element and landmarks."""

    __slots__ = ("text", "features", "path", "tag", "inside")

    def __init__(self, text: str, linked: int, path: tuple[int, ...], tag: str, inside: int):
        self.text, self.path, self.tag, self.inside = text, path, tag, inside
        links = min(1.0, linked / len(text))
        article = float(inside & IN_ARTICLE > 0)
        self.features = [
            1.0,
            *(float(inside >> k & 1) for k in range(LANDMARKS)),
            links,
            links * article,
            min(1.0, log(1 + len(text)) / log(300)),
            float(text[-1] in ".!?\"”»。！？…"),
            float(", " in text or "，" in text or "、" in text),
            float(tag in ("h1", "h2", "h3")),
            float(tag in ("p", "blockquote", "pre")),
            float(tag == "li"),
            float(tag in ("td", "th")),
            float(text.count(" ") < 2),
            float("©" in text),
            min(1.0, len(path) / 12),
        ]


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # element, landmarks with those of all above, number
    parts: list[str] = []
    linked = number = at = 0
    anchor = False

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, inside = (stack[-1][0], stack[-1][1]) if stack else ("", 0)
                out.append(Block(text, linked, tuple(x[2] for x in stack), tag, inside))
            parts, linked = [], 0

    def read(text: str) -> None:
        nonlocal linked
        if text:
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if anchor:
                linked += len(text.strip())

    tokens = list(_TOKEN.finditer(page))
    closed = quiet(page, tokens)
    for m in tokens:
        if m.start() < at:
            continue
        if m.start() > at:
            read(page[at : m.start()])
        at = closed.get(m.start(), m.end())
        name = m.group(3)
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            anchor = not m.group(2)
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            flush()
            if m.group(2):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                continue
            while stack and stack[-1][0] in ("option", "optgroup") and name not in ("option", "optgroup"):
                stack.pop()
            if stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in _SELF):
                stack.pop()
            if name in _VOID:
                continue
            around = stack[-1][1] if stack else 0
            number += 1
            stack.append((name, around | landmarks(name, m.group(4), around), number))
    read(page[at:])
    flush()
    return out


def neighbours(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges (i, j, kind) between blocks that follow each other, and between children of one parent with others in between."""
    edges = []
    last: dict[int, int] = {}
    for k, b in enumerate(found):
        parent = b.path[-2] if len(b.path) > 1 else 0
        if k:
            a = found[k - 1]
            if (a.inside ^ b.inside) & _AGAINST:
                kind = ACROSS
            elif parent == (a.path[-2] if len(a.path) > 1 else 0):
                kind = SAME if a.tag == b.tag else SIBLING
            else:
                kind = SIBLING if a.path == b.path[:-1] or a.path[:-1] == b.path else FAR
            edges.append((k - 1, k, kind))
        if parent in last and last[parent] < k - 1:
            edges.append((last[parent], k, ACROSS if (found[last[parent]].inside ^ b.inside) & _AGAINST else APART))
        last[parent] = k
    return edges


def min_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut.

    A positive unary is the capacity from the source, a negative one that to the sink; an edge has its
    capacity both ways. Nodes whose unary outweighs all their edges are cut free first, which changes no
    minimum; augmenting paths in the residual graph settle the others.
    """
    unary = list(unary)
    near: list[dict[int, float]] = [{} for _ in unary]
    for i, j, w in edges:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    side: list[bool | None] = [None] * len(unary)
    todo = deque(range(len(unary)))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(unary[i]) >= sum(near[i].values()):
            side[i] = unary[i] > 0
            for j, w in near[i].items():
                unary[j] += w if side[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    free = [i for i, s in enumerate(side) if s is None]
    if free:
        source, sink = -1, -2
        residual: dict[int, dict[int, float]] = {i: dict(near[i]) for i in free}
        residual[source] = {i: unary[i] for i in free if unary[i] > 0}
        residual[sink] = {}
        for i in free:
            residual[i][sink] = max(-unary[i], 0.0)
        while True:
            before, queue = {source: source}, deque([source])
            while queue and sink not in before:
                i = queue.popleft()
                for j, c in residual[i].items():
                    if c > 1e-12 and j not in before:
                        before[j] = i
                        queue.append(j)
            if sink not in before:
                break
            path, j = [], sink
            while j != source:
                path.append((before[j], j))
                j = before[j]
            flow = min(residual[i][j] for i, j in path)
            for i, j in path:
                residual[i][j] -= flow
                residual[j][i] = residual[j].get(i, 0.0) + flow
        for i in free:
            side[i] = i in before
    return [bool(s) for s in side]


@lru_cache(1)
def model() -> pagemodel.Model:
    """Weights of the classifier and capacities of the edges, trained on generated pages."""
    return pagemodel.trained(blocks, neighbours, labels, KINDS)


def costs(found: list[Block], known: pagemodel.Model) -> list[float]:
    """Log odds of each block by the classifier alone."""
    return (np.array([b.features for b in found]) @ known.weights).tolist() if found else []


def labels(found: list[Block], known: pagemodel.Model) -> list[bool]:
    """Whether each block belongs to the article, by the minimum cut."""
    # Labels count as 1 and -1, so that an edge between different ones costs its weight twice, as log odds do.
    return min_cut(costs(found, known), [(i, j, 2 * known.edges[kind]) for i, j, kind in neighbours(found)])


def main_text(page: str | None, known: pagemodel.Model | None = None) -> str:
    """The article's blocks in page order, joined by one space; empty for a null or empty page."""
    found = blocks(page or "")
    return " ".join(b.text for b, keep in zip(found, labels(found, known or model()), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """A row for each row of pages (page_id, url, html): page_id, url, text.

    Character references are decoded; white space in a block, and a line break, is one space. Nulls: a
    null html gives an empty text, a null page_id or url stays null. Malformed, cut-off and very long markup is
    read as far as it goes, whole. Ties: a block for which both labels cost the same is not of the article. Repeated
    rows each give a row; other columns are ignored; an empty table gives an empty one.
    """
    known = model()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([main_text(x.as_py(), known) for x in batch.column(2)], pa.string())], ["page_id", "url", "text"])

    return text_columns(pages, "page_id", "url", "html").selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "html").mapInArrow(read, "page_id long, url string, text string")
