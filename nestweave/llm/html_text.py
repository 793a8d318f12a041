"""Main text of web pages by minimum cuts.

A page is read as blocks (text between block elements, in page order). A logistic classifier
over features of a block, trained on blocks whose region the markup names, and that markup
itself give each block's cost of being content or boilerplate: capacities to the two terminals.
Neighbours in page order, and neighbours under the same parent, are joined by edges that weaken
with their distance in the tree. The minimum cut separates content from boilerplate.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.llm.storage import stage
from nestweave.llm.words import slices

#: Pages whose blocks the classifier is fitted on at most, the first by a hash of the page.
SAMPLE_PAGES = 1000
#: Weight of an edge between blocks under one parent; halved for each step between parents.
SMOOTHNESS = 2.0
#: The classifier's word counts up to this.
LEARNED_SCORE = 4.0
#: What the markup's own word adds to a block's score: in an article, less than a sure classifier;
#: in other regions, less than a sure classifier and two edges between siblings.
ARTICLE_SCORE = 3.0
OTHER_SCORE = 4.25

# Element names of the markup language by their role.
#: Their text is raw: without an end tag they reach to the end of the page.
RAW = "script|style|noscript|iframe|textarea"
#: Their text is not the page's. Any block element also ends the first ones.
BROKEN_OUT = frozenset(["head", "svg", "math", "select"])
#: These hide only what stands before an end tag of theirs.
ENCLOSED = frozenset("template object button canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot"
    " th thead title tr ul".split()
)
CONTENT_REGION = frozenset(["article", "main"])
OTHER_REGION = frozenset(["nav", "footer", "aside", "form", "menu", "dialog", "search"])
#: Elements that another one of the same group ends.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Words of class, id and role that name a region other than the article.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices alert popup modal overlay comment comments reply replies respond disqus discussion sidebar menu nav"
    " navbar navigation navbox breadcrumb breadcrumbs header masthead footer foot related recommended share sharing social"
    " subscribe subscription newsletter signup login search pagination pager toolbar widget complementary contentinfo".split()
)
CONTENT_WORDS = frozenset("article post entry content story body main maincontent".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<skip>{RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=skip)\s*>|\Z)"
    r"|<title(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</title\s*>|(?=</head[\s>]|<body[\s>])|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=>/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?]")

FEATURES = 6
#: Coefficients and intercept where no page names its regions.
UNTRAINED = (0.6, -4.0, 10.0, 0.0, 2.0, 1.0), -3.0


@dataclass
class Element:
    """An open element: its name, parent and depth, and what it says about its region."""

    name: str
    parent: Element | None
    depth: int
    region: int  # what it says itself: 1 an article, -1 not, 0 nothing
    hidden: bool = False


@dataclass
class Block:
    """A run of text under one element."""

    parent: Element
    texts: list[str] = field(default_factory=list)
    chars: int = 0
    linked: int = 0
    marks: int = 0
    region: int = 0


def _region(name: str, rest: str) -> int:
    """What an element says of its own region."""
    words = set()
    if "=" in rest:
        for match in _NAMED.finditer(rest):
            words.update(_WORD.findall((match[1] or match[2] or match[3] or "").lower()))
    if name in OTHER_REGION or _HIDDEN.search(rest):
        return -1
    other = bool(words & OTHER_WORDS) and name not in ("body", "html")
    if name in CONTENT_REGION:
        return 0 if other else 1
    content = bool(words & CONTENT_WORDS) and name in ("div", "section")
    # names of both kinds say nothing
    return -1 if name == "header" and not content else content - other


def _settle(found: list[Block]) -> None:
    """Give each block its region: that of the nearest element that names one.

    An element that names another region than the article but holds most of the page's text,
    and no article besides it has text, is a wrapper and names none (pages inside a form, say). An article
    inside another region counts as unknown.
    """
    held: dict[int, int] = {}
    named: dict[int, int] = {}
    total = articles = 0
    for block in found:
        size = block.chars - block.linked
        total += size
        node, inside = block.parent, False
        while node is not None:
            inside |= node.region > 0
            node = node.parent
        articles += size * inside
        node = block.parent
        while node is not None:
            held[id(node)] = held.get(id(node), 0) + size
            named[id(node)] = named.get(id(node), 0) + size * inside
            node = node.parent

    def wraps(node: Element) -> bool:
        return 2 * held[id(node)] > total and named[id(node)] == articles

    for block in found:
        says, node = 0, block.parent
        while node is not None:
            if node.region < 0 and not wraps(node):
                says = -1 if says <= 0 else 0
                break
            says = says or max(0, node.region)
            node = node.parent
        block.region = says


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    out: list[Block] = []
    top = Element("", None, 0, 0)
    block = Block(top)
    links = 0
    at = 0
    last_end: dict[str, int] = {}

    def leave(node: Element) -> None:
        """End ``node`` and what is open inside it."""
        nonlocal top, links
        while top is not node:
            links -= top.name == "a"
            top = top.parent
        links -= node.name == "a"
        top = node.parent

    def ends_later(name: str) -> bool:
        if name not in last_end:
            last_end[name] = max((m.start() for m in re.finditer(rf"</{name}[\s>]", page, re.I)), default=-1)
        return last_end[name] > at

    def add(text: str) -> None:
        nonlocal block
        if top.name == "head" and not text.isspace():
            leave(top)  # text is no part of a head
        if top.hidden:
            return
        if block.parent is not top:
            block = Block(top)
        if not block.texts:
            out.append(block)
        size = len(text)
        block.texts.append(text)
        block.chars += size
        block.marks += len(_MARKS.findall(text))
        if links:
            block.linked += size

    for match in TOKEN.finditer(page):
        if match.start() > at and (text := page[at : match.start()]) and (block.texts or not text.isspace()):
            add(text)
        at = match.end()
        name = match["name"]
        if not name:
            continue
        name = name.lower()
        if match["end"]:
            node = top
            while node is not None and node.name != name:
                node = node.parent
            if node is not None and node.parent is not None:
                while top is not node:
                    links -= top.name == "a"
                    top = top.parent
                links -= name == "a"
                top = node.parent
            if name in BLOCK:
                block = Block(top)
            continue
        if name == "br":
            if block.texts and block.parent is top:
                block.texts.append(" ")
            continue
        if name in VOID:
            continue
        if name in ("svg", "math") and match["rest"].endswith("/"):
            continue
        if top.name == "head" and name != "template":
            leave(top)
        elif name in BLOCK and top.hidden:
            node = top
            while node.parent is not None and node.name not in BROKEN_OUT and node.name not in ENCLOSED:
                node = node.parent
            if node.name in BROKEN_OUT:
                leave(node)
        elif name == "button":
            node = top
            while node.parent is not None and node.name != "button" and node.name not in BLOCK:
                node = node.parent
            if node.name == "button":
                leave(node)
        if name in BLOCK:
            closes = SIBLINGS.get(name, ())
            node = top
            # a block element ends an open paragraph, with what is open inside it
            while node.parent is not None and (node.name not in BLOCK or node.name == "p" or node.name in closes):
                if node.name == "p" or node.name in closes:
                    while top is not node:
                        links -= top.name == "a"
                        top = top.parent
                    top = node.parent
                node = node.parent
        links += name == "a"
        region = _region(name, match["rest"])
        hidden = top.hidden or name in BROKEN_OUT or name in ENCLOSED and ends_later(name)
        top = Element(name, top, top.depth + 1, region, hidden)
        if name in BLOCK:
            block = Block(top)
    if at < len(page) and not page[at:].isspace():
        add(page[at:])
    _settle(out)
    return _merged(out)


def _merged(found: list[Block]) -> list[Block]:
    """Runs that only inline elements separate are one block."""

    def holder(node: Element) -> Element:
        while node.parent is not None and node.name not in BLOCK:
            node = node.parent
        return node

    out: list[Block] = []
    for block in found:
        parent = holder(block.parent)
        region = block.region
        if out and out[-1].parent is parent and (region < 0) == (out[-1].region < 0):
            last = out[-1]
            last.texts += block.texts
            last.chars += block.chars
            last.linked += block.linked
            last.marks += block.marks
        else:
            block.parent = parent
            out.append(block)
    return out


def features(block: Block) -> list[float]:
    name = block.parent.name
    return [
        math.log1p(block.chars),
        block.linked / block.chars,
        block.marks / block.chars,
        min(block.chars, 500) / 500,
        float(name in ("h1", "h2", "h3", "h4", "h5", "h6")),
        float(name not in ("h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "th", "legend")),
    ]


def _distance(one: Element, two: Element) -> int:
    steps = 0
    while one is not two:
        if one.depth >= two.depth:
            one = one.parent
        else:
            two = two.parent
        steps += 1
    return steps


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Pairs of neighbours in page order or under one parent, with their weights."""
    out = []
    last: dict[int, int] = {}
    for k, block in enumerate(found):
        if k:
            out.append((k - 1, k, SMOOTHNESS * 0.5 ** _distance(found[k - 1].parent, block.parent)))
        parent = id(block.parent.parent)
        before = last.get(parent)
        if before is not None and before != k - 1:
            out.append((before, k, SMOOTHNESS / 4))
        last[parent] = k
    return out


def content_side(scores: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes a minimum cut leaves with the content terminal; ties go to content.

    Shortest augmenting paths from the nodes with capacity left from the content terminal to
    those with capacity left to the other.
    """
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in joined:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    give = [max(0.0, s) for s in scores]
    take = [max(0.0, -s) for s in scores]
    tiny = 1e-9
    while True:
        came = {k: -1 for k in range(n) if give[k] > tiny}
        queue = list(came)
        goal = -1
        for node in queue:
            if take[node] > tiny:
                goal = node
                break
            for other, w in near[node].items():
                if w > tiny and other not in came:
                    came[other] = node
                    queue.append(other)
        if goal < 0:
            break
        path = [goal]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        path.reverse()
        flow = min(give[path[0]], take[goal], *(near[a][b] for a, b in zip(path, path[1:], strict=False)))
        give[path[0]] -= flow
        take[goal] -= flow
        for a, b in zip(path, path[1:], strict=False):
            near[a][b] -= flow
            near[b][a] += flow
    # what can still reach the other terminal is on its side
    lost = [k for k in range(n) if take[k] > tiny]
    gone = set(lost)
    for node in lost:
        for other in near[node]:
            if other not in gone and near[other][node] > tiny:
                gone.add(other)
                lost.append(other)
    return [k not in gone for k in range(n)]


def main_text(page: str, weights: np.ndarray, intercept: float) -> str:
    """The content blocks of a page, each with single spaces, joined by spaces."""
    found = blocks(page)
    if not found:
        return ""
    learned = np.clip(np.array([features(b) for b in found]) @ weights + intercept, -LEARNED_SCORE, LEARNED_SCORE)
    named = {1: ARTICLE_SCORE, 0: 0.0, -1: -OTHER_SCORE}
    scores = [float(s) + named[b.region] for s, b in zip(learned, found, strict=True)]
    kept = content_side(scores, edges(found))
    texts = (" ".join(html.unescape("".join(b.texts)).split()) for b, k in zip(found, kept, strict=True) if k)
    return " ".join(t for t in texts if t)


def fit_classifier(pages: DataFrame, body: str = "html") -> tuple[tuple[float, ...], float]:
    """Coefficients and intercept from blocks whose region the markup names.

    Fitted on at most ``SAMPLE_PAGES`` pages. Without both kinds of blocks: ``UNTRAINED``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            rows = [(features(b), float(b.region > 0)) for p in batch.column("body").to_pylist() for b in blocks(p) if b.region]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.float64())], ["x", "label"]
            )

    plain = pages.select(F.col(body).cast("string").alias("body")).where("body is not null")
    # hashes first, so that no task gathers bodies it does not keep; equal pages count once
    placed = plain.withColumn("place", F.xxhash64("body"))
    places = stage(placed.select("place").distinct().orderBy("place").limit(SAMPLE_PAGES), "places")
    some = placed.join(F.broadcast(places), "place").groupBy("place").agg(F.min("body").alias("body")).select("body")
    sample = stage(some.mapInArrow(run, "x array<double>, label double"), "blocks")
    seen = sample.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return UNTRAINED
    fitted = LogisticRegression(maxIter=15, regParam=0.01).fit(sample.select(array_to_vector("x").alias("features"), "label"))
    return tuple(float(c) for c in fitted.coefficients), float(fitted.intercept)


def extract_text(pages: DataFrame, body: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of ``pages``, ``text`` and ``n_chars`` (its characters).

    ``text`` is the page's main text: content blocks in page order, character references decoded,
    white space inside a block turned into one space, blocks joined by one space. Null, empty
    and text-free pages give an empty text. Broken markup is read as it stands; an open comment or
    element of raw text (script, style, noscript, iframe, textarea) reaches to the end, a head up to what no head has. Columns named like a result are replaced; repeated rows are
    read each.
    """
    weights, intercept = fit_classifier(pages, body)
    names = [c for c in keep if c not in ("text", "n_chars")]
    plain = pages.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(names)), F.col(body).cast("string").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.array(weights)
        for batch in slices(batches, "body"):
            texts = [main_text(p or "", w, intercept) for p in batch.column("body").to_pylist()]
            rest = [batch.column(f"_{k}") for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*held, "text", "n_chars"]
            )

    held = [f"_{k}" for k in range(len(names))]
    kinds = [f"{h} {pages.schema[c].dataType.simpleString()}" for h, c in zip(held, names, strict=True)]
    done = plain.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
    return done.select(*(F.col(h).alias(c) for h, c in zip(held, names, strict=True)), "text", "n_chars")
