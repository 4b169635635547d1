"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node that is content or not.  A node
has evidence from its tag, its class and id words, its own text's length,
link share and punctuation; an edge has a potential for the labels of
parent and child.  One pass of sum-product messages up the tree and one
down give each node's exact marginal, and the own text of nodes above one
half is the main text.

Potentials are counts over a bounded, hash-drawn sample of labelled pages:
pages that name their article (``article``, ``main``, articleBody) label
their own nodes; the counts start from fixed prior counts for well-known
tags and class words, so pages of other make are judged too.

An unclosed raw-text element takes the rest of the page, as in browsers.
Other embedded elements go with all they hold when they are closed; an
unclosed one is a node whose own text is not content, and the page goes on.

Defined results: null and empty html give empty text; text outside any
element counts as the body's; unclosed and stray tags are mended as
browsers mostly do, in time linear in the page; quotes count only behind "=",
and one that never ends does not hide the page behind it; null ids and repeated rows are pages like others; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages learned from, about.
SAMPLE_PAGES = 400

# HTML's void, raw-text, embedded (those that do not nest apart) and inline elements, and what a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
HIDDEN = frozenset("svg math select button object audio video canvas".split())
UNNESTED = frozenset("select button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
# Prior knowledge, tags and class words that mark content or its surroundings.
CONTENT_TAGS = frozenset("article main p h1 h2 h3 blockquote pre".split())
OTHER_TAGS = frozenset("nav header footer aside form dialog menu head fieldset legend".split())
CONTENT_WORDS = frozenset("article content post entry story main body text prose".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert advertisement banner promo promotion sponsor sponsored sidebar side comment comments reply replies respond discussion"
    " cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related"
    " recommended breadcrumb breadcrumbs menu nav navbar navigation footer header masthead topbar toolbar pagination pager widget tags tagcloud"
    " copyright disclaimer search form author-bio byline-ad teaser outbrain taboola".split()
)
# What stands in these is not the page's article, whatever its own tag says.
BARRING_TAGS = frozenset("aside nav footer dialog".split())
BARRING_WORDS = frozenset("comment comments reply replies respond discussion disqus sidebar related recommended teaser teasers promo outbrain taboola".split())
PRIOR_COUNT = 40.0
#: Share of the largest marginal that a text must reach on a page where none reaches one half, and the least such marginal.
FALLBACK_SHARE, FALLBACK_LEAST = 0.5, 0.02

SPACES = re.compile(r"[ \t\n\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]+")
# A quote opens a value only behind "="; nothing is tried twice (possessive), so a scan is linear.
_REST = r"(?>=\s*+(?>\"[^\"]*\"|'[^']*')|[^>])*+>"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?[a-zA-Z][^\s/>]*+" + _REST + r"|[^<]+|<", re.S)
#: For pages with a quote that never ends: tags end at the next ">".
PLAIN_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z][^>]*>|[^<]+|<", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"(?<![-\w:.])([a-zA-Z_:][-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
CLASS_WORD = re.compile(r"[a-z]+")
END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I | re.A) for t in RAW}
TAGS = {t: re.compile(rf"<(/?){t}(?=[\s/>])" + _REST, re.I | re.A) for t in HIDDEN}


@dataclass
class Node:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    runs: list[tuple[int, str]] = field(default_factory=list)  # (order in the page, own text)
    linked: int = 0
    barred: bool = False  # stands in comments, a side column or the like


def closed(page: str, tag: str) -> dict[int, int]:
    """Ends of the closed ``tag`` elements of a page, by where their start tags end."""
    out: dict[int, int] = {}
    open_: list[int] = []
    for m in TAGS[tag].finditer(page):
        if m.group(1):
            if open_:
                out[open_.pop()] = m.end()
        elif not m.group().endswith("/>"):
            if tag in UNNESTED:
                open_.clear()
            open_.append(m.end())
    return out


def parse(page: str) -> list[Node]:
    """Block elements in page order, parents first; inline elements belong to their block."""
    nodes = [Node("body", -1)]
    # open elements: (tag, block node, open blocks up to here), inline ones too; and where each tag is open
    stack: list[tuple[str, int, int]] = []
    places: defaultdict[str, list[int]] = defaultdict(list)
    here, order, links, at = 0, 0, 0, 0
    last, scan = page.rfind(">"), TOKEN
    pieces: list[str] = []
    ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        nonlocal order, pieces
        if pieces and nodes[here].tag in HIDDEN:
            pieces = []
        elif pieces:
            nodes[here].runs.append((order, "".join(pieces)))
            order += 1
            pieces = []

    def open_blocks(k: int) -> int:
        return stack[k][2] if k >= 0 else 0

    def push(tag: str, node: int) -> None:
        places[tag].append(len(stack))
        stack.append((tag, node, (stack[-1][2] if stack else 0) + (tag not in INLINE)))

    def close_to(k: int) -> None:
        nonlocal here, links
        if open_blocks(len(stack) - 1) > open_blocks(k - 1):
            flush()
        for tag, _, _ in stack[k:]:
            links -= tag == "a"
            if tag != "span-ended":
                places[tag].pop()
        del stack[k:]
        here = stack[-1][1] if stack else 0

    while at < len(page):
        m = scan.match(page, at) if at <= last else None
        if m and m.group() == "<" and scan is TOKEN and page[at + 1 : at + 2].isalpha():
            scan = PLAIN_TOKEN
            m = scan.match(page, at)
        token = m.group() if m else page[at:]  # no tag ends behind the last ">"
        at += len(token)
        if not m and (cut := re.search(r"<!--|</?[a-zA-Z]", token)):
            token = token[: cut.start()]  # an unfinished tag or comment at the end of the page
            if not token:
                continue
        if token[0] != "<" or len(token) == 1 or not m:
            text = entities.unescape(token)
            pieces.append(text)
            if links:
                nodes[here].linked += len(text)
            continue
        name = NAME.match(token)
        if token.startswith("<![CDATA["):
            pieces.append(token[9:].removesuffix("]]>"))
            continue
        if not name or token[1] in "!?":
            continue
        tag = name.group(1).lower()
        if token[1] == "/":
            if not places[tag]:
                continue
            k = places[tag][-1]
            if tag in INLINE and open_blocks(len(stack) - 1) > open_blocks(k):
                links -= tag == "a"
                places[tag].pop()
                stack[k] = ("span-ended", *stack[k][1:])  # misnested inline: it ends, the blocks go on
            else:
                close_to(k)
            continue
        if tag in RAW:
            if not token.endswith("/>"):
                end = END[tag].search(page, at)
                at = end.end() if end else len(page)
            pieces.append(" ")
            continue
        if tag in HIDDEN:
            if tag not in ends:
                ends[tag] = closed(page, tag)
            if token.endswith("/>") or at in ends[tag]:
                at = ends[tag].get(at, at)
                pieces.append(" ")
                continue
        if tag in VOID:
            pieces.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        if tag in INLINE:
            push(tag, here)
            links += tag == "a"
            continue
        # a block: it ends an open paragraph, and items or cells of its kind in the same list
        ends_one = places["p"] and tag in BLOCK or any(places[t] for t in CLOSES.get(tag, ()))
        for k in range(len(stack) - 1, -1, -1) if ends_one else ():
            t = stack[k][0]
            if t == "p" and tag in BLOCK or t in CLOSES.get(tag, ()):
                close_to(k)
                break
            if t not in INLINE and t != "span-ended" and (tag not in CLOSES or t in SCOPES[tag]) and t != "p":
                break
        attributes = {a.lower(): v.strip("\"'").lower() for a, v in ATTRIBUTE.findall(token[name.end() :])}
        words = tuple(sorted({
            w for a in ("class", "id", "role", "itemprop") if a in attributes
            for w in CLASS_WORD.findall(attributes[a]) + re.split(r"\s+", attributes[a]) if w
        }))
        flush()
        nodes.append(Node(tag, here, words))
        here = len(nodes) - 1
        if not token.endswith("/>"):
            push(tag, here)
        else:
            here = nodes[here].parent
    flush()
    for n in nodes[1:]:
        above = nodes[n.parent]
        n.barred = above.barred or above.tag in BARRING_TAGS or not BARRING_WORDS.isdisjoint(above.words)
    return nodes


def own_text(node: Node) -> str:
    return SPACES.sub(" ", " ".join(t for _, t in node.runs)).strip()


def evidence(node: Node) -> list[str]:
    text = own_text(node)
    n = len(text)
    out = ["t:" + node.tag, f"n:{min(12, n.bit_length())}"]
    out += ["w:" + w for w in node.words]
    if node.barred:
        out.append("in:other")
    if n:
        share = min(1.0, node.linked / n)
        out.append(f"l:{round(share * 4)}")
        out.append(f"s:{min(3, sum(text.count(c) for c in '.!?,'))}")
    return out


# ------------------------------------------------------------------- model
@dataclass
class Model:
    unary: dict[str, float]
    pair: np.ndarray  # log P(child label | parent label)
    root: float  # log-odds of the body


def page_labels(nodes: list[Node]) -> list[int] | None:
    """Labels that a page with a named article gives its own nodes."""
    def named(n: Node) -> bool:
        return n.tag in ("article", "main") or "articlebody" in n.words

    if not any(named(n) for n in nodes):
        return None
    out: list[int] = []
    for n in nodes:
        inside = out[n.parent] if n.parent >= 0 else 0
        out.append(int((inside or named(n)) and not marked_other(n)))
    return out


def marked_other(node: Node) -> bool:
    return node.barred or node.tag in OTHER_TAGS or not OTHER_WORDS.isdisjoint(node.words) or "disqus" in node.words


def count_page(page: str) -> Counter:
    nodes = parse(page)
    labels = page_labels(nodes)
    counts: Counter = Counter()
    if labels:
        for n, y in zip(nodes, labels):
            counts[f"y:{y}"] += 1
            for e in evidence(n):
                counts[f"{y}|{e}"] += 1
            if n.parent >= 0:
                counts[f"p:{labels[n.parent]}{y}"] += 1
    return counts


def fit_counts(counts: dict[str, float]) -> Model:
    names = {k[2:] for k in counts if k[1] == "|"}
    prior = {"t:" + t: (PRIOR_COUNT, 1.0) for t in CONTENT_TAGS} | {"t:" + t: (1.0, 4 * PRIOR_COUNT) for t in OTHER_TAGS}
    prior |= {"w:" + w: (PRIOR_COUNT, 4.0) for w in CONTENT_WORDS} | {"w:" + w: (1.0, 8 * PRIOR_COUNT) for w in OTHER_WORDS}
    prior["in:other"] = (1.0, 8 * PRIOR_COUNT)
    total = [counts.get("y:0", 0) + 100.0, counts.get("y:1", 0) + 100.0]
    unary = {"in:other": -12.0}  # above what an article's own tag and words can weigh
    for e in names | set(prior):
        p1, p0 = prior.get(e, (1.0, 1.0))
        odds = math.log((counts.get(f"1|{e}", 0) + p1) / total[1]) - math.log((counts.get(f"0|{e}", 0) + p0) / total[0])
        unary[e] = max(-5.0, min(3.0, odds)) + unary.get(e, 0.0)
    pair = np.zeros((2, 2))
    start = np.array([[400.0, 4.0], [4.0, 400.0]])
    for a in (0, 1):
        row = [counts.get(f"p:{a}{b}", 0) + start[a, b] for b in (0, 1)]
        pair[a] = np.log(np.array(row) / sum(row))
    return Model(unary, pair, -1.0)


def marginals(nodes: list[Node], model: Model) -> np.ndarray:
    """P(content) of each node by messages up and down the tree."""
    n = len(nodes)
    own = [(0.0, sum(model.unary.get(e, 0.0) for e in evidence(x))) for x in nodes]
    (p00, p01), (p10, p11) = model.pair.tolist()

    def lse(a: float, b: float) -> float:
        return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))

    up = [list(o) for o in own]  # evidence below and at the node
    up[0][1] += model.root
    message = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        u0, u1 = up[i]
        message[i] = (lse(p00 + u0, p01 + u1), lse(p10 + u0, p11 + u1))
        p = nodes[i].parent
        up[p][0] += message[i][0]
        up[p][1] += message[i][1]
    belief = [tuple(u) for u in up]
    out = np.zeros(n)
    for i in range(n):
        if i:
            b0, b1 = belief[nodes[i].parent]
            m0, m1 = message[i]
            d0, d1 = b0 - m0, b1 - m1  # the parent without this child
            belief[i] = (up[i][0] + lse(d0 + p00, d1 + p10), up[i][1] + lse(d0 + p01, d1 + p11))
        b0, b1 = belief[i]
        out[i] = 1 / (1 + math.exp(min(60.0, max(-60.0, b0 - b1))))
    return out


def main_text(page: str | None, model: Model) -> str:
    if not page:
        return ""
    nodes = parse(page)
    chosen = []
    p = marginals(nodes, model)
    taken = p >= 0.5
    if not any(t and n.runs for t, n in zip(taken, nodes)):
        # a page without marks: the likeliest of its texts that nothing marks as surroundings
        free = np.array([bool(own_text(n)) and not marked_other(n) for n in nodes])
        least = max(FALLBACK_LEAST, FALLBACK_SHARE * p[free].max()) if free.any() else 1.0
        taken = free & (p >= least)
    for node, keep in zip(nodes, taken):
        if keep:
            chosen += [(order, SPACES.sub(" ", t).strip()) for order, t in node.runs]
    return " ".join(t for _, t in sorted(chosen) if t)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Model:
    n = pages.count()
    part = pages.where(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample_pages / max(n, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for page in b.column("html").to_pylist():
                if page:
                    counts.update(count_page(page))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["k", "c"])

    rows = part.select("html").mapInArrow(run, "k string, c bigint").groupBy("k").agg(F.sum("c").alias("c"))
    return fit_counts({r.k: r.c for r in rows.collect()})  # bounded by the sample


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), one row per page."""
    model = model or fit(pages)
    fields = pages.select("page_id", "url").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, model) for h in b.column("html").to_pylist()]
            arrays = [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ["text string", "n_chars bigint"])
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
