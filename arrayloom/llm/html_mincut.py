"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks at block-level tags. A linear classifier gives each block a score: what the structure
around it says (tags, class and id words), bounded, plus the log-odds that its own text is content, which a logistic
regression on length, links and punctuation gives. The regression is fitted to blocks of a bounded sample of pages whose
structure leaves no doubt. Scores become the capacities to the two terminals. Neighbouring blocks, and blocks near each
other in the tree, are joined by smoothness edges, the stronger the fewer steps lie between them. The minimum cut, found
by maximum flow, separates content from boilerplate. Each page is labelled alone inside mapInArrow.

A class, id or role of boilerplate, or a form, does not count for an element that wraps the page's content, and names of
layout states (has-sidebar) do not count at all.

Defined results: null html is empty; a page without content blocks has empty text; unclosed or stray tags are
tolerated, and an unclosed head, title, select or noscript does not end the page; pages of any length and depth are read
whole, in time proportional to their length; a block that ties between both sides is boilerplate; repeated rows are
handled separately; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_computed

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^<>])*+)>|<[!?/][^>]*>|[^<]+|<", re.S | re.I)
#: Elements without content of the page, each with the first thing that ends it: its end tag (the group), or a tag that cannot
#: stand in it. Where the latter comes first, or neither, the end tag is missing and nothing but the start tag is skipped.
SKIPPED = {
    tag: re.compile(rf"(</{tag}\s*>)|<(?:{bound})\b", re.I)
    for tag, bound in {
        "title": "/head|body|meta|link|script|style|title",
        "noscript": "noscript|/head|body",
        "select": "select|input|textarea|p|h[1-6]|article|main|section|table|ul|ol|body",
        "svg": "body",
        "template": "body",
        "iframe": "iframe",
        "textarea": "textarea",
    }.items()
}
#: What is skipped of an element without an end tag, besides its start tag: a title's text, a select's options.
REST = {"title": re.compile(r"[^<]*"), "select": re.compile(r"(?:[^<]|</?(?:option|optgroup|hr)\b[^>]*>)*", re.I)}
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Weights of ancestors: positive for content, negative for boilerplate.
TAGS = {"article": 6.0, "main": 4.0, "p": 1.0, "h1": 1.0, "h2": 0.5, "h3": 0.5, "blockquote": 0.5, "pre": 0.5, "figcaption": 0.3, "nav": -20.0, "footer": -20.0, "aside": -20.0, "form": -20.0, "button": -20.0, "menu": -20.0, "dialog": -20.0}
GOOD = re.compile(r"\b(article|content|post-?body|entry|main|story)\b", re.I)
BAD = re.compile(r"\b(ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|footer|sidebar|side-bar|cookie\w*|consent|notice|breadcrumbs?|comments?|comment-\w+|respond|disqus\w*|share|social|related|newsletter|subscribe|popup|modal|login|signup|widget)\b", re.I)
#: Names that tell of a page's layout or state, not of the element that has them.
STATE = re.compile(r"(?:has|no|is|with|without|hide|show)-.*|.*-(?:with|without|has|no)-.*|.*-(?:open|opened|closed|active|enabled|disabled|collapsed|expanded|fixed)", re.I)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!\s*important\s*)?(?:;|$)", re.I)
#: Smoothness: between blocks that follow each other, and between blocks of one container, or of containers that are
#: further apart in the tree (divided by the steps between them).
NEXT_TO, NEAR = 0.6, 0.8
#: What structure can say for or against a block, so that a cut can outweigh a single wrong sign, and what text can.
STRUCTURE, TEXT = 12.0, 3.0
#: Pages that the regression on texts is fitted to.
SAMPLE_PAGES = 300
#: Weights of text_features before any fit.
TEXT_WEIGHTS = (-0.6, -4.0, 2.0, 0.0, 0.0)


@dataclass
class Block:
    text: str
    structure: float
    features: tuple[float, ...]
    place: tuple[int, int]  # the container and the container's container
    score: float = 0.0


@dataclass
class Open:
    """An open element and what holds for text in it: sums and nearest elements of it and its ancestors."""

    tag: str
    number: int
    total: float  # weights
    place: tuple[int, int]
    article: bool
    against: bool  # a weight or doubt of boilerplate
    doubt: int  # the innermost element in doubt, 0 for none
    solid: int  # depth of the innermost element that is not inline


def text_features(text: str, linked: float) -> tuple[float, ...]:
    """One, share of letters in links, length, sentence ends, share of capitals."""
    n = len(text)
    return 1.0, linked, min(1.0, n / 400), min(4, sum(map(text.count, ".!?"))) / 4, sum(map(str.isupper, text[:200])) / min(n, 200)


def _weight(tag: str, attrs: str, in_article: bool) -> tuple[float, float]:
    """An element's weight, and what it loses besides unless it is a wrapper of the page."""
    w, doubt = TAGS.get(tag, 0.0), 0.0
    if tag == "form":
        w, doubt = 0.0, w
    if tag == "header" and not in_article:
        w -= 20
    if attrs and tag not in ("body", "html", "head"):
        given: dict[str, str] = {}
        for a, v in ATTRIBUTE.findall(attrs):
            given.setdefault(a.lower(), v[1:-1] if v[:1] in ('"', "'") else v)
        names = [n for a in ("class", "id", "role") if a in given for n in given[a].replace("_", "-").split()]
        good = 3 if GOOD.search(" ".join(names)) else 0
        # an article's names tell of its topics as well (category-social), so only a whole one counts
        bad = BAD.fullmatch if tag in ("article", "main") else BAD.search
        w += good
        if any(bad(n) for n in names if not STATE.fullmatch(n)):
            doubt -= 20 + good
        if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or INVISIBLE.search(given.get("style", "")):
            w -= 20
    return w, doubt


def _tokens(page: str) -> Iterator[re.Match]:
    """Matches of TOKEN outside skipped elements."""
    at, ended = 0, {}
    while m := TOKEN.match(page, at):
        at = m.end()
        tag = m[3].lower() if m[3] and not m[2] else ""
        if tag in SKIPPED and not m[0].endswith("/>"):
            end = SKIPPED[tag].search(page, at) if at < ended.get(tag, len(page)) else None
            if end is None:
                ended[tag] = min(at, ended.get(tag, at))
            if end is not None and end[1]:
                at = end.end()
            elif tag in REST:
                at = REST[tag].match(page, at).end()
        elif tag not in SKIPPED:
            yield m


def blocks(page: str) -> list[Block]:
    """The text blocks of a page with what structure and text say of each (positive: content)."""
    out: list[Block] = []
    root = Open("", 0, 0.0, (0, 0), False, False, 0, 0)
    stack = [root]
    depths: dict[str, list[int]] = {}  # of open elements by tag
    words: list[str] = []
    linked = made = 0
    # elements in doubt: what they lose, the one around them, letters and heads before them; of closed ones, what they hold
    doubts: dict[int, tuple[float, int, int, int]] = {}
    held: dict[int, tuple[int, int]] = {}
    inner: list[int] = []  # the innermost element in doubt of each block
    letters = heads = 0

    def flush() -> None:
        nonlocal words, linked
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            top = stack[-1]
            out.append(Block(text, top.total, text_features(text, linked / max(1, sum(map(len, words)))), top.place))
            inner.append(top.doubt)
        words, linked = [], 0

    def close(at: int) -> None:
        while len(stack) > at:
            e = stack.pop()
            depths[e.tag].pop()
            if e.number in doubts:
                held[e.number] = letters - doubts[e.number][2], heads - doubts[e.number][3]

    for m in _tokens(page):
        token = m[0]
        if m[3]:
            tag = m[3].lower()
            if tag not in INLINE:
                flush()
            if m[2]:
                if depths.get(tag):
                    close(depths[tag][-1])
            elif tag not in VOID and not token.endswith("/>"):
                if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6"):
                    # a block in a paragraph ends it, with the inline tags left open in it
                    at = (depths.get("li" if tag == "li" else "p") or [None])[-1]
                    if at is not None and stack[-1].solid <= at:
                        close(at)
                made += 1
                top = stack[-1]
                weight, doubt = _weight(tag, m[4] or "", top.article)
                if doubt:
                    doubts[made] = doubt, top.doubt, letters, heads
                # the head of content: a main or article that no ancestor speaks against
                heads += tag in ("article", "main") and not doubt and not top.against
                holds = tag not in INLINE and tag not in ("p", "li")
                depths.setdefault(tag, []).append(len(stack))
                stack.append(Open(
                    tag, made, top.total + weight, (made, top.place[0]) if holds else top.place, top.article or tag == "article",
                    top.against or weight <= -20 or bool(doubt), made if doubt else top.doubt, top.solid if tag in INLINE else len(stack),
                ))
        elif token[0] != "<" or token == "<":
            words.append(token)
            letters += len(token.strip())
            linked += len(token) if depths.get("a") else 0
    flush()
    close(1)
    # a wrapper holds most of the text, and no head of content stands beside it; elements in doubt are numbered outside in
    lost = {0: 0.0}
    for n, (d, around, _, _) in doubts.items():
        lost[n] = lost[around] + (d if 2 * held[n][0] <= letters or held[n][1] < heads else 0.0)
    for b, n in zip(out, inner, strict=True):
        b.structure += lost[n]
    return out


def scored(found: list[Block], weights: Sequence[float] = TEXT_WEIGHTS) -> list[Block]:
    """The blocks with their scores."""
    for b in found:
        said = sum(w * x for w, x in zip(weights, b.features, strict=True))
        b.score = max(-STRUCTURE, min(STRUCTURE, b.structure)) + max(-TEXT, min(TEXT, said))
    return found


def fit_texts(pages: list[str], steps: int = 300) -> tuple[float, ...]:
    """Weights of a logistic regression, by gradient descent, on the texts of blocks whose structure is beyond doubt; both
    classes weigh the same. The first weights where one class is missing."""
    found = [b for p in pages for b in blocks(p) if abs(b.structure) >= 4]
    x, y = np.array([b.features for b in found]), np.array([b.structure > 0 for b in found], float)
    if not 0 < y.sum() < len(y):
        return TEXT_WEIGHTS
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w = np.array(TEXT_WEIGHTS)
    for _ in range(steps):
        w -= 4.0 * (x.T @ (share * (1 / (1 + np.exp(-x @ w)) - y)) + 0.001 * w)
    return tuple(map(float, w))


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges: between blocks that follow each other; between each block and the last one before it of the same container,
    or of a container beside or around it (two steps)."""
    edges = [(i, i + 1, NEXT_TO) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    beside: dict[int, int] = {}
    for i, b in enumerate(found):
        here, around = b.place
        if here in last:
            edges.append((last[here], i, NEAR))
        elif around in beside:
            edges.append((beside[around], i, NEAR / 2))
        last[here] = beside[around] = i
    return edges


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side: Dinic's maximum flow over terminal and smoothness capacities."""
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, c: float, back: float) -> None:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((c, back))

    for i in range(n):
        # what both terminals share always flows
        shared = min(source[i], sink[i])
        if source[i] > shared:
            link(s, i, source[i] - shared, 0.0)
        elif sink[i] > shared:
            link(i, t, sink[i] - shared, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = {s: 0}
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                if cap[e] > 1e-9 and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if t not in level:
            return [i in level for i in range(n)]
        nxt = [0] * (n + 2)
        while True:
            path, a = [], s
            while a != t:
                for j in range(nxt[a], len(near[a])):
                    e = near[a][j]
                    if cap[e] > 1e-9 and level.get(to[e], -1) == level[a] + 1:
                        nxt[a] = j
                        path.append(e)
                        a = to[e]
                        break
                else:
                    nxt[a] = len(near[a])
                    if not path:
                        break
                    e = path.pop()
                    a = to[e ^ 1]
                    nxt[a] += 1
            if a != t:
                break
            flow = min(cap[e] for e in path)
            for e in path:
                cap[e] -= flow
                cap[e ^ 1] += flow


def labels(found: list[Block]) -> list[bool]:
    """Which scored blocks the minimum cut leaves on the side of content."""
    return minimum_cut([max(b.score, 0.0) for b in found], [max(-b.score, 0.0) for b in found], smoothness(found))


def main_text(page: str | None, weights: Sequence[float] = TEXT_WEIGHTS) -> str:
    """The content blocks of a page, one to a line."""
    found = scored(blocks(page or ""), weights)
    return "\n".join(b.text for b, c in zip(found, labels(found), strict=True) if c)


def learn(pages: DataFrame, column: str = "html", key: str = "page_id", sample_pages: int = SAMPLE_PAGES) -> tuple[float, ...]:
    """Text weights from at most sample_pages pages, drawn by a hash of the key."""
    given = pages.where(F.col(column) != "")
    h = F.xxhash64(F.lit("page"), key)
    share = min(1.0, 1.2 * sample_pages / max(1, given.count()) + 0.0001)
    some = given.select(h.alias("h"), F.col(column).alias("html")).where(F.col("h").cast("double") <= (2 * share - 1) * 2.0**63)
    return fit_texts([r["html"] for r in some.orderBy("h", "html").limit(sample_pages).collect()])


def extract_pages(pages: DataFrame, column: str = "html", key: str = "page_id", url: str = "url", weights: Sequence[float] = TEXT_WEIGHTS) -> DataFrame:
    """Per input row: page_id, url, text (main text), n_chars (its code points)."""

    def make():
        def compute(cells: list) -> dict[str, list]:
            texts = [main_text(p, weights) for p in cells]
            return {"text": texts, "n_chars": [*map(len, texts)]}

        return compute

    slim = pages.selectExpr(f"`{key}` AS page_id", f"`{url}` AS url", f"`{column}` AS html")
    return with_computed(slim, "html", make, {"text": "string", "n_chars": "long"})
