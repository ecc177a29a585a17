"""HTML extraction by minimum-cut labelling.

A page is read once into blocks: runs of text between block-level tags, outside
scripts, styles and the head.  A classifier gives each block a cost for either
label (its log odds); these are the capacities to the two terminals.  Edges tie
each block to the next one and to the next one under the same parent, the more
firmly the nearer they stand in the tree, so a short paragraph follows its
neighbours.  The minimum cut, found by max-flow, labels all blocks at once; the
content side is the main text.

The classifier is logistic.  It learns from a bounded sample of pages
(``max_pages``, by a hash of the id) whose markup names its parts: blocks under
``article`` or ``main`` against blocks under ``nav``, ``footer`` and the like.  Each
block is shown with these names and without, so pages that lack them are judged by
wording of classes and ids, links, length and place.

Text: character references decoded, white space in a block (Unicode's) is one space,
trimmed, blocks joined in page order by one space; nothing else is dropped or cut.

Defined results: null or empty html has the empty text; text without any tag is
one block; unclosed and stray tags are repaired by what may stand inside what;
repeated rows and null ids or urls are kept; equal costs go to boilerplate; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import bounded_sample, slices

# HTML's own element names by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template head title svg math iframe object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: What may stand in a head; any other start tag ends an open head, unless it is inside one of ``HEAD_HOLDS``.
HEAD_TAGS = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
HEAD_HOLDS = frozenset(["noscript", "template"])
#: An open element that one of these ends without an end tag.
CLOSED_BY = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside header footer nav main form blockquote pre figure hr address fieldset details".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
#: Where the search for an open ``p`` or ``li`` stops.
SCOPE = frozenset("body article main section div table td ul ol dl form aside header footer nav blockquote".split())
CONTENT_TAGS = frozenset(["article", "main"])
BOILER_TAGS = frozenset("nav footer aside form menu dialog button select textarea fieldset".split())
# Words of class names, ids and roles that name a part of a page.
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer sidebar side aside complementary widget contentinfo "
    "notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login search "
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion dfp "
    "comment comments reply replies disqus discussion respond share sharing social related recommended more pagination pager tags copyright form".split()
)
#: Parts in which no inner article counts as content (reader comments often are articles).
STICKY_TAGS = frozenset("nav footer aside".split())
STICKY_WORDS = frozenset(
    "comment comments reply replies respond disqus discussion related recommended ad ads adv advert advertisement sponsor sponsored promo cookie cookies consent gdpr newsletter".split()
)
CONTENT_WORDS = frozenset("article content post entry story main body text maincontent articlebody prose".split())
NAME = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the open elements, outermost first (the innermost 16)
    tag: str
    linked: int  # characters inside links
    content: int  # how far in the nearest content element is (0: none)
    boiler: int  # the same for an element of boilerplate
    content_words: int
    boiler_words: int


@dataclass
class _Open:
    tag: str
    number: int
    content: int
    boiler: int
    content_words: int
    boiler_words: int
    skipped: bool = field(default=False)
    sticky: bool = field(default=False)
    outer: _Open | None = field(default=None)  # the nearest element around it that isn't inline


class BlockReader(HTMLParser):
    """The blocks of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._open: list[_Open] = [_Open("", 0, 0, 0, 0, 0)]
        self._n = 0
        self._head = 0  # the place of an open head
        self._parts: list[str] = []
        self._links = 0
        self._linked = 0

    def read(self, html: str) -> list[Block]:
        self.feed(html)
        self.close()
        self._flush()
        return self.blocks

    def _flush(self) -> None:
        text = SPACE.sub(" ", "".join(self._parts)).strip()
        if text:
            # Inline elements don't make a place of their own.
            stack, x = [], self._open[-1]
            x = x.outer if x.tag in INLINE else x
            while x and len(stack) < 16:
                stack.append(x)
                x = x.outer
            stack.reverse()
            top = stack[-1]
            self.blocks.append(
                Block(text, tuple(x.number for x in stack), top.tag, min(self._linked, len(text)), top.content, top.boiler, top.content_words, top.boiler_words)
            )
        self._parts, self._linked = [], 0

    def _pop(self, to: int) -> None:
        for x in self._open[to:]:
            self._links -= x.tag == "a"
        del self._open[to:]
        if to <= self._head:
            self._head = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._head and tag not in HEAD_TAGS and (tag == "body" or not any(x.tag in HEAD_HOLDS for x in self._open[self._head :])):
            self._pop(self._head)
        if tag == "head":
            if any(x.tag not in ("", "html") for x in self._open):
                return  # HTML ignores a head inside of something else
            self._head = len(self._open)
        if tag == "br":
            self._parts.append(" ")
        if tag not in INLINE:
            self._flush()
            for i in range(len(self._open) - 1, 0, -1):
                name = self._open[i].tag
                if tag in CLOSED_BY.get(name, ()):
                    self._pop(i)
                    break
                if name in SCOPE:
                    break
        if tag in VOID:
            return
        up = self._open[-1]
        depth = len(self._open)
        words = set(NAME.findall(" ".join((v or "").lower() for k, v in attrs if k in ("class", "id", "role")))) if tag not in ("html", "body") else set()
        self._n += 1
        header = tag == "header" and not up.content
        sticky = up.sticky or tag in STICKY_TAGS or bool(words & STICKY_WORDS)
        own = _Open(
            tag,
            self._n,
            depth if tag in CONTENT_TAGS and not sticky else up.content,
            depth if tag in BOILER_TAGS or header else up.boiler,
            depth if words & CONTENT_WORDS and not words & BOILER_WORDS and not sticky else up.content_words,
            depth if words & BOILER_WORDS else up.boiler_words,
            up.skipped or tag in SKIPPED,
            sticky,
            up.outer if up.tag in INLINE else up,
        )
        self._open.append(own)
        self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i].tag == tag:
                self._pop(i)
                return
            if tag in INLINE and self._open[i].tag not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self._head == len(self._open) - 1 > 0 and data.strip():
            self._pop(self._head)  # text may not stand in a head
        if self._open[-1].skipped:
            return
        self._parts.append(data)
        if self._links:
            self._linked += len(data.strip())


FEATURES = 12


def describe(blocks: list[Block], named: bool = True) -> np.ndarray:
    """A row of features for each block; ``named``: with what the elements' names say."""
    rows = []
    n = len(blocks)
    for i, b in enumerate(blocks):
        chars = len(b.text)
        rows.append(
            (
                named and b.content > max(b.boiler, b.boiler_words),
                named and b.boiler > b.content,
                b.content_words > max(b.boiler, b.boiler_words),
                b.boiler_words > max(b.content_words, b.content if named else 0),
                b.linked / chars,
                b.linked >= 0.5 * chars,
                min(math.log1p(chars), 8) / 8,
                chars >= 80 and b.linked < 0.3 * chars,
                b.tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "h4"),
                b.tag in ("li", "td", "label", "option"),
                ("©" in b.text or "·" in b.text or "|" in b.text) and chars < 200,
                n > 2 and i in (0, n - 1),
            )
        )
    return np.array(rows, float).reshape(-1, FEATURES)


#: Where the classifier starts, and its answer when no sample page names its parts.
PRIOR = np.array([4.0, -4.0, 3.0, -5.0, -2.0, -1.0, 1.5, 1.5, 1.0, -1.0, -2.0, -0.5])
BIAS = -0.5


def fit(x: np.ndarray, y: np.ndarray, strength: float = 2.0, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton's method, drawn to ``PRIOR``; a sign that the prior states is kept."""
    centre = np.append(PRIOR, BIAS)
    if not len(y):
        return centre
    x = np.hstack([x, np.ones((len(x), 1))])
    w = centre.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (y - p) - strength * (w - centre)
        curve = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        size = np.abs(step).max()
        w = w + step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    w[:-1] = np.where(np.sign(w[:-1]) == np.sign(centre[:-1]), w[:-1], 0)
    return w


def label(odds: np.ndarray, paths: list[tuple[int, ...]], smooth: float = 1.0) -> np.ndarray:
    """Content or not for each block: the minimum cut between the terminals."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(odds):
        if x > 0:
            edge(source, i, float(x), 0.0)
        elif x < 0:
            edge(i, sink, float(-x), 0.0)
    last: dict[tuple[int, ...], int] = {}
    for i, path in enumerate(paths):
        if i:
            steps = len(path) + len(paths[i - 1]) - 2 * len(set(path) & set(paths[i - 1]))
            w = smooth * math.exp(-steps / 2)
            edge(i - 1, i, w, w)
        parent = path[:-1]
        if parent in last and last[parent] != i - 1:
            edge(last[parent], i, smooth / 2, smooth / 2)
        last[parent] = i

    while True:  # Dinic: levels, then blocking flow along them
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array([level[i] >= 0 for i in range(n)], bool)
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if room[e] <= 1e-12)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(e)
                a = to[e]
            elif path:
                level[a] = -1
                a = to[path.pop() ^ 1]
            else:
                break


def main_text(html: str | None, weights: np.ndarray) -> str:
    blocks = BlockReader().read(html or "")
    if not blocks:
        return ""
    odds = describe(blocks) @ weights[:-1] + weights[-1]
    keep = label(np.clip(odds, -12, 12), [b.path for b in blocks])
    return " ".join(b.text for b, k in zip(blocks, keep) if k)


def train(pages: DataFrame, max_pages: int = 1000) -> np.ndarray:
    """The classifier's weights and bias, from at most ``max_pages`` pages whose markup names its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows, truth = [], []
            for html in batch.column("html").to_pylist():
                blocks = BlockReader().read(html)
                said = [b.content > max(b.boiler, b.boiler_words) for b in blocks]
                if any(said) and not all(said):
                    told = [(b.content > 0) or (b.boiler > 0) or (b.boiler_words > 0) for b in blocks]
                    for x in (describe(blocks), describe(blocks, named=False)):
                        # Sums over equal rows keep the sample small: one page has many like blocks.
                        for row, y in {(tuple(r), s) for r, s, t in zip(x.round(2).tolist(), said, told) if t}:
                            rows.append(row)
                            truth.append(float(y))
            yield pa.RecordBatch.from_arrays([pa.array([list(r) for r in rows], pa.list_(pa.float64())), pa.array(truth, pa.float64())], names=["x", "y"])

    chosen = bounded_sample(pages.filter("html IS NOT NULL").select("page_id", "html"), ["page_id", "html"], max_pages)
    got = chosen.select("html").mapInArrow(run, "x array<double>, y double").groupBy("x", "y").count().orderBy("x", "y").collect()
    return fit(np.array([r["x"] for r in got], float).reshape(-1, FEATURES), np.array([r["y"] for r in got], float))


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    weights = train(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x, weights) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
