"""Main-text extraction by minimum-cut labelling of a page's text blocks.

Every block gets a score from a linear classifier (where it stands: its
enclosing elements' tags and class, id and role words; and what it is: its
length, share of linked text, sentence ends). A positive score becomes the
capacity of an edge from the source (content), a negative one of an edge
to the sink (boilerplate). Smoothness edges join neighbours on the page and
blocks near each other in the DOM (the previous block with the same parent),
heavier the nearer the two stand in the tree. A maximum flow then finds the
cheapest cut: the blocks on the source's side are the main text. So a short
line without evidence of its own goes with the paragraphs around it.

Defined results: a page that is null, empty or without text has an empty
text; pages are judged each on their own (repeated rows alike), whole and
at any length; a page cut off inside a tag loses that tag only; an unclosed
comment, script or style hides the rest of the page, as in a browser.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, texts
from .html_blocks import Block, Element, text_blocks

# Words in a class, id or role that tell what an element is.
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond reactions discussion".split())
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar side aside footer masthead toolbar widget widgets
cookie cookies consent gdpr notice notification alert popup modal overlay dialog newsletter subscribe signup login search
share sharing social related recommended recommendations trending copyright disclaimer contentinfo complementary skip hidden
form""".split())
HEAD_WORDS = frozenset("header topbar".split())
CONTENT_WORDS = frozenset("article content post entry story main body text prose markdown".split())
SIDE_TAGS = frozenset("nav footer aside form menu dialog button fieldset search legend head".split())
CONTENT_TAGS = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Scores by the state that the enclosing elements leave a block in.
STATE_SCORE = {"content": 4.0, "none": 0.5, "side": -4.0, "comment": -6.0}
NEIGHBOUR, SIBLING = 0.8, 1.2      # weights of the smoothness edges between blocks with one parent
UNIT = 1000                        # capacities are integers, so the flow is exact


def _state(element: Element, known: dict[int, str]) -> str:
    """What the elements from the page down to this one say; the innermost that says something wins.

    Only comments stay comments, whatever element is used inside for one of them.
    """
    chain = []
    at: Element | None = element
    while at is not None and id(at) not in known:
        chain.append(at)
        at = at.parent
    state = known[id(at)] if at is not None else "none"
    for each in reversed(chain):
        state = known[id(each)] = _inside(each, state)
    return state


def _inside(element: Element, outer: str) -> str:
    """An element's state, given that of the element around it."""
    tag, words = element.tag, element.words
    if outer == "comment" or words & COMMENT_WORDS:
        return "comment"
    if tag in CONTENT_TAGS:
        return "content"
    if tag in SIDE_TAGS or (words & SIDE_WORDS and tag != "body" and tag != "html"):
        return "side"
    if (tag == "header" or words & HEAD_WORDS) and outer != "content":
        return "side"
    if words & CONTENT_WORDS and outer == "none" and tag not in ("body", "html"):
        return "content"
    return outer


def block_score(block: Block, state: str) -> float:
    """Above zero: rather content. The classifier's cost of the other label."""
    n = len(block.text)
    linked = block.linked / n
    score = STATE_SCORE[state] - 3.0 * linked * (linked > 0.5)
    if block.element.tag in HEADINGS or block.element.tag == "p":
        score += 0.5
    if n >= 80:
        score += 0.7
    elif n < 25 and state == "none":
        score -= 0.8
    if block.text[-1] in ".!?…\"'”»":
        score += 0.3
    return score


def _apart(a: Element, b: Element) -> int:
    """Steps between two elements in the tree, as far as it matters."""
    steps = 0
    while a is not b and steps < 8:
        if a.depth >= b.depth and a.parent is not None:
            a = a.parent
        elif b.parent is not None:
            b = b.parent
        else:
            break
        steps += 1
    return steps


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source's side of a cheapest cut (undirected edges; ties go to the sink's side)."""
    n = len(scores)
    spare = [round(s * UNIT) for s in scores]          # what is left of source (> 0) and sink (< 0) edges
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        c = round(w * UNIT)
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        out[b].append(len(to))
        to.append(a)
        cap.append(c)
    while True:
        # Levels from all nodes that still get flow from the source.
        level = [-1] * n
        queue = deque(v for v in range(n) if spare[v] > 0)
        for v in queue:
            level[v] = 0
        found = False
        while queue:
            v = queue.popleft()
            if spare[v] < 0:
                found = True
            for e in out[v]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if not found:
            return [x >= 0 for x in level]
        # A blocking flow along the levels, without recursion.
        nxt = [0] * n
        for s in range(n):
            while spare[s] > 0:
                path: list[int] = []
                v = s
                while True:
                    if spare[v] < 0:
                        push = min([spare[s], -spare[v], *(cap[e] for e in path)])
                        spare[s] -= push
                        spare[v] += push
                        for e in path:
                            cap[e] -= push
                            cap[e ^ 1] += push
                        break
                    while nxt[v] < len(out[v]):
                        e = out[v][nxt[v]]
                        if cap[e] and level[to[e]] == level[v] + 1:
                            break
                        nxt[v] += 1
                    if nxt[v] < len(out[v]):
                        path.append(out[v][nxt[v]])
                        v = to[path[-1]]
                    elif path:
                        path.pop()
                        v = to[path[-1]] if path else s
                        nxt[v] += 1
                    else:
                        break
                if not path and nxt[s] >= len(out[s]):
                    break


def main_blocks(page: str) -> list[Block]:
    """The page's blocks that are main text."""
    blocks = text_blocks(page)
    known: dict[int, str] = {}
    states = [_state(b.element, known) for b in blocks]
    scores = [block_score(b, s) for b, s in zip(blocks, states)]
    edges = []
    last_of: dict[int, int] = {}
    for i, b in enumerate(blocks):
        weight = lambda j: (1.0 if states[j] == states[i] else 0.25) / (1 + 0.5 * max(0, _apart(blocks[j].element, b.element) - 2))
        if i:
            edges.append((i - 1, i, NEIGHBOUR * weight(i - 1)))
        parent = id(b.element.parent)
        j = last_of.get(parent, i)
        if j < i - 1:
            edges.append((j, i, SIBLING * weight(j)))
        last_of[parent] = i
    return [b for b, keep in zip(blocks, minimum_cut(scores, edges)) if keep]


def main_text(page: str | None) -> str:
    """The main text of a page, one line per block."""
    return "\n".join(b.text for b in main_blocks(page)) if page else ""


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keep..., text, n_chars) of every page."""
    def start():
        def run(batch: pa.RecordBatch) -> dict:
            found = [main_text(t) for t in texts(batch, html_col)]
            return {"text": found, "n_chars": [len(t) for t in found]}
        return run

    return map_batches(pages.select(*keep, html_col), list(keep), start, {"text": pa.string(), "n_chars": pa.int64()})
