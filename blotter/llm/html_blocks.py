"""Text blocks of an HTML page, with where they stand in it.

A tolerant scan, not a validating parser: unclosed tags, stray end tags and
pages cut off anywhere give blocks as far as they go.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from dataclasses import dataclass, field

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Tag names of the HTML standard, by how this scan treats them.
RAW = frozenset("script style textarea iframe noembed noframes xmp template svg math object canvas audio video title select noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


@dataclass(slots=True)
class Element:
    tag: str
    words: frozenset            # of class, id and role
    parent: "Element | None"
    depth: int


@dataclass(slots=True)
class Block:
    text: str                   # references decoded, white space made single spaces
    element: Element            # the innermost block element around it
    linked: int                 # characters inside links
    parts: list = field(default_factory=list)


def _element(tag: str, attributes: str, parent: Element | None) -> Element:
    words: set[str] = set()
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            words.update(WORD.findall(CAMEL.sub(" ", m[2] or m[3] or m[4] or "").lower()))
    return Element(tag, frozenset(words), parent, parent.depth + 1 if parent else 0)


def text_blocks(page: str) -> list[Block]:
    """The blocks of visible text, in page order."""
    root = Element("", frozenset(), None, 0)
    stack, inner = [root], root     # open elements; the innermost block element
    block_at: list[int] = [0]       # where block elements stand in the stack
    opened: Counter[str] = Counter()
    blocks: list[Block] = []
    parts: list[str] = []
    state = [0, 0]                  # characters inside links, depth of links

    def end_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, inner, min(state[0], len(text))))
            parts.clear()
            state[0] = 0

    def close(k: int) -> None:
        nonlocal inner
        gone = stack[k:]
        if any(e.tag in BLOCK for e in gone):
            end_block()
        state[1] = max(0, state[1] - sum(e.tag == "a" for e in gone))
        opened.subtract(e.tag for e in gone)
        del stack[k:]
        while block_at[-1] >= k:
            block_at.pop()
        inner = stack[block_at[-1]]

    def add(raw: str) -> None:
        text = html_lib.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if state[1]:
            state[0] += len(text)

    at = 0
    for_search = TAG.search
    while (m := for_search(page, at)) is not None:
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            # Elements passed on the way to the one that ends are closed with it.
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0) if opened[tag] > 0 else 0
            if k:
                close(k)
            elif tag in BLOCK:
                end_block()
        elif tag in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            parts.append(" ")
        elif tag in VOID:
            if tag == "hr":
                end_block()
            else:
                parts.append(" " if tag == "br" else "")
        else:
            if tag in BLOCK:
                if tag in ENDS_P:
                    k = block_at[-1]
                    if k and stack[k].tag == "p":
                        close(k)
                if ends := SAME_ENDS.get(tag):
                    k = block_at[-1]
                    if k and stack[k].tag in ends:
                        close(k)
                end_block()
            stack.append(element := _element(tag, m[3], stack[-1]))
            opened[tag] += 1
            if tag in BLOCK:
                inner = element
                block_at.append(len(stack) - 1)
            elif tag == "a":
                state[1] += 1
    if at < len(page):
        add(page[at:])
    end_block()
    return blocks
