"""A page as a tree of block elements with their text, read in one pass and linear time."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element kinds of the markup language.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre search section summary table ul".split()
)
CLOSED_BY_SIBLING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"},
}
LISTS = frozenset("ul ol menu dl table select body html".split())

_token = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)""", re.S)
#: The end of a tag, or an attribute with its value; of a quoted value the opening quote.
_attribute = re.compile(r"""[\s/]*(?:(>)|(=?[^\s/>=]*)(?:\s*=\s*(["']|[^\s>"'][^\s>]*)?)?)""")
_named = re.compile(r"\b(?:class|id|role|(data-y))$", re.I)


@dataclass
class Node:
    tag: str
    parent: int
    names: str = ""
    label: str = ""
    blocks: list[int] = field(default_factory=list)
    words: int = 0
    link_words: int = 0
    own_words: int = 0
    sentences: int = 0


@dataclass
class Page:
    """Elements in page order, parents first; blocks of text in page order with the element each stands in."""

    nodes: list[Node]
    blocks: list[tuple[int, str]]


def _attributes(source: str, at: int) -> tuple[str, str, int]:
    """Names and label of a tag whose attributes begin at a place, and where the tag ends.

    A value in quotes is of any length. A quote that nothing closes is an ordinary character; as no more of its kind follow, each is
    searched to the end of the page once at most.
    """
    names, label = [], ""
    while at < len(source):
        found = _attribute.match(source, at)
        at = found.end()
        if found.group(1):
            break
        value = found.group(3) or ""
        if value in ('"', "'"):
            end = source.find(value, at)
            if end < 0:
                continue
            value, at = source[at:end], end + 1
        named = value and _named.search(found.group(2))
        if named and named.group(1):
            label = value
        elif named:
            names.append(value)
    return " ".join(names), label, at


def read_page(source: str) -> Page:
    nodes = [Node("#page", -1)]
    blocks: list[tuple[int, str]] = []
    path = [0]
    pending: list[str] = []
    links = 0
    link_words = 0

    def flush() -> None:
        nonlocal link_words
        words = html.unescape("".join(pending)).split()
        pending.clear()
        if words:
            node = nodes[path[-1]]
            blocks.append((path[-1], " ".join(words)))
            node.own_words += len(words)
            node.link_words += min(link_words, len(words))
            node.sentences += sum(w[-1] in ".!?…" for w in words)
        link_words = 0

    def add(text: str) -> None:
        nonlocal link_words
        pending.append(text)
        if links:
            link_words += len(text.split())

    def close(tags: set[str] | frozenset[str], within: frozenset[str]) -> None:
        """Close the nearest open element of these, unless one of ``within`` is nearer."""
        for i in range(len(path) - 1, 0, -1):
            tag = nodes[path[i]].tag
            if tag in tags:
                flush()
                del path[i:]
                return
            if tag in within:
                return

    at, size = 0, len(source)
    while at < size:
        found = _token.search(source, at)
        if not found:
            add(source[at:])
            break
        if found.start() > at:
            add(source[at : found.start()])
        at = found.end()
        if found.group(2) is None:
            continue
        tag = found.group(2).lower()
        names, label, at = _attributes(source, at)
        if found.group(1):
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in INLINE:
                close({tag}, frozenset())
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if tag == "a":
            links += 1
            continue
        if tag in INLINE:
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if tag in CLOSES_PARAGRAPH:
            close({"p"}, CLOSES_PARAGRAPH - {"p"})
        if tag in CLOSED_BY_SIBLING:
            close(CLOSED_BY_SIBLING[tag], LISTS)
        nodes.append(Node(tag, path[-1], names, label))
        path.append(len(nodes) - 1)
    flush()
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        node.words += node.own_words
        if node.parent >= 0:
            above = nodes[node.parent]
            above.words += node.words
            above.link_words += node.link_words
            above.sentences += node.sentences
    return Page(nodes, blocks)
