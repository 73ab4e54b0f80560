"""HTML pages as trees of block elements and text runs.

Only elements that can break a line become nodes; inline markup, formulas too, belongs to the run of text it
stands in. A run is the text between two block boundaries. Embedded elements are nodes where they hold text, and
white space where they hold none. Unclosed paragraphs, list items and cells end where the next one starts; stray
end tags are ignored; a tag cut off at the page's end is dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Elements of the HTML standard by their role here.
BLOCKS = frozenset(
    "html head body div section article main nav header footer aside ul ol li dl dt dd table thead tbody tfoot tr td th caption form "
    "fieldset p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary dialog menu center hgroup search legend".split()
)
VOID_BLOCKS = frozenset(["hr"])
EMBEDDED = frozenset("noscript svg iframe object select canvas audio video datalist".split())
SEPARATORS = frozenset("br option optgroup text".split())
SKIPPED = "script|style|template|title|textarea"  # no markup inside; not shown
ENDS_PARAGRAPH = BLOCKS | VOID_BLOCKS
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "p": ("p",)}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tr": {"table"}, "p": {"td", "th", "li", "div", "table"}}

TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<raw>{SKIPPED})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>(?P<inside>.*?)(?:</(?P=raw)(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*>|<[a-zA-Z/!?][^>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAMING = ("class", "id", "role", "itemprop")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    parent: int
    tag: str  # "#text" for a run
    names: tuple[str, ...] = ()
    text: str = ""
    linked: int = 0  # characters of a run inside links
    label: int | None = None
    depth: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)


class Opened:
    """A stack of named items that knows the places of each name."""

    def __init__(self) -> None:
        self.items: list[tuple[str, object]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, item: object) -> None:
        self.places.setdefault(name, []).append(len(self.items))
        self.items.append((name, item))

    def last(self, *names: str) -> int:
        """Place of the innermost item of these names; -1 without one."""
        return max((held[-1] for name in names if (held := self.places.get(name))), default=-1)

    def cut(self, place: int) -> None:
        """Take off this item and all above it."""
        while len(self.items) > place:
            self.places[self.items.pop()[0]].pop()


def named(attributes: str | None) -> tuple[tuple[str, ...], int | None]:
    """Parts of an element's names, and its label if it has one."""
    if not attributes or "=" not in attributes:
        return (), None
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
    names = tuple(part.lower() for key in NAMING if key in found for part in NAME_PART.findall(unescape(found[key])))
    return names, int(found["data-y"]) if "data-y" in found else None


def parse(html: str) -> Page:
    """Nodes in page order; a parent precedes its children. ``data-y`` labels an element and all below it."""
    page = Page([Node(-1, "#page")])
    nodes = page.nodes
    stack = Opened()  # of node numbers
    stack.push("#page", 0)
    chunks: list[str] = []
    pending = Opened()  # embedded elements without text so far: their names and label
    linked = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        if chunks:
            text = " ".join(unescape("".join(chunks)).split())
            if text:
                at = stack.items[-1][1]
                nodes.append(Node(at, "#text", (), text, linked, nodes[at].label, nodes[at].depth + 1))
            chunks.clear()
        linked = 0

    def close(tag: str, scope: set[str]) -> None:
        """End the innermost open ``tag`` that is not outside ``scope``."""
        place = stack.last(tag)
        if place > stack.last(*scope, *EMBEDDED):
            stack.cut(place)

    def end(tag: str) -> None:
        """End the innermost open ``tag`` with all inside it."""
        place = stack.last(tag)
        if place > 0:
            flush()
            stack.cut(place)
            pending.cut(0)

    def push(tag: str, names: tuple[str, ...], label: int | None) -> None:
        above = stack.items[-1][1]
        nodes.append(Node(above, tag, names, label=nodes[above].label if label is None else label, depth=nodes[above].depth + 1))
        stack.push(tag, len(nodes) - 1)

    def enter() -> None:
        """Pending elements hold something: they become nodes."""
        if pending.items:
            flush()
            for tag, element in pending.items:
                push(tag, *element)
            pending.cut(0)

    def read(chunk: str) -> None:
        nonlocal linked
        if pending.items and not chunk.isspace():
            enter()
        chunks.append(chunk)
        if in_link:
            linked += len(chunk)

    at = 0
    while match := TOKEN.search(html, at):
        if match.start() > at:
            read(html[at : match.start()])
        at = match.end()
        tag = match["tag"] or match["tag2"]
        if not tag:
            if match["raw"]:
                chunks.append(" ")
                if html[match.start("inside") - 2] == "/" and max(pending.last("svg"), stack.last("svg")) >= 0:
                    at = match.start("inside")  # closes itself there, and only there
            continue
        tag = tag.lower()
        ending = match["end"] or match["end2"]
        attributes = match["attributes"] or match["attributes2"]
        if tag in EMBEDDED:
            chunks.append(" ")
            if not ending:
                if tag != "svg" or not (attributes or "").endswith("/"):
                    pending.push(tag, named(attributes))
            elif (place := pending.last(tag)) >= 0:
                pending.cut(place)
            else:
                end(tag)
            continue
        if tag not in ENDS_PARAGRAPH:
            if tag == "a":
                in_link = not ending
            elif tag in SEPARATORS:
                chunks.append(" ")
            continue
        if ending:
            flush()
            in_link = False
            end(tag)
            continue
        enter()
        flush()
        if tag in SAME_ENDS:
            for other in SAME_ENDS[tag]:
                close(other, SCOPES[tag] - {other})
        if stack.items[-1][0] == "p" or (tag in ("div", "ul", "ol", "section", "table") and any(held == "p" for held, _ in stack.items[-2:])):
            close("p", {"td", "th", "li", "div", "table"})
        if tag in VOID_BLOCKS:
            continue
        push(tag, *named(attributes))
    if at < len(html):
        read(html[at:])
    flush()
    return page
