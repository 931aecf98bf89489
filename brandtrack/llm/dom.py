"""Block-level document trees of web pages.

A tree has a node for each block element; the text of inline elements belongs to the block around them. Parsing
never fails: unknown and unclosed tags, stray ends and cut pages give some tree, and no text outside markup, scripts
and styles is lost, but for that of elements beside the text, such as buttons. Of these, one without its own end is
an ordinary element: it ends nowhere, so what follows is no part of it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

#: Elements without markup inside; one without an end lasts to the end of the page.
RAW = frozenset("script style textarea title".split())
#: Elements that lie beside the text, from their start to their own end.
BESIDE = frozenset("noscript template iframe svg select object button datalist audio video canvas".split())
#: Of these, elements whose end also ends a raw element inside.
OUTER = frozenset("noscript iframe".split())
RAW_END = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.IGNORECASE | re.ASCII) for tag in RAW | OUTER}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Open elements that the start of another ends, up to the nearest of the limits.
ENDED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}


@dataclass(eq=False)
class Node:
    """A block: its tag, label, attributes and content, texts and nodes in page order."""

    tag: str
    label: str
    attributes: dict[str, str]
    parent: Node | None = None
    content: list = field(default_factory=list)

    @property
    def children(self) -> list[Node]:
        return [c for c in self.content if isinstance(c, Node)]

    @property
    def text(self) -> str:
        """The text that is directly in the block, pieces between its child blocks joined by spaces."""
        return " ".join(words for c in self.content if isinstance(c, str) and (words := tidy(c)))


def tidy(text: str) -> str:
    """White space as single spaces, none at the ends."""
    return " ".join(text.split())


def label(tag: str, attributes: dict[str, str]) -> str:
    """The tag with its classes; digits, which number a site's elements, are left out."""
    classes = sorted({re.sub(r"\d+", "", c) for c in attributes.get("class", "").lower().split()} - {""})
    return ".".join([tag, *classes])


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def _tags(source: str, at: int = 0):
    """Tags and other markup from ``at`` on: the match, whether an end, the tag, and what follows; raw text is passed over."""
    outer = None
    while found := MARKUP.search(source, at):
        at = found.end()
        closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if tag is not None:
            tag = tag.lower()
            if tag in OUTER:
                outer = None if closing else tag
            if tag in RAW and not closing:
                ended = RAW_END[tag].search(source, at)
                if outer and (around := RAW_END[outer].search(source, at, ended.start() if ended else len(source))):
                    ended = around
                at = ended.start() if ended else len(source)
        yield found, closing, tag, rest, at


def _beside(source: str) -> dict[int, int]:
    """Where the elements beside the text start, and where the end tag of each is, for those that have their own."""
    spans: dict[int, int] = {}
    starts: dict[str, list[int]] = {}
    for found, closing, tag, rest, _ in _tags(source):
        if tag in BESIDE:
            if not closing:
                if not rest.endswith("/"):
                    starts.setdefault(tag, []).append(found.start())
            elif starts.get(tag):
                spans[starts[tag].pop()] = found.start()
    return spans


def parse(source: str) -> Node:
    """The root of the page's tree, a node above ``html``."""
    root = Node("", "", {})
    stack = [root]
    is_open: Counter[str] = Counter()

    def end(upto: int) -> None:
        is_open.subtract(node.tag for node in stack[upto:])
        del stack[upto:]

    def place(tags: frozenset | set, limits: frozenset | set = frozenset()) -> int:
        if not any(is_open[tag] for tag in tags):  # else a deep page would be searched to its root for each tag
            return 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in limits:
                return 0
        return 0

    def write(text: str) -> None:
        if text:
            here = stack[-1].content
            if here and isinstance(here[-1], str):
                here[-1] += text
            else:
                here.append(text)

    at = skipped = 0
    spans: dict[int, int] | None = None
    for found, closing, tag, rest, after in _tags(source):
        if found.start() < skipped:
            continue
        write(html.unescape(source[at : found.start()]))
        at = after
        if tag is None:
            if found[0].startswith("<![CDATA["):
                write(found[0][9:].removesuffix("]]>"))
            continue
        if closing:
            if tag in BLOCK and (i := place({tag})):
                end(i)
            continue
        if tag in RAW:
            write(" ")
            continue
        if tag in BESIDE:
            spans = _beside(source) if spans is None else spans
            at = skipped = spans.get(found.start(), at)
            write(" ")
            continue
        if tag not in BLOCK:
            if tag in VOID:
                write(" ")
            continue
        if i := place({"p"}, {"table", "td", "th", "body", "article", "section", "div"}):
            end(i)
        if tag in ENDED_BY and (i := place(*ENDED_BY[tag])):
            end(i)
        attributes = _attributes(rest) if rest.strip() else {}
        node = Node(tag, label(tag, attributes), attributes, stack[-1])
        stack[-1].content.append(node)
        stack.append(node)
        is_open[tag] += 1
    write(html.unescape(source[at:]))
    return root
