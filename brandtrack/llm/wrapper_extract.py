"""Main text of web pages by wrapper induction.

Pages of one host share a template. All its pages with different markup are aligned by simple tree matching with one
of its most common layout: nodes that keep their text on nine tenths of the pages are template, nodes whose text
changes are slots. A page's main slots are the containers that hold most of its varying text and its first varying
heading; the host's is the deepest that half of the pages name. Pages without it are aligned anew among themselves, so a
host with several layouts has several. The host's wrapper is the places of its main slots and of all texts beside them,
and its size follows these places. On a page with a main slot, what lies at a place beside it is no main text, whatever
it is named, and what lies inside is, constant lines too, but for menus, forms, notices, adverts and comments in the midst
of it, which are known by their tags, roles, classes and ids. Names also decide where the wrapper knows nothing: on hosts
with too few pages, on pages without a main slot, where template texts of the host outside articles are left out as
well, and at places it has not seen.

Defined results: null or empty html gives an empty text; pages with a null url are one host; repeated rows are
extracted each; an empty table gives an empty result; whatever isn't a page is parsed as one. Whole pages are
read, no text is cut, and alignments are the largest ones, however deep or wide a page is. Memory follows a page's
length; time does where the pages of a host are alike, and grows at worst with the product of two pages' nodes at the same
places, which are compared a row at once then. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import count
from math import isqrt
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import Lookup, attach, hot_keys
from .dom import Node, parse, tidy
from .tables import Workspace

#: How many different pages of a host a main slot and template texts need.
ENOUGH = 2
ENOUGH_FIXED = 4
#: Comparisons of nodes that an alignment makes one by one, in all and for one list; beyond, it makes a row of them at once.
CELLS = 50_000
WIDE = 1_000
#: Nodes that two long lists' alignment may leave out in a first trial.
SLACK = 256
#: Rows of sizes that one alignment keeps; what it wants again beyond that is computed again.
ROW_BYTES = 64 << 20
#: Wrappers up to this number of bytes are broadcast.
WRAPPER_BYTES = 32 << 20
SALTS = 64
#: Keys of pages or hosts up to this number are broadcast.
CHOSEN_ROWS = 1_000_000
#: The seed of Spark's ``xxhash64``.
KEY_SEED = 42

#: Elements that hold no main text, whatever their names.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog head".split())
MAIN_TAGS = frozenset(["article", "main"])
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: Words of a class or id that name something beside the main text.
ASIDE_WORDS = frozenset(
    "ad adbox ads adslot adunit advert adverts advertisement advertisements advertising adsense alert announcement banner "
    "breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended recommendations related "
    "replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar "
    "topbar widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
#: Words that may stand beside these in one name; with any other word, a name says something else, as in ``share-price``.
PLAIN_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons center closed column container content cookie custom "
    "dark default fixed form global head header holder hidden icons info inline inner item items js large left light link "
    "links list main message messages mobile mini module news open outer page pages panel policy post posts primary right "
    "row section secondary site small sticky stories story thread top user users warning wide wrap wrapper".split()
)
#: Words that turn such a class into one of the page's layout.
LAYOUT_WORDS = frozenset("has with no without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset("body main article section div center td".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def host(url: Column) -> Column:
    """The url's host in lower case, without user and port; empty without url."""
    named = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(named)


def _names(node: Node) -> list[set[str]]:
    """The words of each class and of the id."""
    names = [*node.attributes.get("class", "").split(), node.attributes.get("id", "")]
    parted = (re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower() for name in names)
    return [words for name in parted if (words := set(re.findall(r"[a-z]+", name)))]


def is_aside(node: Node, in_main: bool) -> tuple[bool, bool]:
    """Whether the node holds no main text, and whether a main element inside would still count."""
    attributes = node.attributes
    if node.tag in ASIDE_TAGS or (node.tag == "header" and not in_main):
        return True, False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")):
        return True, False
    if attributes.get("role", "").lower() in ASIDE_ROLES:
        return True, False
    if node.tag in ("html", "body", "main") or not attributes:
        return False, True
    soft = False
    for words in _names(node):
        if words & LAYOUT_WORDS or not words <= (ASIDE_WORDS | PLAIN_WORDS):
            continue
        if words & COMMENT_WORDS:
            return True, False
        soft |= bool(words & ASIDE_WORDS) or ("header" in words and not in_main)
    return soft and node.tag != "article", True


def _below(place: int, node: Node) -> int:
    """A node's place, the labels from the root down, as a hash: paths of deep pages are as long as the pages."""
    return xxhash.xxh3_64_intdigest(node.label.encode("utf-8", "replace"), place)


class Block:
    """A text with the node it is in, that node's place, and what is known of its surroundings."""

    __slots__ = ("aside", "aside_within", "hard", "in_main", "in_slot", "node", "place", "text")

    def __init__(self, node: Node, place: int, text: str, aside: bool, hard: bool, within: bool, in_main: bool, in_slot: bool):
        self.node, self.place, self.text = node, place, text
        self.aside, self.hard, self.aside_within, self.in_main, self.in_slot = aside, hard, within, in_main, in_slot


def blocks(root: Node, slots: frozenset[int] = frozenset()) -> Iterator[Block]:
    """Blocks in page order. ``aside`` goes by all names around a block, ``hard`` by tags, roles and comments' names
    alone, ``aside_within`` by all names in the main slot."""
    # a stack of (node, place, aside, aside for good, aside in the slot, in a main element, in a slot, next piece)
    stack: list[tuple] = [(root, 0, False, False, False, False, False, 0)]
    while stack:
        node, place, aside, hard, within, in_main, in_slot, at = stack.pop()
        content = node.content
        while at < len(content):
            piece = content[at]
            at += 1
            if isinstance(piece, str):
                if text := tidy(piece):
                    yield Block(node, place, text, aside, hard, within, in_main, in_slot)
                continue
            here = _below(place, piece)
            starts_slot = here in slots and not in_slot
            own, soft = is_aside(piece, in_main or in_slot)
            now_hard = hard or (own and not soft)
            starts_main = piece.tag in MAIN_TAGS and not own and not hard
            now_aside = now_hard or (own or aside) and not starts_main
            now_within = not starts_slot and (within or (in_slot and own))
            stack.append((node, place, aside, hard, within, in_main, in_slot, at))
            stack.append((piece, here, now_aside, now_hard, now_within, in_main or starts_main, in_slot or starts_slot, 0))
            break


class _Shapes:
    """Numbers of subtrees' shapes, labels without text: equal shapes have equal numbers."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.of: dict[int, int] = {}
        self.children: dict[int, list[Node]] = {}

    def add(self, root: Node) -> None:
        todo = [(root, False)]
        while todo:
            node, seen = todo.pop()
            if not seen:
                own = self.children[id(node)] = node.children
                todo.append((node, True))
                todo += [(child, False) for child in own]
                continue
            key = (node.label, *(self.of[id(c)] for c in self.children[id(node)]))
            self.of[id(node)] = self.known.setdefault(key, len(self.known))


def _run(task):
    """Run a generator that yields generators as a recursive function, without Python's stack."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def _cells(at: list[int], columns: list[int], n: int) -> tuple[np.ndarray | None, np.ndarray]:
    """Which of ``n`` cells hold a shape, and these shapes' columns; with many cells, a column for each, -1 for no shape."""
    if 8 * len(at) < n:
        return np.array(at), np.array(columns)
    spread = np.full(n, -1)
    spread[at] = columns
    return None, spread


def _extend(sums: np.ndarray, row: np.ndarray, cells: tuple[np.ndarray | None, np.ndarray], low: int, high: int) -> None:
    """One more left node in the sums from ``low`` to ``high``: in cell ``j + 1``, it goes with the shape of cell ``j`` or not."""
    at, columns = cells
    if at is None:
        together = sums[low - 1 : high - 1] + row[columns[low - 1 : high - 1]]
        np.maximum(sums[low:high], together, out=sums[low:high])
    else:
        some = slice(*at.searchsorted((low - 1, high - 1)).tolist())
        at = at[some]
        sums[at + 1] = np.maximum(sums[at + 1], sums[at] + row[columns[some]])
    np.maximum.accumulate(sums[low - 1 : high], out=sums[low - 1 : high])


class _Rows:
    """Sizes of subtrees' largest alignments, a left shape's with all right shapes at a place in one row.

    Only nodes at equal places, labels from the root down, are ever aligned. A row ends in a 0, for no shape.
    """

    def __init__(self, root: Node, shapes: _Shapes):
        self.of = shapes.of
        self.shapes = list(shapes.known)  # label and children's shapes, children first
        self.whole: list[int] = []
        for _, *children in self.shapes:
            self.whole.append(1 + sum(self.whole[child] for child in children))
        self.below: dict[tuple, int] = {}
        self.place = {id(root): 0}
        self.columns = [{self.of[id(root)]: 0}]  # by place, of the right shapes there
        todo = [root]
        while todo:
            node = todo.pop()
            here = self.place[id(node)]
            for child in shapes.children[id(node)]:
                place = self.place[id(child)] = self.below.setdefault((here, child.label), len(self.columns))
                if place == len(self.columns):
                    self.columns.append({})
                self.columns[place].setdefault(self.of[id(child)], len(self.columns[place]))
                todo.append(child)
        self.layouts: dict[int, tuple] = {}
        self.kept: dict[tuple[int, int], np.ndarray] = {}
        self.bytes = 0

    def layout(self, place: int) -> tuple:
        """The right shapes' children at a place, list after list, each list after a cell for none of them: what cells start
        from, each list's last cell, and by label the children's cells and columns. Lists start from more than
        those before can reach, so that one running maximum serves all."""
        if place not in self.layouts:
            first, last, cells = [], [], {}
            reach = 0
            for shape in self.columns[place]:
                first.append(reach)
                for child in self.shapes[shape][1:]:
                    label = self.shapes[child][0]
                    at, columns = cells.setdefault(label, ([], []))
                    at.append(len(first) - 1)
                    columns.append(self.columns[self.below[place, label]][child])
                    first.append(reach)
                last.append(len(first) - 1)
                reach += self.whole[shape]
            cells = {label: _cells(at, columns, len(first) - 1) for label, (at, columns) in cells.items()}
            self.layouts[place] = np.array(first, "i4"), np.array(last), cells
        return self.layouts[place]

    def row(self, place: int, shape: int):
        if (place, shape) in self.kept:
            return self.kept[place, shape]
        first, last, cells = self.layout(place)
        sums = first.copy()
        for child in self.shapes[shape][1:]:
            label = self.shapes[child][0]
            if label in cells:
                row = yield self.row(self.below[place, label], child)
                _extend(sums, row, cells[label], 1, len(sums))
        row = np.append(sums[last] - first[last] + 1, np.int32(0))
        if (place, shape) not in self.kept:
            self.kept[place, shape] = row
            self.bytes += row.nbytes
        while self.bytes > ROW_BYTES:
            self.bytes -= self.kept.pop(next(iter(self.kept))).nbytes
        return row

    def size(self, x: Node, y: Node):
        place = self.place[id(y)]
        row = yield self.row(place, self.of[id(x)])
        return int(row[self.columns[place][self.of[id(y)]]])

    def aligned(self, xs: list[Node], ys: list[Node], trace: bool):
        """The pairs, where they are wanted, of two lists' largest alignment and its weight, as cell by cell.

        An alignment of ``floor`` nodes passes only through cells before and after which so many nodes can be aligned: a
        band, narrow where lists are alike. What is reached in a band is reached at all, so the next floor is at least
        that; once a band's floor is reached, the band holds all largest alignments. Of its rows, only some are kept;
        those between are computed again when pairs are traced back.
        """
        shared = {x.label for x in xs} & {y.label for y in ys}
        xs, ys = ([node for node in nodes if node.label in shared] for nodes in (xs, ys))
        if not xs:
            return [], 0
        n, m = len(xs), len(ys)
        found: dict[str, list[int]] = {}
        for j, y in enumerate(ys):
            found.setdefault(y.label, []).append(j)
        labels = {}
        for label, at in found.items():
            place = self.place[id(ys[at[0]])]
            labels[label] = place, _cells(at, [self.columns[place][self.of[id(ys[j])]] for j in at], m)
        before_x = np.cumsum([self.whole[self.of[id(x)]] for x in xs])
        before_y = np.cumsum([0, *(self.whole[self.of[id(y)]] for y in ys)])
        of_x, of_y = int(before_x[-1]), int(before_y[-1])

        def forward(sums: np.ndarray, start: int, end: int, upto: int, every: int, kept: dict[int, tuple[int, np.ndarray]]):
            for i in range(start, end):
                low, high = lows[i], min(highs[i], upto)
                if low < high:
                    place, cells = labels[xs[i].label]
                    row = self.kept.get((place, self.of[id(xs[i])]))
                    if row is None:
                        row = yield self.row(place, self.of[id(xs[i])])
                    _extend(sums, row, cells, low, high)
                if every and (i + 1) % every == 0:
                    kept[i + 1] = low - 1, sums[low - 1 : max(low - 1, high)].copy()

        every = isqrt(n) + 1 if trace else 0
        slack, floor, best = SLACK, max(min(of_x, of_y) - SLACK, 0), -1
        while best < floor:
            lows = np.maximum(np.searchsorted(before_y, before_x - (of_x - floor)), 1).tolist()
            highs = np.searchsorted(before_y, before_x + (of_y - floor), side="right").tolist()
            sums = np.zeros(m + 1, "i4")
            kept = {0: (0, sums.copy())}
            yield forward(sums, 0, n, m + 1, every, kept)
            best = int(sums[-1])
            if best < floor:
                slack *= 4
                floor, best = max(best, min(of_x, of_y) - slack), -1
        pairs, i, j = [], n, m
        while trace and i and j:
            start = (i - 1) // every * every
            at, part = kept[start]
            sums = np.zeros(m + 1, "i4")
            sums[at : at + len(part)] = part
            rows = {start: kept[start]}
            yield forward(sums, start, i, j + 1, 1, rows)

            def reached(i: int, j: int, rows=rows) -> int:
                at, part = rows[i]
                return int(part[j - at]) if 0 <= j - at < len(part) else -1

            while i > start and j:
                here = reached(i, j)
                if reached(i - 1, j) == here:
                    i -= 1
                elif reached(i, j - 1) == here:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((xs[i], ys[j]))
        return pairs, best


def match(a: Node, b: Node, cells: int = CELLS) -> list[tuple[Node, Node]]:
    """Simple tree matching: the largest order-preserving alignment of two trees from the roots down.

    Children of equal shape at both ends of two lists belong together in some largest alignment, so only the lists'
    middle parts are compared, short ones pair by pair. Long lists, and all sizes once ``cells`` pairs are compared, are
    computed a row at once, with the same result.
    """
    shapes = _Shapes()
    shapes.add(a)
    shapes.add(b)
    of, children = shapes.of, shapes.children
    sizes: dict[tuple[int, int], int] = {}
    left = [cells]
    made: list[_Rows] = []

    def rows() -> _Rows:
        if not made:
            made.append(_Rows(b, shapes))
        return made[0]

    def ends(xs: list[Node], ys: list[Node]) -> tuple[int, int]:
        n, most = 0, min(len(xs), len(ys))
        while n < most and of[id(xs[n])] == of[id(ys[n])]:
            n += 1
        m = 0
        while m < most - n and of[id(xs[-1 - m])] == of[id(ys[-1 - m])]:
            m += 1
        return n, m

    def aligned(xs: list[Node], ys: list[Node], trace: bool):
        """The pairs of two lists' largest alignment and its weight."""
        if not xs or not ys:
            return [], 0
        if len(xs) * len(ys) > WIDE:
            return (yield rows().aligned(xs, ys, trace))
        left[0] -= len(xs) * len(ys)
        if len(xs) == len(ys) == 1:
            same = xs[0].label == ys[0].label
            return ([(xs[0], ys[0])], (yield size(xs[0], ys[0]))) if same else ([], 0)
        table = [[0] * (len(ys) + 1)]
        for c in xs:
            row, last = [0], table[-1]
            for j, d in enumerate(ys):
                together = last[j] + (yield size(c, d)) if c.label == d.label else 0
                row.append(max(together, last[j + 1], row[j]))
            table.append(row)
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        return pairs, table[-1][-1]

    counts: dict[int, int] = {}

    def whole(node: Node) -> int:
        """Nodes of a subtree, once for each shape."""
        todo = [(node, False)]
        while todo:
            x, seen = todo.pop()
            shape = of[id(x)]
            if shape in counts:
                continue
            if seen:
                counts[shape] = 1 + sum(counts[of[id(c)]] for c in children[id(x)])
            else:
                todo.append((x, True))
                todo += [(c, False) for c in children[id(x)]]
        return counts[of[id(node)]]

    def size(x: Node, y: Node):
        if of[id(x)] == of[id(y)]:
            return whole(x)
        key = (of[id(x)], of[id(y)])
        if key not in sizes:
            if left[0] <= 0:
                sizes[key] = yield rows().size(x, y)
                return sizes[key]
            xs, ys = children[id(x)], children[id(y)]
            n, m = ends(xs, ys)
            _, weight = yield aligned(xs[n : len(xs) - m], ys[n : len(ys) - m], False)
            sizes[key] = 1 + weight + sum(whole(c) for c in (*xs[:n], *xs[len(xs) - m :]))
        return sizes[key]

    found, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        found.append((x, y))
        xs, ys = children[id(x)], children[id(y)]
        n, m = ends(xs, ys)
        todo += zip(xs[:n], ys[:n])
        todo += zip(xs[len(xs) - m :], ys[len(ys) - m :])
        xs, ys = xs[n : len(xs) - m], ys[n : len(ys) - m]
        if len(xs) == len(ys) == 1:
            todo += [(xs[0], ys[0])] if xs[0].label == ys[0].label else []
        elif xs and ys:
            todo += _run(aligned(xs, ys, True))[0]
    return found


def mark(place: int, text: str) -> int:
    """What a wrapper knows a template text by."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"), place)


def signed(number: int) -> int:
    """An unsigned 64-bit number as Spark's long of the same bits."""
    return number - (1 << 64) if number >> 63 else number


HEADING, CONTAINER = 1, 2
HARD, IN_MAIN = 1, 2


class Spot:
    """A node of an outline: its number in page order; its place stands for its label."""

    __slots__ = ("children", "label", "number")

    def __init__(self, number: int, label: int):
        self.number, self.label, self.children = number, label, []


class Outline:
    """A page's tree without its texts: what a wrapper is induced from. Nodes are in page order, parents first.

    Aligned nodes have equal labels from the root down, so places do for labels and marks for texts.
    """

    __slots__ = ("at", "kinds", "lengths", "marks", "parents", "places", "surroundings", "texts")

    def __init__(self, parents, places, texts, kinds, at, lengths, surroundings, marks):
        self.parents, self.places, self.texts, self.kinds = parents, places, texts, kinds  # by node
        self.at, self.lengths, self.surroundings, self.marks = at, lengths, surroundings, marks  # by block

    @classmethod
    def of(cls, page: str) -> Outline:
        root = parse(page)
        numbers: dict[int, int] = {}
        parents, places, texts, kinds = [], [], [], []
        todo = [(root, -1, 0)]
        while todo:
            node, parent, place = todo.pop()
            number = numbers[id(node)] = len(parents)
            text = node.text
            parents.append(parent)
            places.append(place)
            texts.append(mark(place, text) if text else 0)
            kinds.append(HEADING * (node.tag in HEADINGS) + CONTAINER * (node.tag in CONTAINERS))
            todo += [(child, number, _below(place, child)) for child in reversed(node.children)]
        found = list(blocks(root))
        around = [HARD * b.hard + IN_MAIN * b.in_main for b in found]
        at, lengths = [numbers[id(b.node)] for b in found], [len(b.text) for b in found]
        return cls(parents, places, texts, kinds, at, lengths, around, [mark(b.place, b.text) for b in found])

    #: The lists' types as they are stored.
    STORED = (("parents", "i4"), ("places", "u8"), ("texts", "u8"), ("kinds", "u1"))
    STORED_BLOCKS = (("at", "i4"), ("lengths", "i4"), ("surroundings", "u1"), ("marks", "u8"))

    def pack(self) -> bytes:
        parts = [np.array([len(self.parents), len(self.at)], "i4")]
        parts += [np.array(getattr(self, name), kind) for name, kind in (*self.STORED, *self.STORED_BLOCKS)]
        return b"".join(part.tobytes() for part in parts)

    @classmethod
    def unpack(cls, packed: bytes) -> Outline:
        nodes, texts = np.frombuffer(packed, "i4", 2).tolist()
        lists, start = [], 8
        for stored, n in ((cls.STORED, nodes), (cls.STORED_BLOCKS, texts)):
            for _, kind in stored:
                lists.append(np.frombuffer(packed, kind, n, start).tolist())
                start += n * np.dtype(kind).itemsize
        return cls(*lists)

    def tree(self) -> Spot:
        spots = [Spot(number, place) for number, place in enumerate(self.places)]
        for spot, parent in zip(spots[1:], self.parents[1:]):
            spots[parent].children.append(spot)
        return spots[0]

    def layout(self) -> int:
        """A hash of the places that hold text."""
        places = np.array(sorted({self.places[node] for node in self.at}), "u8")
        return signed(xxhash.xxh3_64_intdigest(places.tobytes()))


def agreed(first: Outline, other: Outline) -> list[tuple[int, int]]:
    """Aligned nodes of two pages that hold the same text."""
    found = ((x.number, y.number) for x, y in match(first.tree(), other.tree()))
    return [(x, y) for x, y in found if first.texts[x] and first.texts[x] == other.texts[y]]


def is_template(same: Any, pages: Any) -> Any:
    """Whether a text that so many pages of a host share is template; of up to nine pages, all must."""
    return same * 10 >= pages * 9


class Judged:
    """What a page says of its host's template: the lengths of its varying and constant texts, places that hold most of
    its varying text and its first varying heading, from the root down, the places of all its texts, each with how many
    of these it is inside, and the places of all containers of text."""

    __slots__ = ("constant", "held", "levels", "places", "slots", "varying")

    def __init__(self, page: Outline, constant: set[int]):
        texts = list(zip(page.at, page.lengths, page.surroundings))
        found = [text for text in texts if text[0] not in constant]
        self.varying = sum(length for _, length, _ in found)
        self.constant = sum(page.lengths) - self.varying
        self.slots = self._slots(page, found)  # place to depth
        order, levels = list(self.slots), [0] * len(page.places)
        for node, (place, parent) in enumerate(zip(page.places, page.parents)):
            level = levels[parent] if node else 0
            levels[node] = level + (level < len(order) and place == order[level])
        inside = {page.places[node]: levels[node] for node in page.at}
        self.places, self.levels = list(inside), list(inside.values())
        filled = set(page.at)
        for node in range(len(page.places) - 1, 0, -1):
            if node in filled:
                filled.add(page.parents[node])
        self.held = {page.places[node] for node in filled if page.kinds[node] & CONTAINER}

    @staticmethod
    def _slots(page: Outline, found: list[tuple[int, int, int]]) -> dict[int, int]:
        kept = [text for text in found if not text[2] & HARD] or found
        heading = next((node for node, _, _ in kept if page.kinds[node] & HEADING), None)
        if heading is None:
            return {}
        masses = [0] * len(page.places)
        for node, length, _ in kept:
            masses[node] += length
        total = sum(masses)
        for node in range(len(masses) - 1, 0, -1):
            masses[page.parents[node]] += masses[node]
        above, node = [], page.parents[heading]
        while node > 0:
            above.append(node)
            node = page.parents[node]
        return {
            page.places[node]: depth
            for depth, node in enumerate(reversed(above))
            if page.kinds[node] & CONTAINER and 2 * masses[node] >= total
        }

    def beside(self, slot: int) -> list[int]:
        """Places of texts outside one of the page's slots."""
        within = list(self.slots).index(slot) + 1
        return [place for place, level in zip(self.places, self.levels) if level < within]


def template_marks(page: Outline, always: set[int]) -> list[int]:
    """Marks of the template texts on a page that lie in no main element."""
    texts = zip(page.at, page.surroundings, page.marks)
    return [known for node, around, known in texts if node in always and not around & IN_MAIN]


def induce(pages: list[str]) -> str:
    """The wrapper of a host as JSON from its pages: places of main slots, those for most pages first, of
    texts ``beside`` them, and ``fixed`` template texts. ``wrappers`` does the same for many hosts with pages in many tasks."""
    rest = []
    for page in set(pages):
        outline = Outline.of(page)
        key = signed(xxhash.xxh64_intdigest(page.encode("utf-8", "replace"), KEY_SEED))
        rest.append((len(outline.pack()), key, outline))
    rest.sort(key=lambda page: page[:2])
    slots, beside, fixed = [], set(), set()
    while len(rest) >= ENOUGH:
        layouts = [outline.layout() for _, _, outline in rest]
        common = Counter(layouts)
        first = rest[layouts.index(max(common, key=lambda layout: (common[layout], layout)))][2]
        pairs = [agreed(first, outline) for _, _, outline in rest]
        same = Counter(x for found in pairs for x, _ in found)
        always = {node for node, n in same.items() if is_template(n, len(rest))}
        judged = [Judged(page[2], {y for x, y in found if x in always}) for page, found in zip(rest, pairs)]
        # pages that hardly differ are copies of one text and tell nothing about its template
        if sum(j.varying for j in judged) <= sum(j.constant for j in judged):
            break
        if len(rest) >= ENOUGH_FIXED:
            fixed.update(template_marks(first, always))
        votes = Counter(place for j in judged for place in j.slots)
        depth = {place: d for j in judged for place, d in j.slots.items()}
        wanted = [place for place, n in votes.items() if n >= ENOUGH and 2 * n >= len(rest)]
        if not wanted:
            break
        slot = max(wanted, key=lambda place: (depth[place], votes[place], signed(place)))
        slots.append(signed(slot))
        beside.update(place for j in judged if slot in j.slots for place in j.beside(slot))
        rest = [page for page, j in zip(rest, judged) if slot not in j.held]
    return json.dumps({"slots": slots, "beside": sorted(map(signed, beside)), "fixed": sorted(map(signed, fixed))})


@lru_cache(maxsize=1024)
def _read(wrapper: str | None) -> tuple[list[int], frozenset[int], frozenset[int]]:
    known = json.loads(wrapper) if wrapper else {}
    slots, beside, fixed = ([n % (1 << 64) for n in known.get(part, ())] for part in ("slots", "beside", "fixed"))
    return slots, frozenset(beside), frozenset(fixed)


def _places(tree: Node) -> set[int]:
    found, todo = set(), [(tree, 0)]
    while todo:
        node, place = todo.pop()
        found.add(place)
        todo += [(child, _below(place, child)) for child in node.children]
    return found


def decide(page: str, wrapper: str | None) -> list[tuple[str, bool, str]]:
    """Each block's text, whether it is main text, and what has decided: ``wrapper`` or ``names``."""
    slots, beside, fixed = _read(wrapper)
    tree = parse(page)
    if len(slots) > 1:
        places = _places(tree)
        slots = [slot for slot in slots if slot in places]
    for slot in slots:  # the first that holds text: a later one may be around it, for pages without it
        found = list(blocks(tree, frozenset([slot])))
        if any(b.in_slot and not b.aside_within for b in found):
            return [
                (b.text, not b.aside_within, "names" if b.aside_within else "wrapper") if b.in_slot
                else (b.text, False, "wrapper") if b.place in beside
                else (b.text, not b.aside, "names")
                for b in found
            ]
    out = []
    for b in blocks(tree):
        template = bool(fixed) and not b.in_main and mark(b.place, b.text) in fixed
        out.append((b.text, not (b.aside or template), "wrapper" if template and not b.aside else "names"))
    return out


def extract(page: str, wrapper: str | None) -> str:
    """The main text of a page, blocks joined by line ends."""
    return "\n".join(text for text, kept, _ in decide(page, wrapper) if kept)


def outlines(pages: DataFrame) -> DataFrame:
    """``(host, key, layout, outline)`` of all pages with markup, once for each different one of a host."""

    @F.pandas_udf("layout long, outline binary")
    def outlined(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [Outline.of(page) for page in batch]
            yield pd.DataFrame({"layout": [o.layout() for o in found], "outline": [o.pack() for o in found]})

    keyed = pages.filter("html is not null").select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("key"), "html")
    return keyed.select("host", "key", outlined("html").alias("of")).select("host", "key", "of.*").dropDuplicates(["host", "key"])


def _agreed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for firsts, others in batches:
        known = {packed: Outline.unpack(packed) for packed in set(firsts)}
        found = (agreed(known[first], Outline.unpack(other)) for first, other in zip(firsts, others, strict=True))
        yield pd.Series([[x for x, _ in pairs] for pairs in found], index=firsts.index, dtype=object)


JUDGED = (
    "varying long, constant long, slots array<long>, depths array<int>, places array<long>, levels array<int>, held array<long>"
)


def _judged(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for firsts, templates, others in batches:
        known = {packed: Outline.unpack(packed) for packed in set(firsts)}
        rows = []
        for first, always, other in zip(firsts, templates, others, strict=True):
            page, template = Outline.unpack(other), set(always.tolist())
            j = Judged(page, {y for x, y in agreed(known[first], page) if x in template})
            slots, places, held = ([signed(place) for place in found] for found in (j.slots, j.places, j.held))
            rows.append((j.varying, j.constant, slots, list(j.slots.values()), places, j.levels, held))
        yield pd.DataFrame(rows, columns=["varying", "constant", "slots", "depths", "places", "levels", "held"])


def _template_marks(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for firsts, templates in batches:
        found = [template_marks(Outline.unpack(f), set(a.tolist())) for f, a in zip(firsts, templates, strict=True)]
        yield pd.Series([[signed(known) for known in marks] for marks in found], index=firsts.index, dtype=object)


def _sized(frame: DataFrame, pages: DataFrame, *wide: str) -> Lookup:
    """``frame`` as a lookup by host of ``pages``; hot hosts are looked for where it is too large to be broadcast."""
    of_row = sum((F.coalesce(F.length(column), F.lit(0)) for column in ("host", *wide)), F.lit(0))
    n, size = frame.agg(F.count(F.lit(1)), F.coalesce(F.sum(of_row), F.lit(0))).first()
    fits = n <= CHOSEN_ROWS and size <= WRAPPER_BYTES
    return Lookup(frame, n, fits, None if fits else hot_keys(SALTS, pages=(pages, "host"))["pages"])


def wrappers(pages: DataFrame, work: Workspace) -> DataFrame:
    """``(host, wrapper)`` as ``induce`` gives it for all pages of each host; hosts of which nothing is known are left out.

    Every page is parsed once, where it lies, and goes on as its outline. A round aligns every page of a host with one
    of its most common layout, counts over all of them which texts are template, has each page name its main slots and
    counts these. Pages that have the chosen slot are done; the others go into the next round. A slot takes half of a
    host's pages at least, so rounds grow with the logarithm of the pages. What is counted is grouped by host and node
    or place, so no task has to hold the pages of a host.
    """
    align = F.pandas_udf(_agreed, "array<int>")
    judge = F.pandas_udf(_judged, JUDGED)
    marks = F.pandas_udf(_template_marks, "array<long>")
    known = work.keep(outlines(pages), "outlines")
    rest = known.select("host", "key", "layout", F.length("outline").alias("size"))
    current = known.select("host", "key", "layout", "outline")
    facts = []

    def note(part: str, values: DataFrame) -> None:
        facts.append(values.select("host", F.lit(part).alias("part"), F.lit(turn).alias("turn"), "value"))

    for turn in count():
        layouts = rest.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("size", "key")).alias("least"))
        common = F.max_by("least", F.struct("n", "layout"))["key"]
        hosts = layouts.groupBy("host").agg(F.sum("n").alias("pages"), common.alias("key")).filter(F.col("pages") >= ENOUGH)
        hosts = work.keep(hosts, f"hosts{turn}")
        n_hosts = hosts.count()
        if not n_hosts:
            break
        side = F.broadcast(hosts) if n_hosts <= CHOSEN_ROWS else hosts
        first = current.join(side, ["host", "key"]).select("host", "pages", F.col("outline").alias("first"))
        first = work.keep(first, f"first{turn}")
        aligned = attach(current, _sized(first, current, "first"), ["host"], SALTS)
        same = aligned.select("host", "pages", F.explode(align("first", "outline")).alias("node"))
        same = same.groupBy("host", "pages", "node").agg(F.count(F.lit(1)).alias("n"))
        always = same.filter(is_template(F.col("n"), F.col("pages"))).groupBy("host").agg(F.collect_list("node").alias("always"))
        template = first.join(always, "host", "left").withColumn("always", F.coalesce("always", F.array().cast("array<int>")))
        template = work.keep(template, f"template{turn}")
        aligned = attach(current, _sized(template, current, "first"), ["host"], SALTS)
        size = F.length("outline").alias("size")
        judged = aligned.select("host", "key", "layout", "pages", size, judge("first", "always", "outline").alias("of"))
        judged = work.keep(judged.select("host", "key", "layout", "pages", "size", "of.*"), f"judged{turn}")
        varied = judged.groupBy("host").agg(F.sum("varying").alias("varying"), F.sum("constant").alias("constant"))
        # pages that hardly differ are copies of one text and tell nothing about its template
        varied = varied.filter("varying > constant").select("host")
        votes = judged.select("host", "pages", F.explode(F.arrays_zip("slots", "depths")).alias("of")).select("host", "pages", "of.*")
        votes = votes.groupBy("host", "pages", "slots").agg(F.count(F.lit(1)).alias("n"), F.max("depths").alias("depth"))
        votes = votes.filter((F.col("n") >= ENOUGH) & (F.col("n") * 2 >= F.col("pages")))
        slots = votes.groupBy("host").agg(F.max_by("slots", F.struct("depth", "n", "slots")).alias("slot"))
        chosen = work.keep(varied.join(slots, "host", "left"), f"chosen{turn}")
        fixed = template.filter(F.col("pages") >= ENOUGH_FIXED).join(chosen.select("host"), "host", "left_semi")
        note("fixed", fixed.select("host", F.explode(marks("first", "always")).alias("value")))
        chosen = chosen.filter("slot is not null")
        note("slots", chosen.select("host", F.col("slot").alias("value")))
        told = attach(judged, _sized(chosen, judged), ["host"], SALTS)
        within = F.array_position("slots", F.col("slot"))
        spots = F.filter(F.arrays_zip("places", "levels"), lambda spot: spot["levels"] < within)
        outside = told.filter(within > 0).select("host", F.explode(spots).alias("spot"))
        note("beside", work.keep(outside.select("host", F.col("spot.places").alias("value")).distinct(), f"beside{turn}"))
        rest = work.keep(told.filter(~F.array_contains("held", F.col("slot"))).select("host", "key", "layout", "size"), f"rest{turn}")
        left = rest.select("host", "key")
        side = F.broadcast(left) if left.count() <= CHOSEN_ROWS else left
        current = known.select("host", "key", "layout", "outline").join(side, ["host", "key"], "left_semi")
    if not facts:
        return known.select("host", F.lit("").alias("wrapper")).limit(0)
    of = lambda part, value: F.when(F.col("part") == part, value)
    slots = F.array_sort(F.collect_list(of("slots", F.struct("turn", "value"))))["value"].alias("slots")
    texts = [F.array_sort(F.collect_set(of(part, F.col("value")))).alias(part) for part in ("beside", "fixed")]
    found = reduce(DataFrame.unionByName, facts).groupBy("host").agg(slots, *texts)
    return found.select("host", F.to_json(F.struct("slots", "beside", "fixed")).alias("wrapper"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``text`` instead of ``html``."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, wrapper in batches:
            texts = [extract(p, w) for p, w in zip(page.fillna(""), wrapper.where(wrapper.notna(), None), strict=True)]
            yield pd.Series(texts, index=page.index, dtype=object)

    pages = pages.select("page_id", "url", "html")
    work = Workspace(pages.sparkSession)
    known = work.keep(wrappers(pages, work), "wrappers")
    n, size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("wrapper") + F.length("host")), F.lit(0))).first()
    lookup = Lookup(known, n, size <= WRAPPER_BYTES)
    joined = attach(pages.withColumn("host", host(F.col("url"))), lookup, ["host"], SALTS, "left")
    return joined.select("page_id", "url", extracted("html", "wrapper").alias("text"))


def digest(pages: DataFrame) -> DataFrame:
    return extract_pages(pages).withColumn("n_chars", F.char_length("text").cast("long"))
