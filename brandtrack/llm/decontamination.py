"""Finding passages of benchmark items in documents.

A document is compared with an item in windows of the item's own number of words. Each window has a SimHash
fingerprint, 256 bits, of its word shingles. The items' fingerprints are indexed by sixteen blocks of sixteen bits: two
fingerprints within ``RADIUS`` = 63 bits agree in some block but for three bits at most. A block's table has each item
under its value and under all values one bit away, and a window looks up its value and all values two bits
away, so every item within the radius is found; of two unlike fingerprints one in six meets in some block. What is within the radius
is verified by the exact weighted Jaccard similarity of the window's and the item's shingles: a shingle counts as
often as it occurs, times its weight, the letters in its words. At a similarity of 0.8 fingerprints differ in 39 bits, 6
more or less, so the radius leaves out none in practice.

A window without any shingle of an item of its size has similarity 0 to all of them. So fingerprints are taken only of windows that
have one; the others need no work, and no alike window is among them.

Items are taken in blocks of ``ITEM_BLOCK`` and ``ITEM_BYTES`` at most, each once however often it is repeated, and an
index of more than ``INDEX_BYTES`` is split; tasks hold one index, never the documents'.

Defined results: words are runs of letters, digits and underscores in lower case, shingles five words, or the whole
item if it is shorter; null or wordless items and texts match nothing; repeated documents match each, repeated items
once; an empty table gives an empty result; a text shorter than an item is its only window. Other columns are not read by
``matches`` and pass through ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N = 5
SIMILAR = 0.8
RADIUS = 63
#: 64-bit words of a fingerprint, its blocks of 16 bits, and the bits that an item's and a window's lookups may flip.
WORDS, BLOCKS, BLOCK_BITS = 4, 16, 16
ITEM_FLIPS, WINDOW_FLIPS = 1, 2
ITEM_BLOCK = 20_000
ITEM_BYTES = 32 << 20
INDEX_BYTES = 128 << 20
WORD = re.compile(r"\w+")
ODD = np.uint64(0x9E3779B185EBCA87)
S29, S31 = np.uint64(29), np.uint64(31)
BITS = np.arange(64, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        self[word] = value
        return value


class Shingler:
    """Hashes of runs of ``N`` words; ``n`` words where a text has no more."""

    def __init__(self, known: int = 400_000):
        self.hashes, self.known = _WordHashes(), known

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and lengths of a text's words."""
        if len(self.hashes) > self.known:
            self.hashes.clear()
        found = WORD.findall(text.lower())
        hashes = np.fromiter(map(self.hashes.__getitem__, found), dtype=np.uint64, count=len(found))
        return hashes, np.fromiter(map(len, found), dtype=np.int64, count=len(found))

    @staticmethod
    def shingles(words: np.ndarray, lengths: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and weights of the runs of ``n`` words."""
        if words.size < n:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        mixed = np.full(words.size - n + 1, n, dtype=np.uint64)
        for k in range(n):
            mixed = (mixed ^ words[k : words.size - n + 1 + k]) * ODD
            mixed ^= mixed >> S29
        letters = np.concatenate([[0], np.cumsum(lengths)])
        return mixed, letters[n:] - letters[:-n]


def signs(shingles: np.ndarray) -> np.ndarray:
    """Bits of shingles as +1 and -1, one row each."""
    out = np.empty((shingles.size, 64 * WORDS), dtype=np.int64)
    mixed = shingles
    for k in range(WORDS):
        mixed = (mixed ^ (mixed >> S31)) * ODD
        mixed ^= mixed >> S29
        out[:, 64 * k : 64 * k + 64] = ((mixed[:, None] >> BITS) & np.uint64(1)).astype(np.int64) * 2 - 1
    return out


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of bit sums, ``WORDS`` numbers each."""
    bits = (sums > 0).reshape(len(sums), WORDS, 64).astype(np.uint64)
    return (bits << BITS).sum(axis=2, dtype=np.uint64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _flips(most: int) -> np.ndarray:
    """What flips of up to so many bits do to a block."""
    one = [1 << k for k in range(BLOCK_BITS)]
    return np.array([sum(bits) for n in range(most + 1) for bits in combinations(one, n)], dtype=np.uint16)


class BlockTable:
    """One block's table: the items under each value that is theirs but for ``ITEM_FLIPS`` bits."""

    def __init__(self, values: np.ndarray):
        near = (values[:, None] ^ _flips(ITEM_FLIPS)[None, :]).ravel()
        order = np.argsort(near, kind="stable")
        self.items = np.repeat(np.arange(len(values), dtype=np.int32), near.size // max(1, len(values)))[order]
        self.begins = np.searchsorted(near[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32)

    def look_up(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a place in ``values`` and an item that is near it."""
        probes = (values[:, None] ^ _flips(WINDOW_FLIPS)[None, :]).astype(np.int64)
        low, high = self.begins[probes], self.begins[probes + 1]
        at, probe = np.nonzero(high > low)
        n = (high - low)[at, probe]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.items[np.repeat(low[at, probe], n) + within]


@dataclass
class Items:
    """Shingles, fingerprints and the block tables of some items."""

    ids: list
    n_words: np.ndarray
    #: words of the items' shingles
    n: np.ndarray
    bags: list[Counter]
    #: sorted shingles of all items, by the number of their words, and of the items of each size
    known: dict[int, np.ndarray]
    of_size: dict[int, np.ndarray]
    totals: np.ndarray
    prints: np.ndarray
    tables: list[BlockTable]

    @property
    def nbytes(self) -> int:
        """About what tasks are sent."""
        tables = sum(t.items.nbytes + t.begins.nbytes for t in self.tables)
        shingles = sum(a.nbytes for a in (*self.known.values(), *self.of_size.values()))
        return tables + self.prints.nbytes + shingles + 16 * sum(map(len, self.bags))

    def near(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items of a size whose fingerprints are within the radius, as the tables find them."""
        blocks = prints.view(np.uint16)
        pairs = [np.zeros(0, dtype=np.int64)]
        for k, table in enumerate(self.tables):
            window, item = table.look_up(blocks[:, k])
            own = self.n_words[item] == size
            pairs.append(np.unique(window[own] * len(self.ids) + item[own]))
        window, item = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.ids)))
        close = distance(prints[window], self.prints[item]) <= RADIUS
        return window[close], item[close]


def index_items(rows: list[tuple]) -> Items:
    """``rows`` are ``(item_id, text)``."""
    shingler = Shingler()
    words = [(i, *shingler.words(text or "")) for i, text in rows]
    words = [row for row in words if row[1].size]
    n_words = np.array([w.size for _, w, _ in words], dtype=np.int64)
    n = np.minimum(n_words, N)
    cut = [Shingler.shingles(w, lengths, int(k)) for (_, w, lengths), k in zip(words, n, strict=True)]
    bags = [Counter(shingles.tolist()) for shingles, _ in cut]

    def shingles_by(number: np.ndarray) -> dict[int, np.ndarray]:
        by: dict[int, list[np.ndarray]] = {}
        for (shingles, _), m in zip(cut, number.tolist(), strict=True):
            by.setdefault(m, []).append(shingles)
        return {m: np.unique(np.concatenate(own)) for m, own in sorted(by.items())}

    totals = np.array([int(weight.sum()) for _, weight in cut], dtype=np.int64)
    prints = np.zeros((len(cut), WORDS), dtype=np.uint64)
    for k, (shingles, weight) in enumerate(cut):
        prints[k] = packed((signs(shingles) * weight[:, None]).sum(axis=0, keepdims=True))[0]
    tables = [BlockTable(prints.view(np.uint16)[:, block]) for block in range(BLOCKS)]
    return Items([row[0] for row in words], n_words, n, bags, shingles_by(n), shingles_by(n_words), totals, prints, tables)


def _similarity(bag: Counter, total: int, shingles: np.ndarray, weight: np.ndarray) -> float:
    """Weighted Jaccard similarity of an item's bag and a window's shingles."""
    common = 0
    seen: Counter = Counter()
    for s, w in zip(shingles.tolist(), weight.tolist(), strict=True):
        seen[s] += 1
        if seen[s] <= bag.get(s, 0):
            common += w
    return common / (total + int(weight.sum()) - common)


def find(text: str, items: Items, shingler: Shingler) -> list[tuple[int, int, int, float]]:
    """Per item with an alike window: its place among the items, the best window's first word, bits, similarity."""
    words, lengths = shingler.words(text)
    found = []
    for n, known in items.known.items():
        shingles, weight = Shingler.shingles(words, lengths, n)
        hits = _among(known, shingles)
        if not hits.size:
            continue
        for size, own in items.of_size.items():
            if min(size, N) == n and (of_size := hits[_among(own, shingles[hits])]).size:
                found += _best_windows(words.size, shingles, weight, of_size, size, n, items)
    return sorted(found)


def _among(known: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Places of the shingles that are known ones."""
    if not shingles.size:
        return np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, shingles), known.size - 1)
    return np.flatnonzero(known[at] == shingles)


def _best_windows(
    n_words: int, shingles: np.ndarray, weights: np.ndarray, hits: np.ndarray, size: int, n: int, items: Items
) -> list[tuple[int, int, int, float]]:
    """For items of a size, the most alike window of those that hold one of the hits; the first of equals."""
    wide = min(size, n_words) - n + 1
    starts = np.unique(np.clip(hits[:, None] - np.arange(wide)[None, :], 0, n_words - (wide + n - 1)))
    best: dict[int, tuple[int, int, float]] = {}
    # runs of neighbouring windows share their sums; long ones are taken in parts
    for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
        for part in np.split(run, range(1024, run.size, 1024)):
            low = int(part[0])
            own = shingles[low : int(part[-1]) + wide]
            weight = weights[low : int(part[-1]) + wide]
            sums = np.concatenate([np.zeros((1, 64 * WORDS), dtype=np.int64), np.cumsum(signs(own) * weight[:, None], axis=0)])
            prints = packed(sums[part - low + wide] - sums[part - low])
            for window, k in zip(*(x.tolist() for x in items.near(prints, size))):
                first = int(part[window]) - low
                covered = slice(first, first + wide)
                alike = _similarity(items.bags[k], items.totals[k], own[covered], weight[covered])
                if alike >= SIMILAR and (k not in best or alike > best[k][2]):
                    best[k] = (int(part[window]), int(distance(prints[window], items.prints[k])), float(alike))
    return [(k, *match) for k, match in best.items()]


FOUND = "array<struct<item_id:bigint,first_word:bigint,bits:int,similarity:double>>"


def passages(text: Column, items: Items) -> Column:
    """The alike windows of a text."""

    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shingler = Shingler()
        for batch in batches:
            found = [
                [
                    {"item_id": items.ids[k], "first_word": at, "bits": bits, "similarity": alike}
                    for k, at, bits, alike in find(text, items, shingler)
                ]
                for text in batch.fillna("")
            ]
            yield pd.Series(found, index=batch.index, dtype=object)

    return search(text)


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in indexes that fit the driver and the tasks."""
    known = benchmark.select("item_id", "text").filter("text is not null").distinct()
    n, size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(1, -(-n // ITEM_BLOCK), -(-size // ITEM_BYTES))
    for block in range(n_blocks):
        part = known if n_blocks == 1 else known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        rows = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
        yield from _indexes(rows)


def _indexes(rows: list[tuple]) -> Iterator[Items]:
    """The rows' index, or those of their halves where it is too large to be sent to the tasks."""
    items = index_items(rows)
    if items.nbytes <= INDEX_BYTES or len(rows) < 2:
        yield items
        return
    half = len(rows) // 2
    yield from _indexes(rows[:half])
    yield from _indexes(rows[half:])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, first_word, bits, similarity)``: the best window of each document and item that are alike."""
    parts = [
        docs.select("doc_id", F.inline(passages(F.col("text"), items))) for items in item_blocks(benchmark)
    ]
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an alike window, with all their columns."""
    for items in item_blocks(benchmark):
        docs = docs.filter(F.size(passages(F.col("text"), items)) == 0)
    return docs


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return matches(docs, benchmark)
