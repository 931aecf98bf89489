"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging.

Texts are cut into pre-tokens. The distinct pre-tokens of a batch lie in one ragged numpy array of symbols, and in
each round every sequence merges its own lowest-rank pair, all sequences at once, until no pair of any sequence
has a rank. A pre-token's count is the number of symbols left.

Defined results: a null or empty text has no tokens; special strings in a text are one token each, as the
library does by default; repeated rows are counted each; an empty table gives an empty result; columns other than
the id and the text are not read. Whole texts are counted, whatever their length: a batch of texts is worked off
in blocks of about ``BLOCK_CHARS`` characters, and the pre-tokens whose count is kept for later texts are
limited to ``KNOWN`` short ones; others are merged anew.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The vocabulary's own pre-token pattern: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_CHARS = 2_000_000
KNOWN = 300_000
KNOWN_CHARS = 64
NO_RANK = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Merges:
    """A vocabulary's merges in order of their pairs, ready for binary search."""

    byte_ids: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    n_symbols: int
    specials: tuple[str, ...]


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones for themselves, then 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_merges(path: str) -> Merges:
    """A ``tokenizers`` file of a byte-level BPE without options that change its merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, splitter = spec["model"], spec["pre_tokenizer"]
    plain = (
        model["type"] == "BPE"
        and splitter == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        and spec["normalizer"] is None
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix", "byte_fallback"))
    )
    if not plain:
        raise ValueError(f"{path}: not a plain byte-level BPE")
    ids = model["vocab"]
    rules = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    n = max(ids.values()) + 1
    keys = np.array([ids[a] * n + ids[b] for a, b in rules], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    return Merges(
        byte_ids=np.array([ids[letter] for letter in _byte_letters()], dtype=np.int64),
        pairs=keys[order],
        ranks=order.astype(np.int64),
        merged=np.array([ids[a + b] for a, b in rules], dtype=np.int64)[order],
        n_symbols=n,
        specials=tuple(t["content"] for t in spec["added_tokens"]),
    )


def count_symbols(pieces: list[bytes], merges: Merges) -> np.ndarray:
    """Symbols left of each piece after all merges."""
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    counts = lengths.copy()
    symbols = merges.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    while symbols.size > 1:
        keys = symbols[:-1] * merges.n_symbols + symbols[1:]
        at = np.minimum(np.searchsorted(merges.pairs, keys), merges.pairs.size - 1)
        ranked = (merges.pairs[at] == keys) & (owner[:-1] == owner[1:])
        rank = np.where(ranked, merges.ranks[at], NO_RANK)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        best = np.minimum.reduceat(np.r_[rank, NO_RANK], starts)
        sizes = np.diff(np.r_[starts, symbols.size])
        chosen = ranked & (rank == np.repeat(best, sizes)[:-1])
        hits = np.flatnonzero(chosen)
        if not hits.size:
            break
        # of overlapping pairs, as in a run of one symbol, every second counts from the left
        run = np.r_[True, np.diff(hits) > 1]
        first = hits[np.maximum.accumulate(np.where(run, np.arange(hits.size), 0))]
        hits = hits[(hits - first) % 2 == 0]
        symbols[hits] = merges.merged[at[hits]]
        left = np.ones(symbols.size, dtype=bool)
        left[hits + 1] = False
        counts -= np.bincount(owner[hits], minlength=counts.size)
        # sequences without a ranked pair are done
        left &= np.repeat(best != NO_RANK, sizes)
        symbols, owner = symbols[left], owner[left]
    return counts


class Counter:
    """Counts of texts; remembers those of short pre-tokens."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.split = regex.compile(PATTERN).findall
        self.specials = regex.compile("|".join(map(regex.escape, merges.specials))) if merges.specials else None
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens and the number of special strings between them."""
        if self.specials is None or not self.specials.search(text):
            return self.split(text), 0
        parts = self.specials.split(text)
        return [piece for part in parts for piece in self.split(part)], len(parts) - 1

    def learn(self, pieces: set[str]) -> dict[str, int]:
        """Counts of pieces that aren't known yet; the short ones are kept."""
        new = list(pieces)
        if not new:
            return {}
        counts = count_symbols([piece.encode() for piece in new], self.merges).tolist()
        found = dict(zip(new, counts, strict=True))
        short = {piece: n for piece, n in found.items() if len(piece) <= KNOWN_CHARS}
        if len(self.known) + len(short) > KNOWN:
            self.known.clear()
        if len(short) <= KNOWN:
            self.known.update(short)
        return found

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.pre_tokens(text) for text in texts]
        seen = set().union(*(pieces for pieces, _ in cut))
        before = {piece: n for piece in seen if (n := self.known.get(piece)) is not None}
        of = before | self.learn(seen - before.keys())
        return [sum(map(of.__getitem__, pieces)) + specials for pieces, specials in cut]


def blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``most`` characters; a longer text is a list of its own."""
    block: list[str] = []
    size = 0
    for text in texts:
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def token_count(text: Column, merges: Merges) -> Column:
    """Tokens of a text column; rows with equal texts in one batch are counted once."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(merges)
        for batch in batches:
            codes, texts = pd.factorize(batch.fillna(""))
            found = [n for block in blocks(list(texts)) for n in counter.count(block)]
            yield pd.Series(np.array(found, dtype=np.int64)[codes], index=batch.index)

    return counted(text)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document. ``path`` is read on the driver; tasks get the merges, about 1.5 MB."""
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text_col), read_merges(path)).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
