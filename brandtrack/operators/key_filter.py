"""Bloom filters as columns: a large table cut to the keys of another before it is shuffled.

A filter is a table of words of 64 bits. A key's hash names a word and four bits in it; a row may hold a known key only
if all four are set. Filters never lose a key; of other keys a few in a thousand pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
#: With fewer bits a filter passes too much to be worth its broadcast.
LEAST_BITS = 4
WORD = 64
#: Words that are kept together in one row of the filter, which has 8 KB.
CHUNK = 1024
PROBES = 4


def _place(key: Column, n_words: int) -> tuple[Column, Column]:
    """A key's word and its bits there."""
    word = F.pmod(F.xxhash64(key), F.lit(n_words))
    more = F.xxhash64(key, F.lit("bits"))
    bits = []
    for i in range(PROBES):
        at = F.shiftrightunsigned(more, 6 * i).bitwiseAND(F.lit(WORD - 1)).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return word, reduce(Column.bitwiseOR, bits)


def n_words(n_keys: int, most_bytes: int) -> int | None:
    """Words of a filter for so many keys, within a size; None where that is too small for them."""
    wanted = max(1, -(-n_keys * BITS_PER_KEY // WORD))
    most = most_bytes * 8 // WORD
    if wanted > most and most * WORD < LEAST_BITS * n_keys:
        return None
    return min(wanted, most)


def key_filter(keys: DataFrame, column: str, words: int) -> DataFrame:
    """The filter of a column's keys: ``(chunk, words)``, ``8 * words`` bytes in all at most."""
    word, bits = _place(F.col(column), words)
    set_bits = keys.groupBy(word.alias("word")).agg(F.bit_or(bits).alias("bits"))
    chunk, at = F.floor(F.col("word") / CHUNK).alias("chunk"), (F.col("word") % CHUNK).cast("int")
    known = set_bits.groupBy(chunk).agg(F.map_from_entries(F.collect_list(F.struct(at, "bits"))).alias("known"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda i: F.coalesce(F.col("known")[i], F.lit(0).cast("long")))
    return known.select("chunk", dense.alias("words"))


def may_hold(rows: DataFrame, column: str, filter_: DataFrame, words: int) -> DataFrame:
    """The rows whose key may be among the filter's; the filter is broadcast, so no row moves."""
    word, bits = _place(F.col(column), words)
    probed = rows.withColumns({"_word": word, "_bits": bits})
    chunks = filter_.withColumnsRenamed({"chunk": "_chunk", "words": "_words"})
    at = (F.col("_word") % CHUNK + 1).cast("int")
    found = probed.join(F.broadcast(chunks), F.floor(F.col("_word") / CHUNK) == F.col("_chunk"))
    held = F.element_at("_words", at).bitwiseAND(F.col("_bits")) == F.col("_bits")
    return found.filter(held).select(rows.columns)
