"""A quality classifier: histogram gradient-boosted trees over statistics of a document.

Tasks turn texts into statistics; labels, ids, languages and sources never enter. The trees are fitted in numpy on
the driver from the statistics of at most ``TRAIN_ROWS`` labelled documents, the ones whose ids hash lowest among
those not held out. A fitted model is three arrays of one row per tree, and all trees of a batch of documents are
walked at once.

Defined results: a null or empty text has statistics, all 0 but its share of distinct words, and a score; a null id
is not held out and never trained on; several labels of a document count each, and of several texts of one id the
least is trained on; without labels of both kinds every score is the share of label 1, or 0.5 without labels;
repeated rows are scored each; other columns are not read by ``digest`` and pass through ``add_score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the training sample, in documents.
TRAIN_ROWS = 20_000
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
#: Least sum of second derivatives in a leaf, and the weight that draws leaves to 0.
LEAST_CURVATURE = 2.0
SHRINK = 1.0
THRESHOLD = 0.3

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word",
    "same_as_previous", "distinct_pairs", "distinct_fives", "log_lines", "repeated_lines", "words_per_line",
    "upper", "digits", "symbols", "bangs", "bars", "periods", "commas", "spaces", "beyond_ascii", "entropy",
    "symbols_per_word", "bangs_per_word", "words_in_repeats",
)
SYMBOL_BYTES = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
#: Odd constants that mix word codes into n-gram codes.
MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A code for each run of ``n`` words."""
    mixed = np.zeros(codes.size - n + 1, dtype=np.uint64)
    for k in range(n):
        mixed = (mixed ^ (codes[k : codes.size - n + 1 + k] + np.uint64(k + 1))) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def statistics(text: str) -> np.ndarray:
    """The document's statistics in the order of ``STATISTICS``."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    seen = np.bincount(data, minlength=256).astype(np.float64)
    n = max(1, data.size)
    words = text.split()
    n_words = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    codes = codes.astype(np.uint64)
    pairs = np.unique(_grams(codes, 2)).size / (codes.size - 1) if codes.size > 1 else 1.0
    fives, repeats = 1.0, 0.0
    if codes.size > 4:
        _, inverse, times = np.unique(_grams(codes, 5), return_inverse=True, return_counts=True)
        fives = times.size / inverse.size
        repeats = float(np.mean(times[inverse] > 1))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    n_lines = max(1, len(lines))
    shares = seen[seen > 0] / n
    symbols, bangs = seen[SYMBOL_BYTES].sum(), seen[ord("!")]
    return np.array(
        [
            np.log1p(data.size),
            np.log1p(len(words)),
            lengths.mean(),
            lengths.std(),
            len(distinct) / n_words if words else 1.0,
            np.bincount(codes.astype(np.int64)).max() / n_words if words else 0.0,
            np.mean(codes[1:] == codes[:-1]) if codes.size > 1 else 0.0,
            pairs,
            fives,
            np.log1p(len(lines)),
            1.0 - len(set(lines)) / n_lines if lines else 0.0,
            len(words) / n_lines,
            seen[65:91].sum() / n,
            seen[48:58].sum() / n,
            symbols / n,
            bangs / n,
            seen[ord("|")] / n,
            seen[ord(".")] / n,
            seen[ord(",")] / n,
            seen[32] / n,
            seen[128:].sum() / n,
            -(shares * np.log2(shares)).sum(),
            symbols / n_words,
            bangs / n_words,
            repeats,
        ]
    )


@dataclass(frozen=True)
class Trees:
    """Complete trees of depth ``DEPTH`` in heap order: node ``i`` has children ``2i + 1`` and ``2i + 2``.

    A row goes right where its statistic is above the threshold; a node that isn't split sends all left.
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        n_trees = self.feature.shape[0]
        if not n_trees:
            return np.full(x.shape[0], 1.0 / (1.0 + np.exp(-self.base)))
        tree = np.arange(n_trees)[None, :]
        node = np.zeros((x.shape[0], n_trees), dtype=np.int64)
        rows = np.arange(x.shape[0])[:, None]
        for _ in range(DEPTH):
            right = x[rows, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        total = self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-(self.base + total)))


def constant(share: float) -> Trees:
    none = np.zeros((0, 1))
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Trees(float(np.log(share / (1 - share))), none.astype(np.int64), none, none)


def _best_split(grad: np.ndarray, curv: np.ndarray) -> tuple[float, int, int]:
    """Gain, statistic and bin of the best split from histograms (statistic, bin): rows up to the bin go left."""
    left_g, left_c = grad.cumsum(axis=1)[:, :-1], curv.cumsum(axis=1)[:, :-1]
    all_g, all_c = grad.sum(axis=1, keepdims=True), curv.sum(axis=1, keepdims=True)
    right_g, right_c = all_g - left_g, all_c - left_c
    gain = left_g**2 / (left_c + SHRINK) + right_g**2 / (right_c + SHRINK) - all_g**2 / (all_c + SHRINK)
    gain[(left_c < LEAST_CURVATURE) | (right_c < LEAST_CURVATURE)] = -np.inf
    at = int(np.argmax(gain))
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees on the logistic loss; each statistic is cut at quantiles into ``BINS`` bins."""
    if len(y) == 0 or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], axis=1)
    offset = binned + np.arange(width) * BINS
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros((TREES, inner), dtype=np.int64)
    threshold = np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, leaves))
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    for t in range(TREES):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, curv = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for i in range(inner):
            mine = np.flatnonzero(node == i)
            if mine.size == 0:
                continue
            flat = offset[mine].ravel()
            g = np.bincount(flat, np.repeat(grad[mine], width), width * BINS).reshape(width, BINS)
            c = np.bincount(flat, np.repeat(curv[mine], width), width * BINS).reshape(width, BINS)
            gain, j, cut = _best_split(g, c)
            right = np.zeros(mine.size, dtype=bool)
            if gain > 1e-9 and cut < cuts[j].size:
                feature[t, i], threshold[t, i] = j, cuts[j][cut]
                right = binned[mine, j] > cut
            node[mine] = 2 * i + 1 + right
        at = node - inner
        top = np.bincount(at, grad, leaves)
        bottom = np.bincount(at, curv, leaves)
        leaf[t] = -RATE * top / (bottom + SHRINK)
        margin += leaf[t][at]
    return Trees(base, feature, threshold, leaf)


def held_out(doc_id: Column) -> Column:
    """Ids whose checksum is divisible by 5: never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """A model from the labelled documents that are not held out."""

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics(text) for text in batch.fillna("")], index=batch.index, dtype=object)

    usable = labels.select("doc_id", "quality").filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    drawn = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id", "left_semi")  # TRAIN_ROWS ids at most
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
    )
    known = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "quality", measured("text").alias("x"))
    sample = sorted(known.collect(), key=lambda row: (row["doc_id"], row["quality"]))
    x = np.array([row["x"] for row in sample], dtype=np.float64).reshape(len(sample), len(STATISTICS))
    return fit(x, np.array([row["quality"] for row in sample], dtype=np.float64))


def score(text: Column, model: Trees) -> Column:
    """Likelihood of label 1 of each text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = [statistics(text) for text in batch.fillna("")]
            x = np.array(x, dtype=np.float64).reshape(len(batch), len(STATISTICS))
            found = [model.score(x[i : i + 512]) for i in range(0, len(x), 512)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0), index=batch.index)

    return scored(text)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier does not reject."""
    return docs.filter(score(F.col("text"), train(docs, labels)) >= THRESHOLD)
