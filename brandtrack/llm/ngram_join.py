"""Documents whose sets of word n-grams are alike: a Jaccard join by universe partition.

Two sets of at most ``hi`` members that are alike enough differ in at most ``H`` of them. Members are hashed into
segments; ``H + 1`` segments can't all differ, and a segment that is compared with its one-deletion neighbourhood
counts twice, as it has to differ in two members. So each set is indexed by its segments, some of them with all
one-deletion neighbours, and every pair that is alike meets at one signature at least. Sets are cut by size band,
as ``H`` depends on the size; a set that may be alike to sets of the next band is cut by its scheme too.

Allocation is by cost: per band, from the number of its sets, how many segments get one-deletion neighbourhoods.
Schemes have a few spare segments, so that signatures which very many sets share can be left out: a set that has
``H + 1`` others needs none of them, and a pair of which one set has ``H + 1`` others meets at one of these.
Pairs that meet are filtered by size and by sketches that bound the difference from below, and verified exactly.

Equal sets are one class before anything is compared. Of the sets that share a signature each is compared with one
leader first, as long as that brings many of them together, so a large group of near copies costs a few comparisons
per set; then the sets in different components are compared, in blocks and by sketch, where they lie.

Defined results: words and links as in ``NgramSets``; a null text or one without words has an empty set, is
linked with nothing and is its own component; a document is its id: several texts of one id count as sets of one
document, and repeated rows get the same component each; a null id has no component and links nothing; an empty
table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .tables import Workspace, small_batches

P1, P2, P3 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
S17, S29, S32, S56 = np.uint64(17), np.uint64(29), np.uint64(32), np.uint64(56)
#: Least number of parts of a sketch.
LEAST_SKETCH = 256
PARTS = 4
#: A signature of more sets than this is left out where a set has enough others.
HOT = 64
#: Ids up to this number are broadcast to the documents.
ID_BOUND = 1_000_000
#: The cost of a comparison in signatures, the share of sets that have text in common by chance, and how much.
COMPARE, RELATED, CHANCE = 0.1, 0.02, 0.3
#: Signatures that a task packs at once, that a bucket holds about, and that a task of the next step holds.
PACK, PER_BUCKET, HELD = 250_000, 250_000, 1_500_000
#: Rows of one signature that are held.
HELD_EACH = 1024
#: Sets of one signature that are compared with each other in one step; more are cut into blocks of about so many.
BLOCK = 256
MOST_BANDS = 255


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> S32)) * P2
    h = (h ^ (h >> S29)) * P3
    return h ^ (h >> S32)


class _WordHashes(dict):
    """64-bit hashes of words, computed once each."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


class NgramSets:
    """Sets of n-gram hashes of texts.

    Letters A to Z are lower-cased; words are runs of anything but space and the characters 9 to 13. With fewer
    than ``n`` words the whole sequence is the only member.
    """

    def __init__(self, n: int, known: int = 100_000):
        self.n, self.known, self.hashes = n, known, _WordHashes()

    def of(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.hashes) > self.known:
            self.hashes.clear()
        ids = np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.n, len(words))
        grams = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            grams = (grams ^ ids[k : len(words) - n + 1 + k]) * P1
            grams ^= grams >> S29
        return np.unique(_mixed(grams))


@dataclass(frozen=True)
class Scheme:
    """How sets of a band are cut: exact segments, segments with neighbourhoods, and the largest difference."""

    band: int
    exact: int
    loose: int
    differ: int


@dataclass(frozen=True)
class Alike:
    """Sets of ``n``-grams are alike if ``den`` times their common part is at least ``num`` times their union."""

    n: int
    num: int
    den: int

    def differ(self, total: int) -> int:
        """Most members in which two sets of ``total`` members together may differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self) -> list[int]:
        """The least size of each band: a set can only be alike to sets of its own and the next bands' sizes.

        A band is as wide as two times the largest ratio of sizes, in which fewer sets are cut by two schemes, and by an
        eighth at least, so that ``MOST_BANDS`` hold all sizes whatever the threshold.
        """
        lows = [1]
        while len(lows) < MOST_BANDS and lows[-1] < 1 << 40:
            lows.append(max(lows[-1] * self.den**2 // self.num**2, lows[-1] * 9 // 8) + 1)
        return lows

    def scheme(self, band: int, n_sets: int) -> Scheme | None:
        """The cheapest cut for a band; None where only equal sets are alike."""
        lows = self.bands()
        low, high = lows[band], lows[band] * self.den**2 // self.num**2
        differ = self.differ(2 * high)
        if differ == 0:
            return None
        units = differ + 1 + (differ + 1) // 6

        def cost(loose: int) -> float:
            exact = units - 2 * loose
            size = (low + high) / 2 / (exact + loose)
            rows = exact + loose * (1 + size)
            chance = exact * CHANCE**size + loose * (1 + size) * CHANCE ** max(size - 1, 0)
            return rows + COMPARE * RELATED * n_sets * chance

        options = range(units // 2 + 1)
        loose = min(options, key=cost)
        return Scheme(band, units - 2 * loose, loose, differ)


def signatures(members: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Signatures of a set: a hash, the band, and whether the segment is an exact one, in 55, 8 and 1 bits."""
    segments = scheme.exact + scheme.loose
    at = ((members >> S17) % np.uint64(segments)).astype(np.int64)
    weight = _mixed(members)
    total = np.zeros(segments, dtype=np.uint64)
    np.add.at(total, at, weight)
    place = _mixed(np.arange(segments, dtype=np.uint64) * P1 + np.uint64(scheme.band + 1))
    own = _mixed(total ^ place)
    exact = np.arange(segments) < scheme.exact
    parts = [(own << np.uint64(9)) | np.uint64(scheme.band << 1) | exact.astype(np.uint64)]
    if scheme.loose:
        inside = ~exact[at]
        less = _mixed((total[at[inside]] - weight[inside]) ^ place[at[inside]])
        parts.append((less << np.uint64(9)) | np.uint64(scheme.band << 1))
        return np.unique(np.concatenate(parts)).view(np.int64)
    return parts[0].view(np.int64)


def sketch(members: np.ndarray) -> bytes:
    """A bit for each part of the universe, whether an odd number of members lies in it.

    There are at least ``PARTS`` times as many parts as members, and a power of two of them, so that few members meet. Sets differ in at least as many members
    as bits. Halves combine by exclusive or into the sketch of half as many parts, so sketches of different lengths
    can be compared.
    """
    parts = max(LEAST_SKETCH, PARTS << int(members.size - 1).bit_length()) if members.size else LEAST_SKETCH
    counts = np.bincount(((members >> S29) % np.uint64(parts)).astype(np.int64), minlength=parts)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of at least ``size`` bytes as one of ``size`` bytes."""
    bits = np.frombuffer(sketch, dtype=np.uint8)
    while bits.size > size:
        bits = bits[: bits.size // 2] ^ bits[bits.size // 2 :]
    return bits


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the other's length."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())


def _profiles(text: Column, n: int) -> Column:
    """Size of a text's set and 128 bits of the set itself."""

    @F.pandas_udf("n_shingles long, high long, low long")
    def profile(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sets = NgramSets(n)
        for batch in batches:
            rows = []
            for text in batch.fillna(""):
                members = sets.of(text)
                key = xxhash.xxh3_128_digest(members.tobytes())
                rows.append((members.size, *np.frombuffer(key, dtype=np.int64).tolist()))
            yield pd.DataFrame(rows, columns=["n_shingles", "high", "low"], index=batch.index)

    return profile(text)


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers as their first bytes, their second ones and so on, which compresses what they have in common."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


def _emitted(alike: Alike, schemes: dict[int, Scheme], n_buckets: int):
    """Signatures of all sets in ``(doc_id, text)``, packed by bucket: a row holds many signatures and their ids."""
    lows = alike.bands()

    def packed(sigs: list[np.ndarray], ids: list[int]) -> pd.DataFrame:
        owner = np.repeat(np.array(ids, dtype=np.int64), [s.size for s in sigs])
        sig = np.concatenate(sigs)
        bucket = ((sig.view(np.uint64) >> np.uint64(9)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, starts = np.unique(bucket[order], return_index=True)
        parts = [np.split(x[order], starts[1:]) for x in (sig, owner)]
        rows = [(int(k), planes(a), planes(b)) for k, a, b in zip(found, *parts, strict=True)]
        return pd.DataFrame(rows, columns=["bucket", "signatures", "ids"])

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = NgramSets(alike.n)
        sigs: list[np.ndarray] = []
        ids: list[int] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                members = sets.of(text or "")
                band = bisect_right(lows, members.size) - 1
                for scheme in (schemes.get(band), schemes.get(band + 1)):
                    if scheme and members.size * alike.den >= lows[scheme.band] * alike.num:
                        sigs.append(signatures(members, scheme))
                        ids.append(doc_id)
                        held += sigs[-1].size
                if held > PACK:
                    yield packed(sigs, ids)
                    sigs, ids, held = [], [], 0
        if held:
            yield packed(sigs, ids)

    return emit


def _several(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(signature, id, n)`` of the signatures in packed rows that occur more than once.

    Rows of a signature that is seen ``HELD_EACH`` times are handed on at once, so no more than that many of each
    are held, however common one is; ``n`` is at least its number of rows then.
    """

    def rows(sig: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Iterator[pd.DataFrame]:
        for k in range(0, sig.size, 200_000):
            cut = slice(k, k + 200_000)
            yield pd.DataFrame({"signature": sig[cut], "id": ids[cut], "n": n[cut]})

    def runs(sig: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(sig, kind="stable")
        sig, ids = sig[order], ids[order]
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        n = np.diff(np.r_[starts, sig.size])
        return sig, ids, np.repeat(n, n)

    common = np.zeros(0, dtype=np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, limit = 0, HELD
    for batch in batches:
        if not len(batch):
            continue
        sig, ids = (np.concatenate([from_planes(x) for x in batch[c]]) for c in ("signatures", "ids"))
        if common.size:
            known = np.isin(sig, common)
            yield from rows(sig[known], ids[known], np.full(int(known.sum()), HELD_EACH))
            sig, ids = sig[~known], ids[~known]
        held.append((sig, ids))
        size += sig.size
        if size > limit:
            sig, ids, n = runs(*(np.concatenate(x) for x in zip(*held, strict=True)))
            many = n >= HELD_EACH
            yield from rows(sig[many], ids[many], n[many])
            common = np.union1d(common, sig[many])
            held = [(sig[~many], ids[~many])]
            size = held[0][0].size
            limit = max(HELD, 2 * size)
    if size:
        sig, ids, n = runs(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield from rows(sig[n > 1], ids[n > 1], n[n > 1])


def _sketched(text: Column, n: int) -> Column:
    """Size and sketch of a text's set."""

    @F.pandas_udf("size long, sketch binary")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sets = NgramSets(n)
        for batch in batches:
            found = [sets.of(text) for text in batch.fillna("")]
            rows = [(members.size, sketch(members)) for members in found]
            yield pd.DataFrame(rows, columns=["size", "sketch"], index=batch.index)

    return sketched(text)


def _members(text: Column, n: int) -> Column:
    @F.pandas_udf("array<long>")
    def members(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sets = NgramSets(n)
        for batch in batches:
            found = [sets.of(text).view(np.int64) for text in batch.fillna("")]
            yield pd.Series(found, index=batch.index, dtype=object)

    return members(text)


def _sketches_differ(a: Column, b: Column) -> Column:
    @F.pandas_udf("int")
    def differ(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([bits_apart(x, y) for x, y in zip(a, b, strict=True)], index=a.index, dtype="int32")

    return differ(a, b)


def _close_pairs(alike: Alike):
    """Pairs ``(a, b)`` that their sizes and sketches don't tell apart, from sorted groups of sets.

    Rows are ``(signature, block_a, block_b, block, id, part, size, sketch)``, groups have equal first three columns;
    a group's sets may lie in several batches, and one group is held at a time. Sets of one part aren't compared, and
    in a group of two blocks only sets of different blocks are.
    """
    sum_, rest = alike.den + alike.num, alike.den - alike.num

    def compared(group: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids, parts, sizes, block = (group[c].to_numpy() for c in ("id", "part", "size", "block"))
        width = min(map(len, group["sketch"]))
        sketches = np.stack([folded(s, width) for s in group["sketch"]])
        cross = group["block_a"].iloc[0] != group["block_b"].iloc[0]
        for i in range(len(ids) - 1):
            other = slice(i + 1, None)
            fits = parts[other] != parts[i]
            if cross:
                fits &= block[other] != block[i]
            small, large = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
            fits &= small * alike.den >= large * alike.num
            at = np.flatnonzero(fits) + i + 1
            if at.size:
                apart = np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1, dtype=np.int64)
                at = at[apart * sum_ <= (sizes[at] + sizes[i]) * rest]
                yield np.full(at.size, ids[i]), ids[at]

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["signature", "block_a", "block_b"]
        held: pd.DataFrame | None = None

        def results(groups: list[pd.DataFrame]) -> pd.DataFrame:
            found = [pair for group in groups if len(group) > 1 for pair in compared(group)]
            a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
            pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
            return pairs[pairs["a"] < pairs["b"]].drop_duplicates()

        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            values = rows[keys].to_numpy()
            starts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
            edges = [0, *starts.tolist()]
            yield results([rows.iloc[x:y] for x, y in zip(edges, edges[1:], strict=False)])
            held = rows.iloc[edges[-1] :].reset_index(drop=True)
        if held is not None:
            yield results([held])

    return close


class _Join:
    """The steps of one join; each writes what later steps read."""

    def __init__(self, docs: DataFrame, alike: Alike):
        self.docs, self.alike = docs.select("doc_id", "text"), alike
        self.work = Workspace(docs.sparkSession)
        self.step = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        with small_batches(self.work.spark):  # whole texts, of which some are very long
            return self.work.keep(df, f"{self.step:03}-{name}")

    def of_ids(self, ids: DataFrame, n_ids: int) -> DataFrame:
        """The documents with these ids."""
        side = F.broadcast(ids) if n_ids <= ID_BOUND else ids
        return self.docs.join(side, "doc_id", "left_semi")

    def run(self) -> DataFrame:
        profile = _profiles(F.col("text"), self.alike.n).alias("p")
        profiles = self.keep(self.docs.select("doc_id", profile).select("doc_id", "p.*"), "profiles")
        known = profiles.filter("doc_id is not null and n_shingles > 0")
        classes = known.groupBy("high", "low", "n_shingles").agg(F.min("doc_id").alias("first"))
        classes = self.keep(classes, "classes")
        links = self.between_classes(classes)
        # several texts of one id tie their classes together
        repeated = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        ties = (
            known.join(repeated, "doc_id", "left_semi")
            .join(classes, ["high", "low", "n_shingles"])
            .select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
        )
        joined = components(links.union(ties), self.work, "all")
        parts = classes.join(joined, F.col("first") == F.col("node"), "left").select(
            "high", "low", "n_shingles", F.coalesce("component", "first").alias("component_id")
        )
        found = profiles.join(parts, ["high", "low", "n_shingles"], "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return found.select("doc_id", "n_shingles", own.alias("component_id"))

    def between_classes(self, classes: DataFrame) -> DataFrame:
        """Edges ``(a, b)`` that connect all classes that are alike."""
        lows = self.alike.bands()
        edges = F.array(*[F.lit(low) for low in lows])
        band = F.size(F.filter(edges, lambda low: low <= F.col("n_shingles"))) - 1
        sizes = {r["band"]: r["n"] for r in classes.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}
        schemes = {}
        for k in sorted({b for size in sizes for b in (size, size + 1)}):
            scheme = self.alike.scheme(k, sizes.get(k, 0) + sizes.get(k - 1, 0)) if k < len(lows) else None
            if scheme:
                schemes[k] = scheme
        firsts = classes.select(F.col("first").alias("doc_id")).distinct()
        texts = self.of_ids(firsts, sum(sizes.values()))
        live = self.keep(self.shared(texts, schemes, sizes), "shared")
        ids = self.keep(live.select(F.col("id").alias("doc_id")).distinct(), "shared-ids")
        index = self.of_ids(ids, ids.count()).select("doc_id", _sketched(F.col("text"), self.alike.n).alias("i"))
        self.index = self.keep(index.select(F.col("doc_id").alias("id"), "i.*"), "index")
        links = self.keep(live.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0), "links")
        before = None
        for r in range(1, 1 << 30):
            labelled, open_ = self.labelled(live, links, r)
            todo = open_.agg(F.sum("n").alias("n"), F.sum("pairs").alias("pairs")).first()
            if not todo["n"]:
                return links
            rows = labelled.join(open_.select("signature", F.col("n").alias("n_sets"), "leader"), "signature")
            if before and todo["pairs"] > before / 2:  # leaders don't bring many sets together any more
                return self.keep(links.union(self.verified(self.close_pairs(rows))), "links")
            before = todo["pairs"]
            pairs = rows.filter("part <> leader.part").select(
                F.least("id", "leader.id").alias("a"), F.greatest("id", "leader.id").alias("b")
            )
            links = self.keep(links.union(self.verified(self.told_apart(pairs.distinct()))), "links")
            live = self.keep(rows.filter("id <> leader.id").select("signature", "id"), "live")

    def labelled(self, live: DataFrame, links: DataFrame, r: int) -> tuple[DataFrame, DataFrame]:
        """The sets with their parts, the components so far, and the signatures that have sets of several parts.

        The leader of such a signature is a set of its smallest part.
        """
        joined = components(links, self.work, f"part-{r}")
        labelled = live.join(joined, F.col("id") == F.col("node"), "left").select(
            "signature", "id", F.coalesce("component", "id").alias("part")
        )
        labelled = self.keep(labelled, "labelled")
        parts = labelled.groupBy("signature", "part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
        open_ = parts.groupBy("signature").agg(
            F.sum("n").alias("n"),
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
            F.min_by(F.struct("id", "part"), F.struct("n", "id")).alias("leader"),
        )
        return labelled, self.keep(open_.filter("pairs > 0"), "open")

    def close_pairs(self, rows: DataFrame) -> DataFrame:
        """Pairs of sets of one signature and different parts that may be alike.

        Sets are compared where they lie, signature by signature and block by block, so only pairs that sketches
        can't tell apart become rows.
        """
        n_blocks = F.ceil(F.col("n_sets") / BLOCK).cast("long")
        sets = self.index.select("id", "size", "sketch")
        own = rows.select("signature", "id", "part", n_blocks.alias("n_blocks")).join(sets, "id")
        block = F.pmod(F.xxhash64("id"), F.col("n_blocks"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
        dealt = own.withColumn("block", block).withColumn("other", other)
        keyed = dealt.select(
            "signature",
            F.least("block", "other").alias("block_a"),
            F.greatest("block", "other").alias("block_b"),
            "block",
            "id",
            "part",
            "size",
            "sketch",
        )
        keys = ["signature", "block_a", "block_b"]
        grouped = keyed.repartition(*keys).sortWithinPartitions(*keys)
        return grouped.mapInPandas(_close_pairs(self.alike), "a long, b long")

    def shared(self, texts: DataFrame, schemes: dict[int, Scheme], sizes: dict[int, int]) -> DataFrame:
        """``(signature, id)`` of the signatures that several sets have and that a pair may need to meet at.

        A pair that is alike shares at least ``spare + 1`` of a scheme's ``differ + 1 + spare`` segments, a segment
        with neighbourhoods counting twice: a set that shares fewer with all others together has no partner there.
        And a set with more than ``differ`` segments that are not very common needs no very common one.
        """
        each = sum(n * (schemes[k].exact + schemes[k].loose) for b, n in sizes.items() for k in (b, b + 1) if k in schemes)
        n_buckets = max(64, each // PER_BUCKET)
        packed = texts.mapInPandas(_emitted(self.alike, schemes, n_buckets), "bucket long, signatures binary, ids binary")
        n_parts = max(int(self.work.spark.conf.get("spark.sql.shuffle.partitions")), n_buckets)
        rows = packed.repartition(n_parts, "bucket").mapInPandas(_several, "signature long, id long, n long")
        if not schemes:
            return rows.select("signature", "id")
        rows = self.keep(rows, "several")
        exact = F.col("signature").bitwiseAND(F.lit(1)) == 1
        marked = rows.select(
            "signature",
            "id",
            F.shiftright("signature", 1).bitwiseAND(F.lit(255)).cast("int").alias("band"),
            F.when(exact, 1).otherwise(2).alias("units"),
            (exact & (F.col("n") > HOT)).cast("int").alias("hot"),
        )
        spare = F.create_map(
            *[F.lit(x) for s in schemes.values() for x in (s.band, s.exact + 2 * s.loose - s.differ - 1)]
        )
        own = Window.partitionBy("id", "band")  # as many rows as a set has signatures
        counted = marked.withColumns(
            {
                "n_units": F.sum("units").over(own),
                "n_hot": F.sum("hot").over(own),
                "spare": F.element_at(spare, F.col("band")),
            }
        )
        wanted = (F.col("n_units") > F.col("spare")) & ((F.col("hot") == 0) | (F.col("n_hot") > F.col("spare")))
        return counted.filter(wanted).select("signature", "id")

    def told_apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that their sizes and sketches don't tell apart."""
        num, den = self.alike.num, self.alike.den
        left = self.index.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("s_a"))
        right = self.index.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("s_b"))
        both = pairs.join(left, "a").join(right, "b")
        near = both.filter(
            (F.least("size_a", "size_b") * den >= F.greatest("size_a", "size_b") * num)
            & (
                _sketches_differ(F.col("s_a"), F.col("s_b")) * F.lit(den + num)
                <= (F.col("size_a") + F.col("size_b")) * (den - num)
            )
        )
        return near.select("a", "b")

    def verified(self, near: DataFrame) -> DataFrame:
        """The pairs that are alike."""
        num, den = self.alike.num, self.alike.den
        near = self.keep(near.distinct(), "near")
        ids = near.select(F.col("a").alias("doc_id")).union(near.select(F.col("b").alias("doc_id"))).distinct()
        ids = self.keep(ids, "near-ids")
        sets = self.of_ids(ids, ids.count()).select("doc_id", _members(F.col("text"), self.alike.n).alias("m"))
        sets = self.keep(sets, "sets")
        tested = near.join(sets.select(F.col("doc_id").alias("b"), F.col("m").alias("m_b")), "b").join(
            sets.select(F.col("doc_id").alias("a"), F.col("m").alias("m_a")), "a"
        )
        common = F.size(F.array_intersect("m_a", "m_b"))
        union = F.size("m_a") + F.size("m_b") - common
        return tested.filter(common * den >= union * num).select("a", "b").distinct()


def join_components(docs: DataFrame, alike: Alike) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``."""
    return _Join(docs, alike).run()


#: The contract's join, and the near-duplicate rule of corpora.
CONTRACT = Alike(n=3, num=90, den=100)
NEAR_DUPLICATES = Alike(n=5, num=8, den=10)


def digest(docs: DataFrame) -> DataFrame:
    return join_components(docs, CONTRACT)


def keep_one(docs: DataFrame, alike: Alike = NEAR_DUPLICATES) -> DataFrame:
    """One row of each component of texts: of the least id in it, and of that id's texts there the least.

    A text is a document, not its id: unlike texts of one id are compared and kept each. Rows with a null id and rows
    without words stay as they are. The texts of an id that has several are told apart by 64-bit hashes.
    """
    work = Workspace(docs.sparkSession)
    known = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"))
    several = known.groupBy("doc_id").agg(F.min("h").alias("least"), F.max("h").alias("most")).filter("least <> most")
    several = work.keep(several.select(F.col("doc_id").alias("_several")), "several")
    n_several = several.count()
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))  # no name of the input's is in the way
    nodes = rows.withColumn("_node", F.col("doc_id"))
    if n_several:
        side = F.broadcast(several) if n_several <= ID_BOUND else several
        own = F.when(F.col("_several").isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "text"))
        nodes = rows.join(side, F.col("doc_id") == F.col("_several"), "left").withColumn("_node", own)
    found = work.keep(join_components(nodes.select(F.col("_node").alias("doc_id"), "text"), alike), "components")
    per_node = found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("node"), "component_id", "n_shingles")
    per_node = work.keep(per_node.agg(F.count(F.lit(1)).alias("n")), "nodes")
    first = F.col("node") == F.col("component_id")
    if n_several:
        named = nodes.filter("_several is not null").select(F.col("_node").alias("node"), "doc_id", "text")
        named = named.dropDuplicates(["node"])
        with small_batches(work.spark):
            ids = work.keep(named.select("node", "doc_id"), "ids")
        worded = per_node.filter("n_shingles > 0").join(ids, "node", "left")
        worded = worded.withColumn("doc_id", F.coalesce("doc_id", "node"))
        least = worded.groupBy("component_id").agg(F.min("doc_id").alias("doc_id"))
        worded = worded.join(least, ["component_id", "doc_id"]).join(named.select("node", "text"), "node", "left")
        best = worded.groupBy("component_id").agg(F.min_by("node", F.struct("text")).alias("node")).select("node")
        per_node = per_node.join(work.keep(best, "best").withColumn("best", F.lit(True)), "node", "left")
        first = F.col("best").isNotNull()
    again = (F.col("n_shingles") > 0) & (F.col("n") > 1)
    kept = per_node.filter((F.col("n_shingles") == 0) | first).select(F.col("node").alias("_kept"), again.alias("_again"))
    kept = work.keep(kept, "kept")
    n, repeated = kept.agg(F.count(F.lit(1)), F.count_if("_again")).first()
    side = F.broadcast(kept) if n <= ID_BOUND else kept
    one = nodes.join(side, F.col("_node") == F.col("_kept"), "left").filter("doc_id is null or _kept is not null")
    if repeated:
        again = F.coalesce("_again", F.lit(False))
        one = one.filter(~again).union(one.filter(again).dropDuplicates(["_node"]))
    return one.select("_row.*")
