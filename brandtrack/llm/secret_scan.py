"""Secret scans with a linear-chain conditional random field.

Texts are cut into words and marks, and each gets a tag: a secret begins, goes on, or neither. Its features are its
own shape (length, characters, how mixed they are and how they begin), the kinds of the two tokens before and the one after it, and two of its file: how many marks there are
among its tokens, and whether it names a credential. Weights are fitted here by maximum likelihood, on windows of
at most ``TRAIN_DOCS`` documents, half of them with a value of the fixed patterns wherever there are so many. The secrets
to learn from are these values, and as many made ones: random strings of many alphabets, lengths and prefixes put into
the documents' own words, mostly without a credential's name before them, beside as many harmless values. So shape and
context must carry, and not the patterns' own marks. The best tags are found by Viterbi.

A sum of weights bounds what tagging a token as part of a secret can gain, both of its transitions included. Where
it can't gain, the tag is on no best path, and Viterbi runs only on the stretches between such tokens:
the same tags as over the whole text, without a step for each word of prose.

The fixed patterns' spans are always kept; the field adds spans, kind ``field``, that overlap none of them.

Defined results: a null or empty text has no spans; offsets are in code points of the whole text, end excluded;
repeated rows are scanned each; an empty table, or one whose texts have no word, adds no spans; columns
other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .token_counts import blocks

#: The fixed patterns: kind, pattern, group that is the secret, and the least length of that group.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
#: The first pattern's values as Spark sees them, and words of which a text that has one holds one.
ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}"""
NAMED = ("passw", "secret", "token", "api")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # the hex runs that are long enough
KINDS = ("assign", "access", "hex", "field")

#: Bound of the training sample, in documents, and of the windows taken from each.
TRAIN_DOCS = 4_000
WINDOWS_PER_DOC = 2
REACH = 10
ROUNDS = 120

TOKEN = re.compile(r"[\w+/.\-@]+|[^\w\s+/.\-@]")
CREDENTIAL = re.compile(r"(?i)passw|secret|token|api_?key|credential|bearer|auth")
KNOWN_START = re.compile(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-|eyJ")
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
LENGTHS = np.array([4, 8, 12, 16, 24, 32, 48])
N_LENGTHS, N_SETS, N_MIXED, N_KINDS, N_FILES = len(LENGTHS) + 1, 9, 16, 8, 8
#: How many values each column of features has: length, characters, mix, neighbours before, two before and after, file.
SIZES = (N_LENGTHS, N_SETS, N_MIXED, N_KINDS, N_KINDS, N_KINDS, N_FILES)
#: Kinds of a neighbour.
WORD, NAME, EQUALS, COLON, QUOTE, MARK, CODE, EDGE = range(N_KINDS)
BREAK = "\0"  # two of them stand between texts


def _char_set(token: str) -> int:
    if not token.isascii():
        return 0
    if not token.isalnum():
        return 8 if any(c.isdigit() for c in token) and any(c.isalpha() for c in token) else 7
    if token.isdigit():
        return 3
    if token.isalpha():
        return 1 if token.islower() or token.istitle() else 2
    if token.islower():
        return 4 if all(c in "0123456789abcdef" for c in token) else 5
    return 6


def _changes(token: str) -> int:
    """How often letters and digits, or lower and upper case, take turns; a first capital is none."""
    kinds = ["0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "" for c in token]
    kinds = [k for k in kinds if k]
    return sum(a != b for a, b in zip(kinds[1:], kinds[2:]))


def shape(token: str) -> tuple[int, int, int, int]:
    """The token's length, characters and mix, and its kind as a neighbour."""
    if token == BREAK:
        return 0, 0, 0, EDGE
    if len(token) == 1 and not token.isalnum():
        kind = {"=": EQUALS, ":": COLON, '"': QUOTE, "'": QUOTE, "`": QUOTE}.get(token, MARK)
        return 0, 7, 0, kind
    chars = _char_set(token)
    bucket = int(np.searchsorted(LENGTHS, len(token), side="right"))
    changes = int(np.searchsorted([1, 3, 6], _changes(token), side="right"))
    varied = len(set(token)) * 3 >= min(len(token), 30)
    known = KNOWN_START.match(token) is not None
    mixed = (changes * 2 + varied) * 2 + known
    if CREDENTIAL.search(token) and len(token) <= 24:
        return bucket, chars, mixed, NAME
    return bucket, chars, mixed, CODE if chars >= 4 and len(token) >= 8 else WORD


@dataclass(frozen=True)
class Field:
    """Weights by tag (columns) for each column of features, and tag to tag."""

    tables: tuple[np.ndarray, ...]
    step: np.ndarray

    def emission(self, x: np.ndarray) -> np.ndarray:
        return sum(table[x[..., k]] for k, table in enumerate(self.tables))

    def may_gain(self, x: np.ndarray) -> np.ndarray:
        """Whether a token may be part of a secret on a best path: whether either tag can be worth more than outside
        between any two neighbours."""
        step, gains = self.step, []
        for tag in (BEGIN, INSIDE):
            between = (step[:, tag] - step[:, OUTSIDE]).max() + (step[tag] - step[OUTSIDE]).max()
            gains.append(sum((t[:, tag] - t[:, OUTSIDE])[x[:, k]] for k, t in enumerate(self.tables)) + between)
        return np.maximum(*gains) >= 0

    def tags(self, emission: np.ndarray) -> list[int]:
        """Viterbi between two tokens outside."""
        best = self.step[OUTSIDE] + emission[0]
        back = []
        for e in emission[1:]:
            paths = best[:, None] + self.step
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + e
        tag = int((best + self.step[:, OUTSIDE]).argmax())
        found = [tag]
        for choice in reversed(back):
            tag = int(choice[tag])
            found.append(tag)
        return found[::-1]


class Features:
    """Token features of texts; remembers shapes of short tokens."""

    def __init__(self, known: int = 200_000):
        self.shapes: dict[str, tuple[int, int, int, int]] = {}
        self.known = known

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of all tokens, the text of each, and each text's longest token. Breaks have text -1."""
        tokens: list[str] = []
        counts = []
        for text in texts:
            found = TOKEN.findall(text)
            counts.append(len(found))
            tokens += found
            tokens += (BREAK, BREAK)
        tokens += (BREAK, BREAK)
        codes, distinct = pd.factorize(np.array(tokens, dtype=object))
        if len(self.shapes) > self.known:
            self.shapes.clear()
        table = np.empty((len(distinct), 4), dtype=np.int64)
        for i, token in enumerate(distinct):
            found = self.shapes.get(token)
            if found is None:
                found = shape(token)
                if len(token) <= 64:
                    self.shapes[token] = found
            table[i] = found
        sizes = np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct))[codes]
        kinds = table[codes, 3]
        counts = np.array(counts, dtype=np.int64)
        owner = np.full(len(tokens), -1, dtype=np.int64)
        owner[: -2] = np.repeat(np.arange(len(texts)), counts + 2)
        owner[kinds == EDGE] = -1
        first = np.concatenate([[0], np.cumsum(counts + 2)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        marks = np.add.reduceat(np.isin(kinds, (EQUALS, COLON, QUOTE, MARK)), first) if len(texts) else first
        names = np.maximum.reduceat(kinds == NAME, first) if len(texts) else first
        longest = np.maximum.reduceat(sizes, first) if len(texts) else first
        share = np.searchsorted([0.05, 0.12, 0.3], marks / np.maximum(counts, 1))
        file = share * 2 + names
        x = np.stack(
            [
                *table[codes, :3].T,
                np.concatenate([[EDGE], kinds[:-1]]),
                np.concatenate([[EDGE, EDGE], kinds[:-2]]),
                np.concatenate([kinds[1:], [EDGE]]),
                np.where(owner >= 0, file[np.maximum(owner, 0)], 0) if len(texts) else kinds,
            ],
            axis=1,
        )
        return x, owner, longest


def base_spans(text: str, longest: int | None = None) -> list[tuple[str, int, int, int, int]]:
    """Kind, start and end of the match, start and end of the secret, kind by kind.

    A text is searched only where it can match: ``longest`` is the length of its longest token, and a run of hex
    digits lies within one.
    """
    found = []
    lowered = text.lower()
    if any(name in lowered for name in ("passw", "secret", "token", "api")):
        kind, pattern, group, least = PATTERNS[0]
        found += [(kind, *m.span(), *m.span(group)) for m in pattern.finditer(text) if len(m[group]) >= least]
    if "AKIA" in text:
        kind, pattern, group, least = PATTERNS[1]
        found += [(kind, *m.span(), *m.span(group)) for m in pattern.finditer(text) if len(m[group]) >= least]
    if longest is None or longest >= 32:
        found += [("hex", *m.span(), *m.span()) for m in LONG_HEX.finditer(text)]
    return found


def as_text(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


#: Alphabets of made secrets, and what they may begin with.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    LOWER + LOWER.upper() + DIGITS, LOWER + LOWER.upper() + DIGITS + "+/", LOWER + LOWER.upper() + DIGITS + "-_",
    LOWER + DIGITS, LOWER.upper() + DIGITS, "0123456789abcdef",
)


def made_secret(rng: random.Random) -> str:
    """A random string, at times in dotted parts or behind a short prefix."""
    body = lambda low, high: "".join(rng.choices(alphabet, k=rng.randrange(low, high)))
    alphabet = rng.choice(ALPHABETS)
    if rng.random() < 0.12:
        return ".".join(body(14, 40) for _ in range(3))
    start = "".join(rng.choices(LOWER, k=rng.randrange(2, 6))) + rng.choice("_-") if rng.random() < 0.35 else ""
    return start + body(14, 48)


def harmless(rng: random.Random, words: list[str]) -> str:
    """What stands in the same places and is no secret."""
    number = lambda n: "".join(rng.choices(DIGITS, k=n))
    word = lambda: re.sub(r"\W", "", rng.choice(words)) or "x"
    uuid = "-".join("".join(rng.choices("0123456789abcdef", k=n)) for n in (8, 4, 4, 4, 12))
    return rng.choice([
        word(), word() + number(2), f"{word()}_{word()}", f"{word()}-{word()}-{word()}", f"{word()}.{word()}.com/{word()}/{number(3)}",
        f"https://{word()}.org/{word()}/{word()}-{number(4)}", f"{word()}@{word()}.net", f"/{word()}/{word()}/{word()}.py", number(5),
        number(11), f"2{number(3)}-0{number(1)}-1{number(1)}", f"{number(1)}.{number(2)}.{number(1)}", f"192.168.{number(1)}.{number(2)}",
        word() * 3, (word() + word()).title(), uuid, f"v{number(1)}.{number(1)}.{number(1)}-{word()}", f"{word()}{word().title()}{word().title()}",
    ])


def with_made_value(text: str, rng: random.Random) -> tuple[str, int, int, bool]:
    """The text with a value put between two of its words: the value's place, and whether it is a secret."""
    words = text.split() or ["x"]
    secret = rng.random() < 0.5
    value = made_secret(rng) if secret else harmless(rng, words)
    name = rng.choice([rng.choice(words), rng.choice(words), "_".join(rng.choices(words, k=2)), "key", "Token", "auth", ""])
    mark = rng.choice([" = ", "=", ": ", ":", " ", " "]) if name else ""
    quote = rng.choice(['"', "'", "", "", ""])
    gaps = [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
    at = rng.choice(gaps)
    before = f"{text[:at]} {name}{mark}{quote}"
    return f"{before}{value}{quote} {text[at:]}", len(before), len(before) + len(value), secret


def _tags(text: str, spans: list[tuple[int, int]], n: int) -> np.ndarray:
    """The tags of a text's ``n`` tokens; of spans that overlap the first counts."""
    tags = np.zeros(n, dtype=np.int64)
    at = np.array([m.span() for m in TOKEN.finditer(text)], dtype=np.int64)
    for start, end in spans:
        inside = np.flatnonzero((at[:, 0] < end) & (at[:, 1] > start))
        if not tags[inside].any():
            tags[inside] = INSIDE
            tags[inside[:1]] = BEGIN
    return tags


def _cut(x: np.ndarray, tags: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The window around some tokens, widened to where no secret is cut."""
    low, high = max(0, first - REACH), min(len(tags), last + REACH)
    while low > 0 and tags[low] != OUTSIDE:
        low -= 1
    while high < len(tags) and tags[high - 1] != OUTSIDE:
        high += 1
    return x[low:high], tags[low:high]


def _windows(text: str, spans: list[tuple[int, int]], others: int, features: Features) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and tags around secrets and some other tokens with digits or of mixed case, else at the start."""
    x, owner, _ = features.of([text])
    n = int((owner >= 0).sum())
    if not n:
        return []
    tags = _tags(text, spans, n)
    secret = np.flatnonzero(tags == BEGIN)
    other = np.flatnonzero((tags == OUTSIDE) & (x[:n, 1] >= 2) & (x[:n, 1] != 7))
    return [_cut(x, tags, c, c + 1) for c in [*secret[:WINDOWS_PER_DOC], *other[:others]] or [0]]


def training_windows(text: str, features: Features) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of the text as it is, and around one value put into it. The same text gives the same windows."""
    if not text.split():
        return []
    known = [(start, end) for *_, start, end in base_spans(text)]
    found = _windows(text, known, 1, features)
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    longer, start, end, secret = with_made_value(text, rng)
    low, high = max(0, start - 400), end + 400
    near = longer[low:high]
    spans = [(s, e) for *_, s, e in base_spans(near)]
    if secret:
        spans = [(start - low, end - low), *[(s, e) for s, e in spans if e <= start - low or s >= end - low]]
    x, owner, _ = features.of([near])
    tagged = _windows(near, spans, 0, features)
    if not secret:  # around the harmless value
        at = [i for i, m in enumerate(TOKEN.finditer(near)) if m.start() < end - low and m.end() > start - low]
        tags = _tags(near, spans, int((owner >= 0).sum()))
        tagged = [_cut(x, tags, at[0], at[-1] + 1)] if at and not tags[at].any() else []
    return found + tagged


def fit(windows: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> Field | None:
    """Weights of the greatest penalised likelihood, by Adam over all windows; None without secrets."""
    if not any((tags != OUTSIDE).any() for _, tags in windows):
        return None
    widest = max(len(tags) for _, tags in windows)
    n = len(windows)
    x = np.zeros((n, widest, len(SIZES)), dtype=np.int64)
    y = np.zeros((n, widest), dtype=np.int64)
    real = np.zeros((n, widest), dtype=bool)
    for i, (features, tags) in enumerate(windows):
        x[i, : len(tags)], y[i, : len(tags)], real[i, : len(tags)] = features, tags, True
    sizes = (*SIZES, 3)
    weights = [np.zeros((size, 3)) for size in sizes]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    ends = real.sum(axis=1)
    truth = np.eye(3)[y] * real[..., None]
    before = np.concatenate([np.zeros((n, 1), dtype=np.int64), y[:, :-1]], axis=1)
    true_steps = np.zeros((3, 3))
    np.add.at(true_steps, (before[real], y[real]), 1)
    last = y[np.arange(n), ends - 1]
    np.add.at(true_steps, (last, np.zeros(n, dtype=np.int64)), 1)
    for t in range(1, rounds + 1):
        field = Field(tuple(weights[:-1]), weights[-1])
        share, steps = _expected(field, field.emission(x), real, ends)
        wrong = share * real[..., None] - truth
        grads = []
        for k in range(len(SIZES)):
            flat = x[..., k].ravel()
            each = [np.bincount(flat, wrong[..., tag].ravel(), sizes[k]) for tag in range(3)]
            grads.append(np.stack(each, axis=1))
        grads.append(steps - true_steps)
        for k, grad in enumerate(grads):
            grad = grad / n + 1e-4 * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad**2
            move = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
            weights[k] = weights[k] - 0.1 * move
    return Field(tuple(weights[:-1]), weights[-1])


def _expected(field: Field, emission: np.ndarray, real: np.ndarray, ends: np.ndarray):
    """Shares of tags and expected steps under the model, over all windows. Windows lie between tokens outside."""

    def total(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    n, width, _ = emission.shape
    ahead, behind = np.zeros_like(emission), np.zeros_like(emission)
    ahead[:, 0] = field.step[OUTSIDE] + emission[:, 0]
    for i in range(1, width):
        ahead[:, i] = total(ahead[:, i - 1, :, None] + field.step, 1) + emission[:, i]
    stop = field.step[:, OUTSIDE]
    for i in range(width - 1, -1, -1):
        if i + 1 < width:
            behind[:, i] = total(field.step + (emission[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
        behind[ends == i + 1, i] = stop
    norm = total(ahead[:, 0] + behind[:, 0], 1)
    share = np.exp(np.minimum(ahead + behind - norm[:, None, None], 0.0))
    pair = ahead[:, :-1, :, None] + field.step + (emission[:, 1:] + behind[:, 1:])[:, :, None, :]
    pair = np.exp(np.minimum(pair - norm[:, None, None, None], 0.0)) * real[:, 1:, None, None]
    steps = pair.sum(axis=(0, 1))
    steps[OUTSIDE] += share[:, 0].sum(axis=0)
    steps[:, OUTSIDE] += share[np.arange(n), ends - 1].sum(axis=0)
    return share, steps


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Field | None:
    """A field from ``rows`` documents at most, of those with and of those without a value of the fixed patterns half each.

    Ids of each kind are dealt into slots by a hash, and of each slot the id of the lowest other hash is drawn: so a single
    document with a value is drawn for certain, and a task keeps one id a slot, however many rows it reads. Only features
    of windows come to the driver.
    """

    @F.pandas_udf("array<binary>")
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for batch in batches:
            found = []
            for text in batch.fillna(""):
                cut = training_windows(text, features)
                found.append([np.c_[x, tags].astype(np.int16).tobytes() for x, tags in cut])
            yield pd.Series(found, index=batch.index, dtype=object)

    text = F.col("text")
    named = reduce(Column.__or__, [F.lower(text).contains(name) for name in NAMED])
    has = (named & text.rlike(ASSIGNED)) | (text.contains("AKIA") & text.rlike("AKIA[A-Z0-9]{12}")) | text.rlike("[0-9a-f]{32}")
    slot = F.pmod(F.xxhash64("doc_id", F.lit(0)), F.lit(rows // 2))
    ids = docs.filter("doc_id is not null").select("doc_id", F.coalesce(has, F.lit(False)).alias("has"), slot.alias("slot"))
    drawn = ids.groupBy("has", "slot").agg(F.min_by("doc_id", F.xxhash64("doc_id")).alias("doc_id")).select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # TRAIN_DOCS ids at most
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = sorted(one.select("doc_id", windows("text").alias("w")).collect(), key=lambda row: row["doc_id"])
    width = len(SIZES) + 1
    cut = [np.frombuffer(w, dtype=np.int16).reshape(-1, width).astype(np.int64) for row in sample for w in row["w"]]
    return fit([(w[:, :-1], w[:, -1]) for w in cut])


def field_spans(text: str, x: np.ndarray, field: Field) -> list[tuple[int, int]]:
    """Spans that the field tags as secrets; ``x`` are the features of the text's tokens."""
    active = np.flatnonzero(field.may_gain(x))
    if not active.size:
        return []
    spans: list[list[int]] = []
    where = None
    for run in np.split(active, np.flatnonzero(np.diff(active) > 1) + 1):
        inside = False
        for at, tag in zip(run, field.tags(field.emission(x[run])), strict=True):
            if tag == OUTSIDE:
                inside = False
                continue
            where = where or [m.span() for m in TOKEN.finditer(text)]
            start, end = where[at]
            if inside and tag == INSIDE:
                spans[-1][1] = end
            else:
                spans.append([start, end])
            inside = True
    return [(start, end) for start, end in spans]


class Scanner:
    def __init__(self, field: Field | None):
        self.field, self.features = field, Features()

    def scan(self, texts: list[str]) -> list[tuple]:
        """Counts of the fixed kinds, the digest of their spans, and all spans of each text."""
        x, owner, longest = self.features.of(texts)
        may = self.field.may_gain(x) & (owner >= 0) if self.field else np.zeros(0, dtype=bool)
        wanted = set(owner[may].tolist()) if self.field else set()
        ends = np.searchsorted(np.where(owner >= 0, owner, np.maximum.accumulate(owner)), np.arange(len(texts) + 1))
        rows = []
        for i, text in enumerate(texts):
            fixed = base_spans(text, int(longest[i]))
            spans = [(kind, start, end) for kind, start, end, _, _ in fixed]
            counts = [sum(kind == k for k, _, _ in spans) for kind in KINDS[:3]]
            digest = hashlib.sha256(as_text(spans).encode()).hexdigest()
            if i in wanted:
                own = x[ends[i] : ends[i + 1]][owner[ends[i] : ends[i + 1]] == i]
                for start, end in field_spans(text, own, self.field):
                    if all(end <= s or start >= e for _, s, e in spans[: sum(counts)]):
                        spans.append(("field", start, end))
            rows.append((*counts, digest, as_text(spans)))
        return rows


def scanned(text: Column, field: Field | None) -> Column:
    columns = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(field)
        for batch in batches:
            rows = [row for block in blocks(list(batch.fillna(""))) for row in scanner.scan(block)]
            yield pd.DataFrame(rows, columns=columns, index=batch.index)

    return scan(text)


def digest(docs: DataFrame) -> DataFrame:
    found = docs.select("doc_id", scanned(F.col("text"), train(docs)).alias("_found"))
    return found.select("doc_id", "_found.*")
