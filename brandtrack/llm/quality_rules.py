"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores its measurements and one bit per failed rule;
policies are versioned sets of bits, so a new policy or an ablation reads the ledger and never the texts again.

Defined results: a null text has no words and fails ``few_words``; a null or repeated ``doc_id`` keeps its rows,
one ledger row for each input row; an empty table gives an empty ledger; columns other than the id and the text
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails``, SQL over the measurements, is true."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", 3, "n_lines >= 4 and 10 * n_dup_lines > 5 * n_lines"),
    Rule("long_words", 4, "word_chars > 20 * n_words"),
    Rule("short_words", 5, "word_chars < 2 * n_words"),
)
BASE = ("few_words", "repeated_windows")

#: Which rules reject, by policy version.
POLICIES = {
    1: BASE,
    2: (*BASE, "many_symbols", "repeated_lines"),
    3: (*BASE, "many_symbols", "repeated_lines", "long_words", "short_words"),
}
CURRENT = 3


def mask(names, rules=RULES) -> int:
    """The bits of the named rules."""
    known = {rule.name: 1 << rule.bit for rule in rules}
    return sum(known[name] for name in names)


def _repeat_words() -> Column:
    """Words that lie in a window of eight words found twice or more in the text.

    Windows are compared by a 64-bit hash. Texts without equal hashes, the most, cost no sort; in the others the
    positions of repeated windows are sorted, and each adds the words up to the next one.
    """
    return F.expr(
        f"""
        case when size(array_distinct(_hashes)) = size(_hashes) then 0L
        else aggregate(
            zip_with(_again, slice(_again, 2, size(_again)),
                     (a, b) -> least({WINDOW}L, coalesce(b - a, {WINDOW}L))),
            0L, (sum, x) -> sum + x) end
        """
    )


def _again() -> Column:
    """Positions of windows whose hash occurs twice or more, in order."""
    return F.expr(
        """
        case when size(array_distinct(_hashes)) < size(_hashes) then
            array_sort(transform(
                filter(_sorted, (x, i) -> x.h = _sorted[greatest(i - 1, 0)].h and i > 0
                                          or x.h = get(_sorted, i + 1).h),
                x -> x.p))
        else array() end
        """
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and what the rules look at."""
    whole = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(whole, F.lit(WHITE))
    texts = docs.select(F.col(id_col).alias("doc_id"), whole.alias("_whole"), trimmed.alias("_text"))
    cut = texts.select(
        "doc_id",
        F.when(F.col("_text") == "", F.array().cast("array<string>"))
        .otherwise(F.split("_text", GAP))
        .alias("_words"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("_whole", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "").alias("_lines"),
    )
    counted = cut.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"""
            case when size(_words) < {WINDOW} then cast(array() as array<bigint>)
            else transform(sequence(1, size(_words) - {WINDOW - 1}),
                           i -> xxhash64(slice(_words, i, {WINDOW}))) end
            """
        ).alias("_hashes"),
    )
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ranked = counted.withColumn(
        "_sorted",
        F.when(
            repeated,
            F.expr(
                "sort_array(transform(_hashes, (x, i) -> named_struct('h', x, 'p', cast(i as bigint))))"
            ),
        ),
    )
    found = ranked.withColumn("_again", _again())
    return found.withColumn("n_repeat_words", _repeat_words()).drop("_hashes", "_sorted", "_again")


def ledger(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``failure_bits``, the bits of all failed rules."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, id_col, text_col).withColumn("failure_bits", bits)


def apply_policy(book: DataFrame, version: int = CURRENT, policies=POLICIES, rules=RULES) -> DataFrame:
    """The ledger with ``policy`` and ``kept``: none of the policy's rules failed."""
    rejects = F.lit(mask(policies[version], rules)).cast("long")
    return book.withColumns(
        {
            "policy": F.lit(version),
            "kept": F.col("failure_bits").bitwiseAND(rejects) == 0,
        }
    )


def ablations(book: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """For every policy and each of its rules: ``n_failed``, ``n_failed_alone`` and ``n_kept_without`` documents.

    The ledger is first counted by its bits, at most one row for each pattern that occurs, and only these
    patterns meet the policies. ``all_failed_bits`` holds the bits common to all documents that the rule rejects.
    """
    patterns = book.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(version).alias("policy"),
            F.lit(rule.name).alias("rule"),
            F.lit(mask(names, rules)).cast("long").alias("mask"),
            F.lit(1 << rule.bit).cast("long").alias("one"),
        )
        for version, names in policies.items()
        for rule in rules
        if rule.name in names
    ]
    each = patterns.select("failure_bits", "n", F.inline(F.array(*cases)))
    failed = F.col("failure_bits").bitwiseAND(F.col("one")) != 0
    under = F.col("failure_bits").bitwiseAND(F.col("mask"))
    rest = F.col("failure_bits").bitwiseAND(F.col("mask") - F.col("one"))
    return each.groupBy("policy", "rule").agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(under == F.col("one"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.bit_and(F.when(failed, F.col("failure_bits"))).alias("all_failed_bits"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """Ledger and verdict of the current policy, with the base rules' verdict beside it."""
    base = F.lit(mask(BASE)).cast("long")
    verdict = apply_policy(ledger(docs))
    return verdict.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failure_bits").bitwiseAND(base) != 0).alias("base_failed"),
        "kept",
        "failure_bits",
        "policy",
    )
