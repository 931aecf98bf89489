"""Preference formatting: one prompt and two masked completions per pair of conversations.

The prompt is the longest common prefix of turns of the chosen and the rejected conversation and is rendered
once. What follows on each side is that side's completion; its mask holds the spans of the turns a model learns
from.

A pair is one record with one prompt and two completions, so its turns come together in one task, however many they
are. Where the sides part is found from digests of the turns, so that texts are shuffled once.

Defined results: a turn is its number, role and text; null roles and texts count as empty, and turns with a null
number or conversation are not in any conversation. Equal rows are one turn; different rows of one number are
ordered by role and text, and all belong to the prompt only if both sides have the same ones. A conversation
without partner gives a pair with an empty prompt and one empty completion. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rendered turn is head, role, mid, text, tail.
HEAD, MID, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED = "assistant"

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def _rendered() -> str:
    return f"concat('{HEAD}', x.role, '{MID}', x.text, '{TAIL}')"


def _join(turns: str) -> Column:
    return F.expr(f"array_join(transform({turns}, x -> {_rendered()}), '')")


def _mask(turns: str) -> Column:
    """Spans of the learned turns' texts and tails in the rendered completion, in characters, end excluded."""
    skip = f"char_length('{HEAD}') + char_length(x.role) + char_length('{MID}')"
    span = f"""named_struct('start', acc.at + {skip}, 'end', acc.at + char_length({_rendered()}))"""
    return F.expr(
        f"""
        aggregate({turns},
            named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int>>)),
            (acc, x) -> named_struct(
                'at', acc.at + char_length({_rendered()}),
                'spans', if(x.role = '{LEARNED}', concat(acc.spans, array({span})), acc.spans)),
            acc -> acc.spans)
        """
    )


def sides(conversations: DataFrame) -> DataFrame:
    """Conversations ``2k`` and ``2k + 1`` as the chosen and the rejected one of pair ``k``.

    The conversations carry no preference, so their numbers stand in for it; nothing is shuffled for this.
    """
    return conversations.select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"),
        (F.pmod(F.col("conv_id"), F.lit(2)) == 0).alias("chosen"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
    )


def format_pairs(sided: DataFrame) -> DataFrame:
    """One row per pair from ``(pair_id, chosen, conv_id, turn, role, text)``."""
    known = sided.filter("pair_id is not null and turn is not null")
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = known.groupBy("pair_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("chosen"), turn))).alias("_chosen"),
        F.array_sort(F.collect_set(F.when(~F.col("chosen"), turn))).alias("_rejected"),
    )
    said = F.md5(F.to_json(F.struct(turn["role"].alias("role"), turn["text"].alias("text"))))
    slim = known.select("pair_id", "chosen", "conv_id", "turn", said.alias("_said"))
    once = slim.groupBy("pair_id", "turn", "_said").agg(
        (F.max(F.col("chosen").cast("int")) - F.min(F.col("chosen").cast("int")) + 1).alias("_sides"),
        F.min(F.when(F.col("chosen"), F.col("conv_id"))).alias("_chosen_id"),
        F.min(F.when(~F.col("chosen"), F.col("conv_id"))).alias("_rejected_id"),
    )
    pairs = once.groupBy("pair_id").agg(
        F.min(F.when(F.col("_sides") == 1, F.col("turn"))).alias("_from"),
        F.min("_chosen_id").alias("_chosen_id"),
        F.min("_rejected_id").alias("_rejected_id"),
    )
    whole = turns.join(pairs, "pair_id").withColumns(
        {
            "_prompt": F.expr("filter(_chosen, x -> _from is null or x.turn < _from)"),
            "_chosen": F.expr("filter(_chosen, x -> x.turn >= _from)"),
            "_rejected": F.expr("filter(_rejected, x -> x.turn >= _from)"),
        }
    )
    return whole.select(
        "pair_id",
        F.col("_chosen_id").alias("chosen_id"),
        F.col("_rejected_id").alias("rejected_id"),
        F.size("_prompt").cast("long").alias("n_prompt_turns"),
        _join("_prompt").alias("prompt"),
        _join("_chosen").alias("chosen"),
        _join("_rejected").alias("rejected"),
        _mask("_chosen").alias("chosen_mask"),
        _mask("_rejected").alias("rejected_mask"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    """The pairs of a conversations table, with masks as text ``start:end,...``."""
    pairs = format_pairs(sides(conversations.select("conv_id", "turn", "role", "text")))
    as_text = {
        name: F.expr(f"array_join(transform({name}, s -> concat(s.start, ':', s.end)), ',')")
        for name in ("chosen_mask", "rejected_mask")
    }
    return pairs.withColumns(as_text)
