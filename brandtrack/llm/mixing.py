"""Mixing sources to target weights.

The sources form a tree: domain, language, source. Every node has a weight among its siblings. The budget of the
root is handed down: each node shares its own among its children by weight, but none gets more than its
documents can give in ``max_epochs`` epochs, and what it can't take goes to its siblings. Since a node can take
what its children can, a shortage is met by siblings first and reaches the level above only where a whole subtree
is short. A leaf then takes whole epochs, and of one more epoch, whose order is a seeded hash, the prefix that
fits.

Defined results: null levels are the name ``(none)``; a null text has no tokens; documents with a null id are
ordered by their text; rows with one id are taken together or not at all; a leaf without tokens or weight gives
nothing; an empty table gives an empty result. Budgets are whole numbers and are rounded down.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality_rules import GAP, WHITE
from .tables import Workspace

LEVELS = ("domain", "lang", "source")
#: Leading hex digits of the order key that make a bucket of a leaf's epoch.
DIGITS = 3
#: Leaves up to this number are broadcast to the documents.
LEAF_BOUND = 100_000
NONE = "(none)"


@dataclass(frozen=True)
class Mix:
    """Target weights by path, ``("web",)`` or ``("web", "en")``; 1 where none is given.

    The budget is ``share_num / share_den`` of the tokens there are.
    """

    domains: dict[str, str] = field(default_factory=dict)
    other_domain: str = "web"
    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    share_num: int = 1
    share_den: int = 2
    max_epochs: int = 3
    seed: int = 17


PRODUCTION = Mix(
    domains={"src1": "reference", "src2": "reference", "src3": "news", "src4": "news", "src5": "news"},
    weights={
        ("reference",): 3,
        ("news",): 3,
        ("web",): 4,
        ("web", "en"): 4,
        ("web", "de"): 2,
        ("web", "fr"): 2,
        ("reference", "en"): 2,
        ("news", "en"): 2,
        ("web", "en", "src0"): 6,
    },
)


def n_words(text: Column) -> Column:
    """Words of a text: the measure of tokens unless another column is given."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, GAP))).cast("long")


def leaf_columns(mix: Mix, source: Column, lang: Column) -> dict[str, Column]:
    named = F.coalesce(source, F.lit(NONE))
    domain = F.lit(mix.other_domain)
    if mix.domains:
        pairs = [F.lit(x) for pair in mix.domains.items() for x in pair]
        domain = F.coalesce(F.try_element_at(F.create_map(*pairs), named), domain)
    return {"domain": domain, "lang": F.coalesce(lang, F.lit(NONE)), "source": named}


def _weight(mix: Mix, path: tuple[str, ...]) -> Column:
    chosen = {k: w for k, w in mix.weights.items() if len(k) == len(path)}
    if not chosen:
        return F.lit(1).cast("long")
    sep = "\x1f"
    pairs = [F.lit(x) for k, w in chosen.items() for x in (sep.join(k), int(w))]
    named = F.try_element_at(F.create_map(*pairs), F.concat_ws(sep, *path))
    return F.coalesce(named, F.lit(1)).cast("long")


def _wide(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (parent, name, ``weight``, ``cap``, ``parent_budget``) with ``budget``.

    Children are put in the order in which they run short when the level rises. One is short if its share of
    what the shorter ones leave is at least what it can take; the others share the rest.
    """
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    ordered = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    everyone = ordered
    ordered = ordered.orderBy(ratio, name)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    later = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = nodes.withColumns(
        {
            "_left": F.col("parent_budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0)),
            "_open": F.sum("weight").over(later),
        }
    )
    short = _wide(F.col("cap")) * _wide(F.col("_open")) <= _wide(F.col("weight")) * _wide(F.col("_left"))
    marked = ranked.withColumn("_short", short)
    rest = F.col("parent_budget") - F.sum(F.when(F.col("_short"), F.col("cap")).otherwise(0)).over(everyone)
    open_weight = F.sum(F.when(~F.col("_short"), F.col("weight")).otherwise(0)).over(everyone)
    summed = marked.withColumns({"_rest": F.greatest(rest, F.lit(0)), "_weights": open_weight})
    part = F.expr("cast(weight as decimal(19,0)) * cast(_rest as decimal(19,0)) div cast(_weights as decimal(19,0))")
    budget = F.when(F.col("_short"), F.col("cap")).when(F.col("_weights") > 0, part.cast("long"))
    return summed.withColumn("budget", F.coalesce(budget, F.lit(0))).drop(
        "_left", "_open", "_short", "_rest", "_weights", "parent_budget"
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (the three levels and ``tokens``) with ``budget``, ``epochs`` whole ones and ``rest`` of the next."""
    capped = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    share = F.expr(f"cast(sum(tokens) * {mix.share_num} div {mix.share_den} as bigint)")
    total = capped.agg(share.alias("budget"))
    done: DataFrame | None = None
    for depth, name in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        parent = path[:-1]
        nodes = capped.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        weighed = nodes.withColumn("weight", _weight(mix, tuple(path)))
        if done is None:
            above = weighed.withColumn("parent_budget", total.scalar())
        else:
            above = weighed.join(done.withColumnRenamed("budget", "parent_budget"), parent)
        shared = share_out(above, parent, name)
        done = shared.select(*path, "budget")
    whole = F.expr("case when tokens > 0 then budget div tokens else 0 end").cast("long")
    planned = shared.select(*LEVELS, "tokens", "budget", whole.alias("epochs"))
    return planned.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def order_key(mix: Mix, epoch: Column, doc_id: Column, text_key: Column) -> Column:
    """Where a document stands in an epoch of its leaf."""
    name = F.coalesce(doc_id.cast("string"), text_key)
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), name))


def _with_plan(rows: DataFrame, plan: DataFrame, n_leaves: int) -> DataFrame:
    side = F.broadcast(plan) if n_leaves <= LEAF_BOUND else plan
    return rows.join(side, list(LEVELS))


def plan_cuts(slim: DataFrame, mix: Mix, work: Workspace) -> tuple[DataFrame, int]:
    """For each leaf the whole ``epochs`` and ``cut``, the last order key that fits into the next one.

    ``slim`` has the levels, ``n_tokens``, ``doc_id`` and ``text_key``. A leaf may hold most documents, so its
    order is cut into buckets by the key's first digits: sums by bucket find the one where the budget ends, and
    only this bucket's documents are put in order.
    """
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = work.keep(leaf_budgets(leaves, mix), "leaf_budgets")
    n_leaves = budgets.count()
    key = order_key(mix, F.col("epochs"), F.col("doc_id"), F.col("text_key"))
    opened = _with_plan(slim, budgets.filter("rest > 0").select(*LEVELS, "epochs", "rest"), n_leaves)
    keyed = opened.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, DIGITS))
    sums = keyed.groupBy(*LEVELS, "rest", "_bucket").agg(F.sum("n_tokens").alias("_in"))
    before = Window.partitionBy(*LEVELS).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    ends = running.filter("_before <= rest and rest < _before + _in").select(*LEVELS, "_bucket", "_before")
    inside = _with_plan(keyed, ends.withColumnRenamed("_bucket", "_end"), n_leaves).filter("_bucket = _end")
    up_to = Window.partitionBy(*LEVELS).orderBy("_key")  # rows of one key together
    taken = inside.withColumn("_sum", F.sum("n_tokens").over(up_to) + F.col("_before"))
    last = taken.filter("_sum <= rest").groupBy(*LEVELS).agg(F.max("_key").alias("_last"))
    cuts = (
        budgets.join(ends, list(LEVELS), "left")
        .join(last, list(LEVELS), "left")
        .withColumn("cut", F.when(F.col("rest") > 0, F.coalesce("_last", "_bucket")))
        .select(*LEVELS, "budget", "epochs", "cut")
    )
    return work.keep(cuts, "cuts"), n_leaves


def choose(docs: DataFrame, mix: Mix = PRODUCTION, tokens: Column | None = None) -> DataFrame:
    """The chosen rows, whole in ``row``, with ``domain``, ``n_tokens`` and ``copies``, how many epochs have them.

    Rows are kept in a column of their own, so no name of theirs is in the way. Texts are read once for counting and
    once for the result; between, only ids and counts are kept. The result needs no shuffle: a row compares its own
    key with its leaf's cut.
    """
    work = Workspace(docs.sparkSession)
    measure = tokens if tokens is not None else n_words(F.col("text"))
    leaf = leaf_columns(mix, F.col("source"), F.col("lang"))
    text_key = F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    needed = {"doc_id": F.col("doc_id"), "text_key": F.when(F.col("doc_id").isNull(), text_key), **leaf, "n_tokens": measure}
    columns = [column.alias(name) for name, column in needed.items()]
    cuts, n_leaves = plan_cuts(work.keep(docs.select(*columns), "measured"), mix, work)
    plan = cuts.select(*LEVELS, "epochs", "cut").filter("epochs > 0 or cut is not null")
    plan = plan.withColumnsRenamed({name: f"cut_{name}" for name in LEVELS})
    side = F.broadcast(plan) if n_leaves <= LEAF_BOUND else plan
    rows = docs.select(F.struct("*").alias("row"), *columns)
    same = [F.col(name).eqNullSafe(F.col(f"cut_{name}")) for name in LEVELS]
    joined = rows.join(side, same[0] & same[1] & same[2])
    key = order_key(mix, F.col("epochs"), F.col("doc_id"), F.col("text_key"))
    fits = F.coalesce(key <= F.col("cut"), F.lit(False)).cast("int")
    counted = joined.withColumn("copies", F.col("epochs").cast("int") + fits)
    return counted.filter("copies > 0").select("row", "domain", "n_tokens", "copies")


def mix_documents(docs: DataFrame, mix: Mix = PRODUCTION, tokens: Column | None = None) -> DataFrame:
    """The chosen rows with their columns, and with ``domain``, ``n_tokens`` and ``copies`` in place of input columns of
    these names; ``choose`` keeps the latter."""
    added = ("domain", "n_tokens", "copies")
    chosen = choose(docs, mix, tokens)
    return chosen.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


def digest(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """The chosen documents by id, with the leaf that each is in."""
    chosen = mix_documents(docs.select("doc_id", "text", "lang", "source"), mix)
    named = [F.coalesce(name, F.lit(NONE)).alias(name) for name in ("lang", "source")]
    return chosen.select("doc_id", "domain", *named, "n_tokens", "copies")
