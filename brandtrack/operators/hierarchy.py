"""Hierarchies of any depth: each place with all places above it, so that a group may ask for a category of any level."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..params import TWO_LEVEL_PRODUCT, ReportParams
from ..sources.tables import Tables
from .sizing import Lookup, attach, count_rows

#: Writes a table under a name and returns the written one.
Publish = Callable[[DataFrame, str], DataFrame]
#: The level of the category that the two-level product asks for besides its own.
DEEPER_LEVEL = 3


@dataclass(frozen=True)
class Hierarchy:
    """A hierarchy as a graph.

    ``edges`` are ``(node, parent)``, in any number and of any depth; a node may have several parents and belongs to
    all of them. ``places`` are ``(node, depth, code)``, the level and the code by which a list names a node, and
    ``homes`` are ``(trade_item_key, node)``, the lowest node of each item. Nodes may be of any type.
    """

    homes: DataFrame
    edges: DataFrame
    places: DataFrame


def _node_limit(params: ReportParams) -> int:
    """The most nodes, or pairs of them, to broadcast: a path of codes is wider than the rows ``broadcast_rows`` is meant for."""
    return params.broadcast_rows // 8


def from_levels(table: DataFrame, levels: Mapping[int, str], publish: Publish) -> Hierarchy:
    """The hierarchy of a table with one column a level, deeper levels having higher numbers.

    A node is the path of codes down to it, so a code that occurs below two others is two nodes, each with the items of its
    own rows. A level without code is left out of an item's path. The nodes are written once.
    """
    steps = [
        F.struct(F.lit(depth).alias("depth"), F.col(column).cast("string").alias("code"))
        for depth, column in sorted(levels.items())
    ]
    path = F.filter(F.array(*steps), lambda step: step["code"].isNotNull())
    homes = table.select("trade_item_key", path.alias("node")).filter(F.size("node") > 0)
    parts = F.transform(F.sequence(F.lit(1), F.size("node")), lambda n: F.slice("node", F.lit(1), n))
    nodes = publish(homes.select("node").distinct().select(F.explode(parts).alias("node")).distinct(), "hierarchy_nodes")
    upper = F.slice("node", F.lit(1), F.size("node") - 1)
    return Hierarchy(
        homes=homes,
        edges=nodes.filter(F.size("node") > 1).select("node", upper.alias("parent")),
        places=nodes.select("node", F.element_at("node", -1)["depth"].alias("depth"), F.element_at("node", -1)["code"].alias("code")),
    )


def ancestors(edges: DataFrame, publish: Publish, params: ReportParams) -> DataFrame:
    """Every node with every node above it: ``(node, above)``, each pair once.

    Known paths are joined end to end, so their length doubles in each round and a hierarchy of n levels takes about log n
    rounds. Each is written and counted while it is written; the rounds end when no pair is new. A node above itself is an
    error, as is then every path through it. Edges without node or parent say nothing.
    """
    step = edges.select("node", F.col("parent").alias("above")).dropna().distinct()
    known = -1
    for turn in count():
        watch = Observation(f"paths of round {turn}")
        loops = F.count_if(F.col("node") == F.col("above")).alias("loops")
        paths = publish(step.observe(watch, F.count(F.lit(1)).alias("n"), loops), f"paths_{turn}")
        if watch.get["loops"]:
            raise ValueError(f"{watch.get['loops']} places of the hierarchy are above themselves")
        if watch.get["n"] == known:
            return paths
        known = watch.get["n"]
        ends = Lookup(paths.select(F.col("node").alias("via"), "above"), known, known <= _node_limit(params))
        longer = attach(paths.withColumnRenamed("above", "via"), ends, ["via"], params.salts)
        step = paths.union(longer.select("node", "above")).distinct()


def places_above(hierarchy: Hierarchy, publish: Publish, params: ReportParams) -> DataFrame:
    """Each node with itself and all nodes above: ``(node, above)``."""
    itself = hierarchy.places.select("node", F.col("node").alias("above")).distinct()
    return itself.union(ancestors(hierarchy.edges, publish, params))


def wishes(conv: DataFrame, depths: Mapping[int, str]) -> DataFrame:
    """The distinct categories the list asks for, ``depths`` naming the list's column of each level.

    A row asks for the code of its own level. The two-level product asks for the deeper level whatever its own, and a row of
    that level must name its product, as in ``category``.
    """
    level, product = F.col("levelflag"), F.col("productname")

    def asks(condition, depth):
        code = F.col(depths[depth])
        return F.when(condition, F.struct(code.alias("hier_cd"), F.lit(depth).alias("depth"), code.cast("string").alias("code")))

    own = {d: (level == d) & (product != TWO_LEVEL_PRODUCT) if d == DEEPER_LEVEL else level == d for d in depths}
    asked = [asks(rule, depth) for depth, rule in own.items()]
    if DEEPER_LEVEL in depths:
        asked.append(asks(product == TWO_LEVEL_PRODUCT, DEEPER_LEVEL))
    return conv.select("grpnum", "levelflag", F.inline(F.array_compact(F.array(*asked)))).distinct()


def granted_nodes(asked: DataFrame, hierarchy: Hierarchy, publish: Publish, params: ReportParams) -> DataFrame:
    """Each node with whoever asks for it or for a node above it, written once. No item is touched yet."""
    sizes = count_rows(params.broadcast_rows, asked=asked)
    named = attach(hierarchy.places.withColumnRenamed("node", "above"), sizes["asked"], ["depth", "code"], params.salts)
    named = publish(named.select("above", "grpnum", "levelflag", "hier_cd").distinct(), "named_nodes")
    lookup = count_rows(_node_limit(params), named=named)["named"]
    below = attach(places_above(hierarchy, publish, params), lookup, ["above"], params.salts)
    return publish(below.select("node", "grpnum", "levelflag", "hier_cd").distinct(), "granted_nodes")


def category_of_any_level(
    conv: DataFrame, hierarchy: Hierarchy, depths: Mapping[int, str], tables: Tables, params: ReportParams, publish: Publish
) -> DataFrame:
    """Every code of every group's category, at whatever level the group names it, and the listed codes.

    An item has one row, its lowest node; it is not repeated for the levels above. With levels 2 and 3 alone this equals
    ``category.category_upcs``.
    """
    granted = granted_nodes(wishes(conv, depths), hierarchy, publish, params)
    lookup = count_rows(_node_limit(params), granted=granted)["granted"]
    owned = tables.item.filter(F.col("lgl_entity_nbr") == params.owner)
    found = attach(hierarchy.homes, lookup, ["node"], params.salts).join(owned, "trade_item_key")
    found = found.select(F.col("trade_item_cd").alias("upc"), "grpnum", "levelflag", "hier_cd")
    own = F.coalesce(*[F.when(F.col("levelflag") == depth, F.col(column)) for depth, column in depths.items()])
    return found.union(conv.select("upc", "grpnum", "levelflag", own.alias("hier_cd"))).distinct()
