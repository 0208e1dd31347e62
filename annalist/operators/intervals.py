"""The hierarchy as intervals: everyone below a manager is a range of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.operators.hierarchy import cycles
from annalist.operators.keys import dense_keys
from annalist.operators.skew import HOT_ROWS
from annalist.sources.scratch import materialize, materialize_counting


def subtree_intervals(edges: DataFrame, key: str, manager: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, parent, level, enter, leave, cycle) of everyone, managers without an edge included.

    A walk around the tree enters and leaves every node once; ``enter`` and ``leave`` are the steps. So
    ``b`` is below ``a`` exactly when ``a.enter < b.enter AND b.leave < a.leave``, at ``b.level - a.level``
    levels, and ``(leave - enter - 1) / 2`` people are below a node. Rows have constant width; no path
    or list of people exists at any time.

    The walk is a linked list: a node's entry leads to its first report's entry or to its own exit, an
    exit to the next report of the same manager or to the manager's exit. Places in the list are found by
    pointers that double their length each round, whatever the depth. Siblings stand side by side in one
    numbering of all edges, and only the last of them asks for the manager, so a manager with very many
    reports is no hot key. ``edges`` holds one row per employee. A cycle has no top: its smallest member
    is made one, is marked by ``cycle``, and the edge above it is left out.
    """
    tops = cycles(edges, key, manager, hot_rows).where("node = cycle")
    tops = materialize(tops, "cycle-tops")
    own = edges.where(F.col(manager).isNotNull()).select(F.col(key).alias("node"), F.col(manager).alias("parent"))
    own = own.join(tops.select("node"), "node", "left_anti")
    everyone = own.select("node").unionByName(own.select(F.col("parent").alias("node"))).unionByName(tops.select("node"))
    everyone = everyone.unionByName(edges.select(F.col(key).alias("node"))).distinct()
    first = everyone.join(own.select("node"), "node", "left_anti").withColumn("parent", F.lit(None).cast(own.schema["parent"].dataType))
    placed = materialize(dense_keys(own.unionByName(first), ["parent", "node"], "_p"), "siblings")

    following = placed.select((F.col("_p") - 1).alias("_p"), F.col("parent").alias("_of"), F.lit(True).alias("_more"))
    reports = placed.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.min("_p").alias("_first"))
    rows = placed.join(following, "_p", "left").join(reports, "node", "left")
    rows = rows.withColumn("_sibling", F.coalesce("_more", F.lit(False)) & F.col("parent").eqNullSafe(F.col("_of")))
    last = rows.where(~F.col("_sibling") & F.col("parent").isNotNull()).select("_p", "parent")
    above = last.join(placed.select(F.col("node").alias("parent"), F.col("_p").alias("_up")), "parent").select("_p", "_up")
    rows = rows.join(above, "_p", "left")
    into, out = 2 * F.col("_p"), 2 * F.col("_p") + 1
    steps = F.array(
        F.struct(into.alias("id"), F.coalesce(2 * F.col("_first"), out).alias("next"), F.lit(1).cast("long").alias("far"), F.lit(1).cast("long").alias("rise")),
        F.struct(
            out.alias("id"), F.when(F.col("_sibling"), into + 2).otherwise(2 * F.col("_up") + 1).alias("next"),
            F.lit(1).cast("long").alias("far"), F.lit(-1).cast("long").alias("rise"),
        ),
    )
    state, open_ = materialize_counting(rows.select(F.inline(steps)), "walk", "next IS NOT NULL")
    while open_:
        onward = state.select(F.col("id").alias("next"), F.col("next").alias("_next"), F.col("far").alias("_far"), F.col("rise").alias("_rise"))
        going = state.where("next IS NOT NULL").join(onward, "next")
        going = going.select("id", F.col("_next").alias("next"), (F.col("far") + F.col("_far")).alias("far"), (F.col("rise") + F.col("_rise")).alias("rise"))
        state, open_ = materialize_counting(state.where("next IS NULL").unionByName(going), "walk", "next IS NOT NULL")
    # ``far`` counts the steps up to the end; tops follow each other, so there is one end.
    total = state.agg(F.max("far")).first()[0] or 0
    place = (F.lit(total) - F.col("far") + 1).alias("place")
    entered = state.where("id % 2 = 0").select(F.shiftright("id", 1).alias("_p"), place.alias("enter"), (-F.col("rise")).alias("level"))
    left = state.where("id % 2 = 1").select(F.shiftright("id", 1).alias("_p"), place.alias("leave"))
    found = placed.join(entered, "_p").join(left, "_p").join(tops, "node", "left")
    return found.select("node", "parent", "level", "enter", "leave", "cycle")


def below(intervals: DataFrame, enter: int, leave: int) -> DataFrame:
    """Everyone below the node with this interval, by a range that storage can skip by."""
    return intervals.where((F.col("enter") > enter) & (F.col("leave") < leave))
