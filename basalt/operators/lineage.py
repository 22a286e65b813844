"""Trees of parent links: ancestors, lineage texts and the first level that knows something."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.operators.best import first_per_key
from basalt.operators.staging import staged

#: Doublings after which links must have come to an end: deeper than any tree that is none.
MOST_DOUBLINGS = 20


def ancestors(links: DataFrame, node: str, parent: str) -> DataFrame:
    """Rows (node, ancestor, distance): every node with itself at 0, its parent at 1 and so on.

    ``links`` has one row a node; a null parent, and one that has no row of its own, ends the way.
    Ways double from round to round, so a tree of depth d takes log d rounds; links that run in a
    circle are an error."""
    known = links.select(F.col(node).alias("node"), F.col(parent).alias("up")).where("node is not null")
    alive = known.select(F.col("node").alias("up"))
    jumps = staged(known.join(alive, "up", "left_semi").select("node", F.col("up").alias("to")))
    ways = known.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
    for step in range(MOST_DOUBLINGS + 1):
        if jumps.isEmpty():
            return ways
        if step == MOST_DOUBLINGS:
            break
        further = jumps.join(ways.withColumnRenamed("node", "to"), "to").select("node", "ancestor", (F.col("distance") + (1 << step)).alias("distance"))
        ways = staged(ways.unionByName(further))
        jumps = staged(jumps.join(jumps.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to")))
    raise ValueError("the links run in a circle")


def lineage_text(links: DataFrame, node: str, parent: str, name: str, between: str = " > ") -> DataFrame:
    """Rows (node, lineage, depth): the names from the root down to the node, of any depth."""
    ways = ancestors(links, node, parent)
    named = ways.join(links.select(F.col(node).alias("ancestor"), F.col(name).alias("name")), "ancestor")
    down = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("k"), "name"))), lambda x: F.coalesce(x["name"], F.lit("")))
    return named.groupBy("node").agg(F.array_join(down, between).alias("lineage"), F.max("distance").alias("depth"))


def first_level(asked: DataFrame, links: DataFrame, node: str, parent: str, evidence: DataFrame, on: str, levels: int | None = None) -> DataFrame:
    """Rows (node, level, matched): for each node that ``asked`` lists, the nearest of itself and its
    ancestors for which ``evidence`` has a row in the column ``on``; nodes without any are absent.
    With ``levels`` only so many are tried, the node itself being the first."""
    ways = ancestors(links, node, parent).join(asked.select(F.col(node).alias("node")).distinct(), "node", "left_semi")
    if levels is not None:
        ways = ways.where(F.col("distance") < levels)
    met = ways.join(evidence.select(F.col(on).alias("ancestor")).distinct(), "ancestor", "left_semi")
    return first_per_key(met, ["node"], [F.col("distance")]).select("node", F.col("distance").alias("level"), F.col("ancestor").alias("matched"))


def at_rank(asked: DataFrame, links: DataFrame, node: str, parent: str, rank: str, wanted: Column) -> DataFrame:
    """Rows (node, called): the ancestor of the wanted rank, itself included, nearest first; a node
    whose lineage has no such rank gets null. ``wanted`` is a column of ``asked``."""
    want = asked.select(F.col(node).alias("node"), wanted.alias("wanted"))
    ways = ancestors(links, node, parent).join(links.select(F.col(node).alias("ancestor"), F.col(rank).alias("rank")), "ancestor")
    met = ways.join(want, "node").where("rank = wanted")
    return want.join(first_per_key(met, ["node"], [F.col("distance")]).select("node", F.col("ancestor").alias("called")), "node", "left").select("node", "called")
