"""Connected components of a distributed edge table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import cut, discard


def _image(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """The edges between the places to which ``moves`` (node, root) takes their ends."""
    to_root = moves.select(F.col("node").alias("old"), F.col("root").alias("new"))
    ends = edges.join(to_root, edges["a"] == to_root["old"], "left").select(F.coalesce("new", "a").alias("a"), "b")
    ends = ends.join(to_root, ends["b"] == to_root["old"], "left").select("a", F.coalesce("new", "b").alias("b"))
    return ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node of ``edges``; ``root`` is the smallest node reachable.

    Distributed union-find: every node hooks to its smallest smaller neighbour, pointers are
    doubled, and the edges are replaced by those between the nodes' new places, until no edge is
    left; at the end the rounds' moves are chained. The image of a connected graph is connected,
    so nothing falls apart on the way. Minima are pre-aggregated, so a node with very many edges
    costs no more than others. Edges with a null end and loops are ignored; an empty table gives
    an empty result.
    """
    left, right = F.least(a, b), F.greatest(a, b)
    wanted = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    live = cut(wanted.select(left.alias("a"), right.alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        hooks = cut(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        moves = cut(hooks.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root")))
        left_over = cut(_image(live, moves))
        discard(live, hooks)
        live = left_over
        rounds.append(moves)
    if not rounds:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = rounds.pop()
    while rounds:
        earlier, later = rounds.pop(), labels.select(F.col("node").alias("root"), F.col("root").alias("last"))
        chained = cut(earlier.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")).unionByName(labels).distinct())
        discard(earlier, labels)
        labels = chained
    # Roots moved nowhere; they get their own row.
    return labels.unionByName(labels.select(F.col("root").alias("node"), "root").distinct())
