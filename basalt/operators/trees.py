"""Average-linkage trees from a table of similarities, by rounds of mutual nearest pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.operators.best import first_per_key
from basalt.operators.sets import jaccard_pairs
from basalt.operators.staging import staged

#: Leaves of a drawn tree, and the least that a tree needs.
MOST_LEAVES, LEAST_LEAVES = 14, 3


def average_linkage(nodes: DataFrame, distances: DataFrame, text: bool = True) -> tuple[DataFrame, DataFrame]:
    """(joins, roots): rows (left, right, height, size) of all joins, and the trees they end in
    (node, size, height, newick).

    ``nodes`` has different ``node`` values, ``distances`` rows (a, b, distance) once for a pair; a
    pair without a row is at distance 1. Two clusters that are each other's nearest are joined, all
    such pairs of a round at once: averages over pairs of leaves never bring a third cluster nearer,
    so the tree is that of joining one pair at a time. Sums of similarities are kept for pairs that
    have any, so a round costs the links and not the square of the clusters. Ties go to the smaller
    node; a joined cluster bears its smaller node's name. Clusters with nothing in common stay
    apart, as roots of their own: they would meet at height 1/2, see ``newick``."""
    clusters = staged(nodes.select("node", F.lit(1).cast("long").alias("size"), F.lit(0.0).alias("height"), F.col("node").cast("string").alias("newick")))
    near = distances.where("distance < 1 and a <> b").select("a", "b", (1 - F.col("distance")).alias("s"))
    links = staged(near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "s")))
    joins = []
    while not links.isEmpty():
        size = lambda side: clusters.select(F.col("node").alias(side), F.col("size").alias(f"n{side}"))
        mean = links.join(size("a"), "a").join(size("b"), "b").withColumn("mean", F.col("s") / (F.col("na") * F.col("nb")))
        # Ties are broken alike from both sides, by the pair's smaller and then its larger node.
        best = first_per_key(mean, ["a"], [F.desc("mean"), F.least("a", "b"), F.greatest("a", "b")]).select("a", "b", "mean")
        back = best.select(F.col("b").alias("a"), F.col("a").alias("b"))
        pairs = staged(best.join(back, ["a", "b"], "left_semi").where("a < b"))
        joins.append(pairs)
        into = pairs.select(F.col("b").alias("node"), F.col("a").alias("into"))
        to = lambda side: into.select(F.col("node").alias(side), F.col("into").alias(f"to_{side}"))
        moved = links.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"), "s")
        links_next = staged(moved.where("a <> b").groupBy("a", "b").agg(F.sum("s").alias("s")))
        height = (1 - F.col("mean")) / 2
        arm = lambda x: F.format_string("%.6f", F.greatest(F.lit(0.0), height - F.col(f"{x}.height")))
        one = clusters.select("node", "size", "height", "newick")
        grown = pairs.join(one.alias("l"), F.col("a") == F.col("l.node")).join(one.alias("r"), F.col("b") == F.col("r.node"))
        written = F.concat(F.lit("("), F.col("l.newick"), F.lit(":"), arm("l"), F.lit(","), F.col("r.newick"), F.lit(":"), arm("r"), F.lit(")")) if text else F.lit(None).cast("string")
        grown = grown.select(F.col("a").alias("node"), (F.col("l.size") + F.col("r.size")).alias("size"), height.alias("height"), written.alias("newick"))
        gone = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        clusters = staged(clusters.join(gone, "node", "left_anti").unionByName(grown))
        joins[-1] = pairs.join(grown, pairs["a"] == grown["node"]).select(F.col("a").alias("left"), F.col("b").alias("right"), "height", "size")
        links = links_next
    empty = nodes.select(F.col("node").alias("left"), F.col("node").alias("right"), F.lit(0.0).alias("height"), F.lit(0).cast("long").alias("size")).limit(0)
    every = empty
    for part in joins:
        every = every.unionByName(part)
    return every, clusters


def newick(roots: DataFrame) -> DataFrame:
    """One row (newick, leaves): the roots, smaller nodes first, met at height 1/2. For trees of a
    bounded number of leaves."""
    listed = roots.agg(F.array_sort(F.collect_list(F.struct("node", "height", "newick"))).alias("r"), F.sum("size").alias("leaves"))
    arm = lambda x, h: F.format_string("%.6f", F.greatest(F.lit(0.0), F.lit(0.5) - h))
    first = F.get("r", 0)
    start = F.struct(first["newick"].alias("t"), first["height"].alias("h"))
    joined = F.aggregate(
        F.slice("r", 2, F.greatest(F.lit(0), F.size("r") - 1)), start,
        lambda acc, x: F.struct(F.concat(F.lit("("), acc["t"], F.lit(":"), arm(acc, acc["h"]), F.lit(","), x["newick"], F.lit(":"), arm(x, x["height"]), F.lit(")")).alias("t"), F.lit(0.5).alias("h")),
    )
    return listed.where("size(r) > 0").select(F.concat(joined["t"], F.lit(";")).alias("newick"), "leaves")


def tree_leaves(genomes: DataFrame, budget: int = MOST_LEAVES) -> DataFrame:
    """The genomes that a tree spends its leaves on: the query, then species near it that infect
    people, then other neighbours, each by ``pos``, one of a species, at most ``budget``.

    ``genomes`` has node, species, is_query, human (boolean) and pos; ``label`` tells the three
    tiers apart as ``query``, ``pathogen`` and ``other``. The query's own species has its leaf."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    label = F.when(flag("is_query"), "query").when(flag("human"), "pathogen").otherwise("other")
    tier = F.when(F.col("label") == "query", 0).when(F.col("label") == "pathogen", 1).otherwise(2)
    known = genomes.where(F.col("species").isNotNull() | flag("is_query")).withColumn("label", label).withColumn("_tier", tier)
    one = first_per_key(known, ["species"], [F.col("_tier"), F.col("pos"), F.col("node")])
    return one.orderBy("_tier", "pos", "node").limit(budget).drop("_tier")


def gene_content_tree(genomes: DataFrame, families: DataFrame, budget: int = MOST_LEAVES) -> DataFrame:
    """One row (ok, reason, newick, leaves): the tree of the chosen genomes by the families that
    they share. ``families`` has node and family. Genomes without families leave the tree; with
    fewer than ``LEAST_LEAVES`` left there is a reason in its place."""
    chosen = tree_leaves(genomes, budget)
    held = families.where("family is not null").join(chosen.select("node"), "node", "left_semi").select("node", "family")
    nodes = staged(held.select("node").distinct())
    n = nodes.count()
    if n < LEAST_LEAVES:
        text = F.lit(f"only {n} genomes have protein families; a tree needs at least {LEAST_LEAVES}")
        return genomes.sparkSession.range(1).select(F.lit(False).alias("ok"), text.alias("reason"), F.lit(None).cast("string").alias("newick"), F.lit(n).cast("long").alias("leaves"))
    _, roots = average_linkage(nodes, jaccard_pairs(held, "node", "family"))
    return newick(roots).select(F.lit(True).alias("ok"), F.lit("").alias("reason"), "newick", "leaves")
