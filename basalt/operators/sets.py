"""Shared members of groups, without a row for every pair of a member's holders."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A member of at most so many groups is paired in place; others meet in tiles of so many groups
#: and members a side.
FEW_HOLDERS, TILE_GROUPS, TILE_MEMBERS = 8, 256, 4096


def _tile(rows: pa.Table) -> pa.Table:
    """Shared members of all pairs of groups from the two blocks of a tile."""
    a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
    groups = rows.column("group").combine_chunks().dictionary_encode()
    members = rows.column("member").combine_chunks().dictionary_encode()
    held = np.zeros((len(groups.dictionary), len(members.dictionary)), np.float32)
    held[np.asarray(groups.indices), np.asarray(members.indices)] = 1
    block = np.empty(len(groups.dictionary), np.int64)
    block[np.asarray(groups.indices)] = rows.column("block").to_numpy()
    left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
    shared = np.rint(held[left] @ held[right].T).astype(np.int64)
    if a == b:
        shared = np.triu(shared, 1)
    i, j = np.nonzero(shared)
    return pa.table({"g": groups.dictionary.take(left[i]), "h": groups.dictionary.take(right[j]), "shared": shared[i, j]})


def shared_members(sets: DataFrame, group: str, member: str) -> DataFrame:
    """Rows (a, b, shared) with a < b of all groups that have members in common; ``sets`` has
    different rows (group, member) without nulls.

    A member that m groups hold would make m * m rows in a join of its holders. Up to
    ``FEW_HOLDERS`` they are listed and paired; the holders of all others are sent, once for each
    block of groups, into tiles that multiply two blocks' members at once."""
    rows = sets.select(F.col(group).alias("group"), F.col(member).alias("member"))
    holders = rows.groupBy("member").agg(F.count("*").alias("m"))
    marked = rows.join(holders.where("m > 1"), "member")

    listed = marked.where(F.col("m") <= FEW_HOLDERS).groupBy("member").agg(F.array_sort(F.collect_list("group")).alias("g"))
    pairs = F.flatten(F.transform("g", lambda x, i: F.transform(F.slice("g", i + 2, F.size("g")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    few = listed.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("shared"))

    many = marked.where(F.col("m") > FEW_HOLDERS)
    sizes = many.agg(F.count_distinct("group").alias("g"), F.count_distinct("member").alias("m")).first()
    blocks, chunks = max(1, -(-sizes["g"] // TILE_GROUPS)), max(1, -(-sizes["m"] // TILE_MEMBERS))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    sent = many.select("group", "member", deal("group", blocks).alias("block"), deal("member", chunks).alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    dealt = sent.select("group", "member", "block", "chunk", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    kind = sets.schema[group].dataType.simpleString()
    met = dealt.groupBy("a", "b", "chunk").applyInArrow(_tile, f"g {kind}, h {kind}, shared long")
    tiled = met.groupBy(F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b")).agg(F.sum("shared").alias("shared"))
    return few.unionByName(tiled).groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def jaccard_pairs(df: DataFrame, group: str, member: str) -> DataFrame:
    """Rows (a, b, shared, distance) of groups with a member in common, a < b; nulls are no
    members and repeated rows count once."""
    sets = df.where(F.col(member).isNotNull() & F.col(group).isNotNull()).select(group, member).distinct()
    sizes = sets.groupBy(group).agg(F.count("*").alias("n"))
    shared = shared_members(sets, group, member)
    with_sizes = shared.join(sizes.select(F.col(group).alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col(group).alias("b"), F.col("n").alias("nb")), "b")
    return with_sizes.select("a", "b", "shared", (1 - F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("distance"))
