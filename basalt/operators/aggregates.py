"""Facets, modes, evidence summaries, islands, sets, contacts and graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.functions.scalar import distance
from basalt.operators.best import first_per_key
from basalt.operators.selection import upper_median  # noqa: F401
from basalt.operators.sets import jaccard_pairs  # noqa: F401


def facet(df: DataFrame, value: str, least: int = 1, limit: int = 10) -> DataFrame:
    """Rows (value, n), commonest first, then by value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least).orderBy(F.desc("n"), "value").limit(limit)


def mode_quorum(df: DataFrame, keys: list[str], value: str, quorum: float = 0.5) -> DataFrame:
    """The commonest value of each key, the smallest on ties, or null below the quorum."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    total = df.groupBy(*keys).agg(F.count("*").alias("total"))
    best = first_per_key(counts, keys, [F.desc("n"), F.col(value)])
    return total.join(best, keys, "left").select(*keys, F.when(F.col("n") >= quorum * F.col("total"), F.col(value)).alias("mode"), F.coalesce("n", F.lit(0)).alias("n"), "total")


def resistance_evidence(mechanism: Column, only_target: Column, rows: Column) -> Column:
    """1 if any row names a mechanism, 0 if all only name a target, else one half."""
    return F.when(F.max(mechanism.cast("int")) == 1, 1.0).when(F.min(only_target.cast("int")) == 1, 0.0).when(F.count(rows) > 0, 0.5).otherwise(0.0)


def islands(df: DataFrame, keys: list[str], position: str, inside: Column, value: str) -> DataFrame:
    """Runs of consecutive positions where ``inside`` holds: first, last, length and mean."""
    picked = df.where(inside)
    group = F.col(position) - F.row_number().over(W.partitionBy(*keys).orderBy(position))
    runs = picked.withColumn("_island", group).groupBy(*keys, "_island")
    return runs.agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("length"), F.avg(value).alias("mean")).drop("_island")


def contacts(left: DataFrame, right: DataFrame, structure: str, radius: float, axes: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """Pairs of points of one structure within ``radius``: right points are put in all cells
    around theirs, left ones in their own, and the join is on structure and cell."""
    cell = lambda c, shift=0: (F.floor(F.col(c) / radius) + shift).cast("long")
    cells = [f"_{c}" for c in axes]
    a = left.select(*left.columns, *(cell(c).alias(f"_{c}") for c in axes))
    b = right.select(*(F.col(c).alias(f"{c}_2") if c != structure else F.col(c) for c in right.columns))
    for c in axes:
        b = b.withColumn(f"_{c}", F.explode(F.array(*((F.floor(F.col(f"{c}_2") / radius) + s).cast("long") for s in (-1, 0, 1)))))
    gap = distance(tuple(F.col(c) for c in axes), tuple(F.col(f"{c}_2") for c in axes))
    return a.join(b, [structure, *cells]).withColumn("distance", gap).where(F.col("distance") <= radius).drop(*cells)


def upsert_nodes(rows: DataFrame) -> DataFrame:
    """First row of every node id by ``pos``, its name filled by the first that is not blank.

    Columns beside id, type, name and pos are the first row's, too. One shuffle: a node that many
    rows mention is reduced before it."""
    others = [c for c in rows.columns if c not in ("id", "name")]
    named = F.when(F.trim(F.coalesce("name", F.lit(""))) != "", F.col("pos"))
    found = rows.groupBy("id").agg(F.min_by(F.struct(*others), "pos").alias("first"), F.min_by("name", named).alias("name"))
    return found.select("id", *(F.col(f"first.{c}").alias(c) for c in others), "name")


def checks_pass(checks: Column) -> Column:
    return F.forall(checks, lambda c: F.coalesce(c["passed"], F.lit(False)))


def check(metric: str, value: Column, op: str, threshold: float) -> Column:
    """One entry of a quality gate."""
    passed = (value >= threshold) if op == ">=" else (value <= threshold)
    return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"), F.lit(op).alias("op"), F.lit(float(threshold)).alias("threshold"), F.coalesce(passed, F.lit(False)).alias("passed"))


def failed_reasons(checks: Column) -> Column:
    failed = F.filter(checks, lambda c: ~c["passed"])
    return F.array_join(F.transform(failed, lambda c: F.concat(c["metric"], F.lit(" "), c["op"], F.lit(" fails"))), "; ")
