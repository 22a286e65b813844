"""Ranks over whole tables, by ranges of the order instead of one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.operators.staging import staged

#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33


def in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with ``place``, the number of each row in ``order`` from 1; end ``order`` in something
    unique.

    Rows are dealt by ranges of the whole order and sorted there, so that equal leading values part
    as well; the rows are written with their number in their range. All that meets on the driver is
    one count for each range."""
    if "place" in df.columns:
        raise ValueError("there is a column place already")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    held = staged(ranged)
    part = F.shiftright("place", _ROW_BITS)
    sizes = {r["part"]: r["n"] for r in held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    parts = sorted(sizes)
    before = dict(zip(parts, accumulate((sizes[p] for p in parts), initial=0)))
    offsets = F.array(*(F.lit(before.get(p, 0)).cast("long") for p in range(max(parts, default=0) + 1)))
    return held.withColumn("place", F.get(offsets, part.cast("int")) + F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1)


def rank_and_select(df: DataFrame, order: list[Column], n: int | None, disqualified: Column) -> DataFrame:
    """``rank`` of all rows and ``selected``, true for the first ``n`` not disqualified, or all of
    them without a number; a disqualified row keeps its rank and its slot passes on. The slots end at the place of the
    ``n``-th such row, which every task finds among its own first ``n``."""
    out = F.coalesce(disqualified, F.lit(False))
    ranked = in_order(df.withColumn("_out", out), order).withColumnRenamed("place", "rank")
    if n is None:
        return ranked.withColumn("selected", ~F.col("_out")).drop("_out")
    last = ranked.where(~F.col("_out")).orderBy("rank").limit(n).agg(F.max("rank")).first()[0] or 0
    return ranked.withColumn("selected", ~F.col("_out") & (F.col("rank") <= last)).drop("_out")
