"""Best row per key, ranking, selection and precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.operators.ranking import rank_and_select


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; end ``order`` in something unique."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], gate: Column, mode: str) -> DataFrame:
    """``gate_then_max``: the best of the rows that pass. ``max_then_gate``: the best row, with
    ``counted`` telling whether it passes; a lesser row that passes does not rescue the key."""
    if mode == "gate_then_max":
        return first_per_key(df.where(gate), keys, order).withColumn("counted", F.lit(True))
    if mode == "max_then_gate":
        return first_per_key(df, keys, order).withColumn("counted", F.coalesce(gate, F.lit(False)))
    raise ValueError(f"unknown mode {mode}")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place.cast("long")).where(F.col("place") <= n)


def rank_select(df: DataFrame, order: list[Column], n: int | None, disqualified: Column, run: list[str] | None = None) -> DataFrame:
    """Rank all rows of a run, or of the table if no run is named; the first ``n`` not disqualified
    (no number: all of them) are selected. A disqualified row keeps its rank and its slot passes on."""
    if not run:
        return rank_and_select(df, order, n, disqualified)
    window = W.partitionBy(*run).orderBy(*order)
    out = F.coalesce(disqualified, F.lit(False))
    taken = F.sum((~out).cast("int")).over(window.rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("rank", F.row_number().over(window).cast("long")).withColumn("selected", ~out if n is None else ~out & (taken <= n))


def select_top(df: DataFrame, order: list[Column], n: int, disqualified: Column) -> DataFrame:
    """Only the selected rows of ``rank_select``, without ranks: each task keeps its first ``n``."""
    return df.where(~F.coalesce(disqualified, F.lit(False))).orderBy(*order).limit(n)


def provider_precedence(calls: DataFrame, keys: list[str], ranks: dict[str, int], source: str = "source", value: str = "value", position: str = "pos") -> DataFrame:
    """The known call of the highest-ranked source, the first listed on ties; rows without a
    value are no calls, so that unknown stays apart from false."""
    rank = F.coalesce(F.create_map(*(F.lit(x) for pair in ranks.items() for x in pair))[F.col(source)], F.lit(0))
    return first_per_key(calls.where(F.col(value).isNotNull()).withColumn("source_rank", rank), keys, [F.desc("source_rank"), F.col(position)])


def first_tier(tiers: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """Union of evidence tiers; for each key the first tier that has it wins."""
    marked = [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)]
    union = marked[0]
    for t in marked[1:]:
        union = union.unionByName(t)
    return first_per_key(union, keys, [F.col("tier"), *order])


def cap_exempt(df: DataFrame, exempt: Column, order: list[Column], cap: int) -> DataFrame:
    """All exempt rows, and of the others the first ``cap``."""
    free = F.coalesce(exempt, F.lit(False))
    return df.where(free).unionByName(df.where(~free).orderBy(*order).limit(cap))


def pick_pockets(df: DataFrame, keys: list[str], least: float, k: int) -> DataFrame:
    """The first ``k`` rows of a key with enough probability, or else its first row."""
    window = W.partitionBy(*keys).orderBy(F.desc("probability"), "pocket")
    placed = df.withColumn("place", F.row_number().over(window)).withColumn("passes", F.col("probability") >= least)
    none = ~F.max("passes").over(W.partitionBy(*keys))
    return placed.withColumn("none", none).where((F.col("passes") & (F.col("place") <= k)) | (F.col("none") & (F.col("place") == 1))).drop("none", "passes")
