"""The element of a given rank in groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Cuts that a sketch gives and its accuracy, and different values of a key that are put in order in
#: one task at most.
CUTS, ACCURACY, SORTED_VALUES = 256, 4096, 100_000


def upper_median(df: DataFrame, keys: list[str], value: str, sorted_values: int = SORTED_VALUES) -> DataFrame:
    """Rows (keys, median, n): the element at half the count of a key's sorted values, the upper one
    of two middles. ``value`` is a number, a date or a time; nulls do not count, a null key is a key.

    Quantile sketches, merged from all tasks, bound the value from both sides; exact counts of the
    values below the bounds say which element of those between is sought. Only while a key has more
    different values between its bounds than ``sorted_values`` are the bounds drawn closer."""
    rows = df.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("_k"), F.col(value).alias("_v"))
    goal = rows.groupBy("_k").agg(F.count("*").alias("n")).withColumn("_left", F.expr("n div 2 + 1"))
    inside = rows
    while True:
        sizes = inside.groupBy("_k").agg(F.count("*").alias("_size"), F.percentile_approx("_v", [k / CUTS for k in range(CUTS + 1)], ACCURACY).alias("_cuts"))
        # A sketch errs by far less than the two cuts that are left free on either side.
        at = F.floor((F.col("_left") - 1) * CUTS / F.col("_size")).cast("int")
        low = F.when(F.col("_at") >= 2, F.element_at("_cuts", F.greatest(F.lit(1), F.col("_at") - 1)))
        high = F.when(F.col("_at") <= CUTS - 4, F.element_at("_cuts", F.least(F.lit(CUTS + 1), F.col("_at") + 4)))
        bounds = goal.join(sizes, "_k").withColumn("_at", at).select("_k", "n", "_left", low.alias("_low"), high.alias("_high"))
        marked = inside.join(bounds, "_k")
        below = F.coalesce(F.col("_v") < F.col("_low"), F.lit(False))
        within = ~below & ~F.coalesce(F.col("_v") > F.col("_high"), F.lit(False))
        counts = marked.groupBy("_k", "n", "_left").agg(F.count_if(below).alias("_under"), F.count_if(within).alias("_size"))
        goal = counts.select("_k", "n", (F.col("_left") - F.col("_under")).alias("_left"), "_size")
        inside = marked.where(within).select("_k", "_v")
        counted = inside.groupBy("_k", "_v").agg(F.count("*").alias("_here"))
        most = counted.groupBy("_k").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if not goal.where("_left < 1 or _left > _size").isEmpty():
            raise RuntimeError("a quantile sketch erred by more than its bound")
        goal = goal.drop("_size")
        if most <= sorted_values:
            break
    upto = counted.withColumn("_upto", F.sum("_here").over(W.partitionBy("_k").orderBy("_v")))
    placed = upto.join(goal, "_k").where("_upto - _here < _left and _upto >= _left")
    return placed.select("_k.*", F.col("_v").alias("median"), "n")
