"""Unique names for rows that repeat an id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.operators.ranking import in_order
from basalt.operators.staging import staged


def unique_ids(df: DataFrame, column: str = "feature_id", position: str = "pos") -> DataFrame:
    """``df`` with ``unique_id``: in order of ``position`` (unique), an id as it is where no earlier
    row has that name, or else with the first of ``_2``, ``_3`` … that no earlier row has. Null ids
    stay null.

    Rows of an id are numbered by ranges of the whole order. Only ids that look like another id with
    a number (``a_2`` beside ``a``) can meet a name given to others: whether such an id's first row
    finds its name taken is settled by rounds over those ids alone, until nothing changes."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_id"), F.col(position).alias("_pos"))
    placed = in_order(rows, [F.col("_id"), F.col("_pos")])
    ids = placed.groupBy("_id").agg(F.min("place").alias("_first"), F.min("_pos").alias("_at"))
    numbered = staged(placed.join(ids.select("_id", "_first"), "_id").select("_id", "_pos", (F.col("place") - F.col("_first")).alias("_j")))

    part = lambda k: F.regexp_extract("_id", r"(?s)^(.*)_([1-9][0-9]{0,17})$", k)
    like = ids.select("_id", "_at", part(1).alias("_base"), part(2).try_cast("long").alias("_m")).where("_m >= 2")
    held = like.join(ids.select(F.col("_id").alias("_base")), "_base", "left_semi")
    state = staged(held.withColumn("_taken", F.lit(False)))
    while True:
        own = state.select(F.col("_id").alias("_base"), F.col("_taken").alias("_shift"))
        before = F.sum((~F.col("_taken")).cast("long")).over(W.partitionBy("_base").orderBy("_m").rowsBetween(W.unboundedPreceding, -1))
        aimed = state.join(own, "_base", "left").withColumn("_shift", F.coalesce(F.col("_shift"), F.lit(False)))
        # The row of the base that comes to this number, if all names before it stand.
        aimed = aimed.withColumn("_j", F.col("_m") - 1 - F.coalesce(before, F.lit(0)) - F.col("_shift").cast("long"))
        there = numbered.select(F.col("_id").alias("_base"), "_j", F.col("_pos").alias("_by"))
        tried = aimed.join(there, ["_base", "_j"], "left").withColumn("_now", F.coalesce(F.col("_by") < F.col("_at"), F.lit(False)))
        after = staged(tried.select("_base", "_id", "_at", "_m", "_taken", "_now"))
        if after.where("_taken <> _now").isEmpty():
            break
        state = after.withColumn("_taken", F.col("_now")).drop("_now")

    taken = state.where("_taken").select("_id", F.lit(1).cast("long").alias("_shift"))
    left = state.where("not _taken")
    passed = F.col("_m") - 2 - (F.row_number().over(W.partitionBy("_base").orderBy("_m")) - 1)
    gaps = left.select(F.col("_base").alias("_id"), passed.alias("_g")).groupBy("_id").agg(F.collect_list("_g").alias("_gaps"))
    joined = numbered.join(taken, "_id", "left").join(gaps, "_id", "left")
    given = joined.withColumn("_g", F.col("_j") - 1 + F.coalesce("_shift", F.lit(0)))
    skipped = F.coalesce(F.size(F.filter("_gaps", lambda x: x <= F.col("_g"))), F.lit(0))
    name = F.when(F.col("_g") < 0, F.col("_id")).otherwise(F.concat_ws("_", "_id", (F.col("_g") + 2 + skipped).cast("string")))
    names = given.select(F.col("_pos").alias("_at_pos"), name.alias("unique_id"))
    return df.join(names, df[position] == names["_at_pos"], "left").drop("_at_pos")
