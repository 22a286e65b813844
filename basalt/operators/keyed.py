"""Joins on a canonical key: orphans, merges, aliases, crosswalks and fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.operators.best import first_per_key


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows (key, side) of keys that only one of the tables has."""
    a, b = left.select(key).where(F.col(key).isNotNull()).distinct(), right.select(key).where(F.col(key).isNotNull()).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def refuse(df: DataFrame, reason: Column) -> DataFrame:
    """``df`` as it is; any row with a reason fails the job. The test is a filter, which stays in
    the plan whatever columns are asked for, a bare count included."""
    return df.where(F.when(reason.isNotNull(), F.raise_error(reason).cast("boolean")).otherwise(True))


def once(df: DataFrame, key: Column, mark: str) -> DataFrame:
    """One row for each known key: ``{mark}key``, the row's columns as ``{mark}<name>``, and
    ``{mark}times``, how many rows have the key."""
    rows = df.where(key.isNotNull()).groupBy(key.alias(f"{mark}key"))
    return rows.agg(F.count("*").alias(f"{mark}times"), F.first(F.struct(*(F.col(c).alias(f"{mark}{c}") for c in df.columns))).alias("_row")).select(f"{mark}key", f"{mark}times", "_row.*")


def repeated(mark: str) -> Column:
    """A reason to refuse a row of ``once`` whose key more rows have."""
    return F.when(F.col(f"{mark}times") > 1, F.concat(F.lit("repeated key "), F.col(f"{mark}key").cast("string")))


def keyed_merge(base: DataFrame, update: DataFrame, key: str, append: tuple[str, ...] = ()) -> DataFrame:
    """Merge ``update`` into ``base``: arrays named in ``append`` grow, other columns that the
    update has are replaced where it knows a value. An unknown key is an error, a null one too,
    and so is a key that the update has twice, whatever is read of the result."""
    new = [F.first(F.col(c)).alias(f"_new_{c}") for c in update.columns if c != key]
    fresh = update.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_times"), *new).withColumn("_given", F.lit(True))
    joined = base.withColumn("_known", F.lit(True)).join(fresh, base[key] == fresh["_key"], "full")
    shown = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    joined = refuse(joined, F.when(F.col("_given") & F.col("_known").isNull(), F.concat(F.lit("unknown key "), shown)).when(F.col("_times") > 1, F.concat(F.lit("repeated key "), shown)))
    out = []
    for c in base.columns:
        if c == key or f"_new_{c}" not in joined.columns:
            out.append(F.col(c))
        elif c in append:
            empty = F.array().cast(base.schema[c].dataType)
            out.append(F.concat(F.coalesce(c, empty), F.coalesce(f"_new_{c}", empty)).alias(c))
        else:
            out.append(F.coalesce(f"_new_{c}", c).alias(c))
    out += [F.col(f"_new_{c}").alias(c) for c in update.columns if c not in base.columns]
    return joined.select(*out)


def alias_join(rows: DataFrame, aliases: str, lookup: DataFrame, name: str, key: str) -> DataFrame:
    """Join each row to the lookup row of its first alias that the lookup has; rows without one
    stay, with nulls."""
    each = rows.select(key, F.posexplode(aliases).alias("alias_pos", "alias"))
    hits = each.join(lookup, each["alias"] == lookup[name])
    return rows.join(first_per_key(hits, [key], [F.col("alias_pos"), F.col(name)]), key, "left")


def crosswalk(rows: DataFrame, key: str, routes: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Map keys through ordered routes (name, table, join column, target column): the first that
    knows the row wins, and its name is kept. A join value that a table has twice is an error for
    the rows that meet it."""
    joined, targets = rows, []
    for i, (_, table, on, target) in enumerate(routes):
        side = once(table.select(F.col(on).alias("on"), F.col(target).alias("to")), F.col("on"), f"_{i}_")
        joined = refuse(joined.join(side, joined[on] == side[f"_{i}_key"], "left"), repeated(f"_{i}_"))
        targets.append(f"_{i}_to")
    route = F.coalesce(*(F.when(F.col(t).isNotNull(), name) for t, (name, *_) in zip(targets, routes)), F.lit("unmapped"))
    return joined.select(*rows.columns, F.coalesce(*targets).alias("target"), route.alias("route"))


def dedup_apply(rows: DataFrame, content, work) -> DataFrame:
    """Do ``work`` once for each different content and hand its result to all rows with it."""
    keyed = rows.withColumn("content_key", content)
    done = work(keyed.dropDuplicates(["content_key"]))
    return keyed.join(done, "content_key", "left")


def representatives(rows: DataFrame, content, key: str) -> DataFrame:
    """Rows (key, representative, copies): the smallest key of each content stands for it."""
    keyed = rows.select(key, content.alias("content_key"))
    found = keyed.groupBy("content_key").agg(F.min(key).alias("representative"), F.count("*").alias("copies"))
    return keyed.join(found, "content_key").select(key, "representative", "copies")
