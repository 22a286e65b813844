"""Section tables, filtered views and text outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_section(df: DataFrame, root: str, name: str, run: str) -> None:
    """Replace one section of one run; other runs and sections stay as they are."""
    partitioned = df.withColumn("run_id", F.lit(run)).write.mode("overwrite").partitionBy("run_id")
    partitioned.option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{name}")


def write_views(df: DataFrame, root: str, views: dict[str, Column], columns: list[str]) -> None:
    """Tab-separated files, each with the rows of one condition; unknown flags are empty."""
    flat = [F.array_join(c, ";").alias(c) if df.schema[c].dataType.typeName() == "array" else F.col(c).cast("string").alias(c) for c in columns]
    for name, condition in views.items():
        df.where(condition).select(*flat).write.mode("overwrite").csv(f"{root}/{name}", sep="\t", header=True, nullValue="", emptyValue="")


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Rows (key, rule) for every rule that a row breaks; a null outcome breaks it too."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(test, F.lit(False)), name) for name, test in rules.items())), lambda x: x.isNotNull())
    return df.select(key, F.explode(broken).alias("rule"))
