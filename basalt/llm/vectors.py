"""What the vector operators share: clean vectors, equal ones folded together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that the vector models are fitted on, at most.
MAX_SAMPLE = 10_000


def sound(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def clean(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Rows (id, v): the sound vectors as arrays of doubles, of any dimension."""
    whole = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    return whole.where(F.col("id").isNotNull() & sound(F.col("v")))


def by_dimension(rows: DataFrame) -> list[DataFrame]:
    """The rows (id, v) of each dimension for themselves: only vectors of one dimension compare."""
    sizes = sorted(r["d"] for r in rows.select(F.size("v").alias("d")).distinct().collect())
    return [rows if len(sizes) == 1 else rows.where(F.size("v") == d) for d in sizes]


def in_range(v: Column) -> Column:
    """The vector itself or, where squares of its components leave the range of doubles, one in the
    same direction that they do not leave."""
    most = F.array_max(F.transform(v, lambda x: F.abs(x)))
    return F.when((most < 1e-100) | (most > 1e100), F.transform(v, lambda x: x / most)).otherwise(v)


def sample(rows: DataFrame, size: int = MAX_SAMPLE):
    """At most ``size`` vectors, the first by a hash of the id, as a matrix."""
    import numpy as np

    taken = rows.orderBy(F.xxhash64("id"), "id").limit(size).select("v").collect()
    return np.array([r["v"] for r in taken], float)
