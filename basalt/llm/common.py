"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or else a folder
    in the warehouse, which a cluster shares too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (``__`` for a dot) for what runs inside, put back afterwards."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame, by: str | None = None, group_bytes: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, a lost
    executor costs nothing that was finished, and later plans know the table's size.

    With ``by`` the table is bucketed on that column, so that joins and aggregations on it
    need no further shuffle of this side. ``group_bytes`` bounds the row groups, of which a task
    holds one at a time; ``codec`` is for large tables of texts, which zstd writes smaller."""
    spark = df.sparkSession
    name = f"cut_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    writer = df.write.options(**{k: v for k, v in {"parquet.block.size": group_bytes, "compression": codec}.items() if v is not None})
    if by is None:
        writer.parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
    else:
        writer.format("parquet").bucketBy(parallelism(df), by).option("path", path).saveAsTable(name)
        back = spark.table(name)
    back.cut_at = (path, None if by is None else name)
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables written by ``cut`` that nothing reads any more."""
    for df in tables:
        path, name = df.cut_at
        spark = df.sparkSession
        if name:
            spark.sql(f"DROP TABLE {name}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_KEPT: dict = {}


def kept(key, make):
    """What ``make`` builds, kept by the Python worker from task to task. A worker holds the
    state of one operator at a time: that of another goes first."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Let go what another operator has left in this Python worker."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()


def parallelism(df: DataFrame) -> int:
    """Partitions for a keyed repartition: the session's shuffle setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id's text is divisible by five."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0
