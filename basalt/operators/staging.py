"""Tables that a plan writes for itself in the folder driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else a folder of the warehouse. A warehouse on a machine's own
    disk is refused unless Spark runs on that machine alone."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
            raise ValueError("name a shared folder in spark.checkpoint.dir")
    return f"{warehouse.rstrip('/')}/scratch"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written and read again: what it holds does not change from reading to reading."""
    path = f"{shared_folder(df.sparkSession)}/staged_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
