"""FASTA readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.operators.naming import unique_ids  # noqa: F401

NUCLEOTIDES, LETTERS, LONG = r"^[ACGTUN]+$", r"^[A-Za-z*.\-]*$", 30


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, pos, header, body), one per record; gzip is read as it is. ``pos`` grows with
    the record's place in its file: record boundaries split the scan, not lines."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"), "value")
    clean = F.regexp_replace(F.regexp_replace("value", r"\r", ""), r"^\s*>", "")
    parts = raw.select("file", "pos", clean.alias("value")).where(F.trim("value") != "")
    return parts.select("file", "pos", F.substring_index("value", "\n", 1).alias("header"), F.regexp_replace("value", r"^[^\n]*\n?", "").alias("body"))


def feature_id(header: Column) -> Column:
    """``fig|…`` ids end at the next bar or space, other ids at the first space."""
    fig = F.regexp_extract(header, r"^(fig\|[^|\s]+)", 1)
    return F.when(fig != "", fig).otherwise(F.regexp_extract(header, r"^(\S+)", 1))


def organism(header: Column) -> Column:
    return F.nullif(F.trim(F.substring_index(F.regexp_extract(header, r"\[([^\]]*)\]\s*$", 1), "|", 1)), F.lit(""))


def product(header: Column) -> Column:
    bare = F.regexp_replace(header, r"\s*\[[^\]]*\]\s*$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"^\S+\s*", ""), r"\s+OS=.*$", ""))


def fasta(spark: SparkSession, path: str, keep: str = "first") -> DataFrame:
    """Rows (feature_id, pos, header, product, organism, sequence); of repeated ids the ``first``
    or the ``last`` record stays."""
    rows = _records(spark, path).select(
        feature_id(F.col("header")).alias("feature_id"), "pos", "header", product(F.col("header")).alias("product"), organism(F.col("header")).alias("organism"),
        F.upper(F.regexp_replace("body", r"\s", "")).alias("sequence"),
    )
    order = F.col("pos") if keep == "first" else F.desc("pos")
    return rows.withColumn("_n", F.row_number().over(W.partitionBy("feature_id").orderBy(order))).where("_n = 1").drop("_n")


def fasta_checked(spark: SparkSession, path: str) -> DataFrame:
    """As ``fasta`` for files that users hand in: stops and gaps go, and ``problem`` names what is
    wrong with a record (null: nothing)."""
    rows = _records(spark, path).withColumn("raw", F.regexp_replace("body", r"\s", ""))
    sequence = F.upper(F.regexp_replace("raw", r"[*.\-]", ""))
    problem = (
        F.when(~F.col("raw").rlike(LETTERS), "not amino acids")
        .when(sequence == "", "empty sequence")
        .when(sequence.rlike(NUCLEOTIDES) & (F.length(sequence) >= LONG), "nucleotides")
    )
    return rows.select("pos", "header", feature_id(F.col("header")).alias("feature_id"), sequence.alias("sequence"), problem.alias("problem"))


def fasta_stats(spark: SparkSession, path: str) -> DataFrame:
    rows = _records(spark, path)
    return rows.agg(F.min_by("header", "pos").alias("first_header"), F.count("*").alias("n_sequences"), F.sum(F.length(F.regexp_replace("body", r"\s", ""))).alias("n_letters"))


def write_fasta(df: DataFrame, path: str, header: str = "feature_id", sequence: str = "sequence", width: int = 60) -> None:
    wrapped = F.regexp_replace(F.regexp_replace(F.col(sequence), f"(.{{{width}}})", "$1\n"), r"\n$", "")
    df.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), wrapped).alias("value")).write.mode("overwrite").text(path)


def blind_contigs(df: DataFrame) -> DataFrame:
    """Headers become ``contig_1`` … in file order."""
    return df.withColumn("header", F.concat(F.lit("contig_"), F.row_number().over(W.partitionBy("file").orderBy("pos")).cast("string")))
