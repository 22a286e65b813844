"""Organisms by name: species and genera that are one in spite of a renaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.scalar import first_present, meaningful, organism_key, same_genus
from basalt.operators.best import first_per_key

#: Letters that two names of one genus share at least, if they are not equal. Fixed value.
STEM = 6


def one_species(a: Column, b: Column) -> Column:
    """True for two names of one species: equal epithets, and genera that are one."""
    one, two = organism_key(a), organism_key(b)
    return (one["species"] != "") & (one["species"] == two["species"]) & same_genus(one["genus"], two["genus"])


def one_genus(a: Column, b: Column) -> Column:
    return same_genus(organism_key(a)["genus"], organism_key(b)["genus"])


def related_names(queries: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (query, name, same_species) for all different ``query`` and ``name`` of one genus.

    Two genera that are one share their first letters up to ``STEM``, so rows meet by an equal stem
    and the exact rule decides; names without a genus meet nothing."""
    stem = lambda c: F.left(organism_key(F.col(c))["genus"], F.lit(STEM))
    a = queries.select("query").distinct().withColumn("_stem", stem("query")).where("_stem <> ''")
    b = names.select("name").distinct().withColumn("_stem", stem("name")).where("_stem <> ''")
    met = a.join(b, "_stem").where(one_genus(F.col("query"), F.col("name")))
    return met.select("query", "name", one_species(F.col("query"), F.col("name")).alias("same_species"))


def relatedness(reference: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows (query, measured, genomes, same_species, same_genus): how many reference genomes are of
    each query's species and genus, the genus counting the species too.

    ``reference`` has genome_id, genome_name and pos: a genome is known by its id or else its name
    and named by its first row that has a name. A query that is blank is not determined: its counts
    are unknown, not zero."""
    key = first_present(F.col("genome_id"), F.col("genome_name"))
    named = reference.withColumn("genome", key).where(F.col("genome").isNotNull() & meaningful(F.col("genome_name")).isNotNull())
    genomes = first_per_key(named, ["genome"], [F.col("pos")]).select("genome", F.col("genome_name").alias("name"))
    by_name = genomes.groupBy("name").agg(F.count("*").alias("n"))
    met = related_names(queries, by_name.select("name")).join(by_name, "name")
    counts = met.groupBy("query").agg(F.sum(F.when(F.col("same_species"), F.col("n")).otherwise(0)).alias("same_species"), F.sum("n").alias("same_genus"))
    total = genomes.agg(F.count("*").alias("genomes"))
    asked = queries.select("query").distinct()
    measured = F.trim(F.coalesce("query", F.lit(""))) != ""
    known = lambda c: F.when(measured, F.coalesce(c, F.lit(0)))
    return asked.join(counts, "query", "left").join(total).select("query", measured.alias("measured"), F.when(measured, F.col("genomes")).alias("genomes"), known("same_species").alias("same_species"), known("same_genus").alias("same_genus"))
