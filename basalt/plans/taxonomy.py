"""What an organism is: calls from the nearest genome, and evidence from its nearest relatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.scalar import fixed, organism_key
from basalt.operators.best import first_per_key
from basalt.operators.lineage import at_rank
from basalt.operators.organisms import one_genus, one_species

#: Distances up to which the nearest genome tells a rank. Fixed values.
RANK_BY_DISTANCE = ((0.05, "species"), (0.20, "genus"))
#: Names of a lineage that are tried, nearest first. Fixed value.
LINEAGE_NAMES = 4


def rank_of(distance: Column) -> Column:
    """The rank that a distance to the nearest genome justifies; null beyond all cut-offs."""
    chain = None
    for cut, rank in RANK_BY_DISTANCE:
        chain = F.when(distance <= cut, rank) if chain is None else chain.when(distance <= cut, rank)
    return chain


def call_taxa(runs: DataFrame, hits: DataFrame, taxa: DataFrame) -> DataFrame:
    """One row a run: called_rank, taxon and name of its call, or ``reason`` why there is none.

    ``hits`` has run, genome, taxon, distance and pos; the nearest decides, the first on ties. ``taxa``
    has taxon, parent, rank and name. No hit, a distance beyond all cut-offs, a hit without a taxon,
    a taxon that is not known and a lineage without the rank are each a reason of their own."""
    top = first_per_key(hits, ["run"], [F.col("distance").asc_nulls_last(), F.col("pos")]).select("run", "genome", F.col("taxon").alias("hit_taxon"), "distance", rank_of(F.col("distance")).alias("rank"))
    asked = top.where("rank is not null and hit_taxon is not null").select(F.col("hit_taxon").alias("taxon"), "rank").distinct()
    called = asked.select("taxon", F.col("rank").alias("wanted"))
    # One lineage may be asked for several ranks: each rank is its own question.
    parts = [at_rank(called.where(F.col("wanted") == rank), taxa, "taxon", "parent", "rank", F.lit(rank)).withColumn("rank", F.lit(rank)) for _, rank in RANK_BY_DISTANCE]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    known = taxa.select(F.col("taxon").alias("hit_taxon"), F.lit(True).alias("known"))
    joined = runs.select("run").distinct().join(top, "run", "left").join(known, "hit_taxon", "left")
    joined = joined.join(found.select(F.col("node").alias("hit_taxon"), "rank", "called"), ["hit_taxon", "rank"], "left")
    joined = joined.join(taxa.select(F.col("taxon").alias("called"), F.col("name").alias("called_name")), "called", "left")
    reason = (
        F.when(F.col("genome").isNull() & F.col("distance").isNull(), "no hits")
        .when(F.col("rank").isNull(), F.concat(F.lit("the nearest genome is at "), F.coalesce(fixed(F.col("distance"), 4), F.lit("no distance")), F.lit(", beyond every cut-off")))
        .when(F.col("hit_taxon").isNull(), "the nearest genome has no taxon")
        .when(F.col("known").isNull(), "the taxon is not known")
        .when(F.col("called").isNull(), F.concat(F.lit("the lineage has no "), "rank"))
        .otherwise("")
    )
    said = reason == ""
    return joined.select("run", F.when(said, F.col("rank")).alias("called_rank"), F.when(said, F.col("called")).alias("taxon"), F.when(said, F.col("called_name")).alias("name"), reason.alias("reason"))


def reference_candidates(asked: DataFrame) -> DataFrame:
    """Rows (query, place, kind, value): what may name a query's relatives, best first.

    ``asked`` has query, keyword, relatives (genome ids, nearest first), lineage (names, root first)
    and scientific. A keyword stands alone; else the relatives' ids come before all names, then the
    scientific name unless the lineage's nearest names hold it, then those, nearest first."""
    row = lambda place, kind, value: F.struct(F.lit(place).cast("int").alias("place"), F.lit(kind).alias("kind"), value.alias("value"))
    text = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    none = F.array().cast("array<string>")
    names = F.slice(F.reverse(F.filter(F.transform(F.coalesce("lineage", none), lambda x: F.trim(x)), lambda x: F.coalesce(x != "", F.lit(False)))), 1, LINEAGE_NAMES)
    own = F.when(text(F.col("scientific")).isNotNull() & ~F.array_contains("_names", text(F.col("scientific"))), F.array(row(1, "name", text(F.col("scientific"))))).otherwise(F.array().cast("array<struct<place int, kind string, value string>>"))
    ids = F.transform(F.filter(F.coalesce("relatives", none), lambda x: F.coalesce(x != "", F.lit(False))), lambda x: row(0, "genome", x))
    walked = F.transform("_names", lambda x, i: F.struct((i + 2).cast("int").alias("place"), F.lit("name").alias("kind"), x.alias("value")))
    every = F.when(text(F.col("keyword")).isNotNull(), F.array(row(0, "name", text(F.col("keyword"))))).otherwise(F.concat(ids, own, walked))
    return asked.withColumn("_names", names).select("query", F.explode(every).alias("x")).select("query", "x.*")


def resolve_reference(asked: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows (query, kind, matched, rows): the first candidate that the reference has anything for, all
    relatives' ids being one candidate; a query without any keeps its first name with 0 rows.

    ``reference`` has kind (``genome`` or ``name``), value and rows, one row for each pair."""
    tried = reference_candidates(asked)
    held = tried.join(reference.where("rows > 0"), ["kind", "value"]).groupBy("query", "place", "kind").agg(F.min("value").alias("value"), F.count("*").alias("values"), F.sum("rows").alias("rows"))
    best = first_per_key(held, ["query"], [F.col("place")])
    fallback = first_per_key(tried.where("kind = 'name'"), ["query"], [F.col("place")]).select("query", F.col("value").alias("first"))
    matched = F.when(F.col("kind") == "genome", F.concat(F.col("values").cast("string"), F.lit(" related genomes"))).otherwise(F.coalesce("value", "first", F.lit("")))
    joined = asked.select("query").distinct().join(best, "query", "left").join(fallback, "query", "left")
    return joined.select("query", F.coalesce("kind", F.lit("name")).alias("kind"), matched.alias("matched"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def genus_of(lineage: Column, name: Column) -> Column:
    """The genus as the lineage spells it, its last name of one word, or else the name's first word."""
    one = F.filter(F.coalesce(lineage, F.array().cast("array<struct<name:string,taxon:long>>")), lambda x: F.coalesce((F.trim(x["name"]) != "") & ~F.trim(x["name"]).contains(" "), F.lit(False)))
    return F.coalesce(F.lower(F.trim(F.try_element_at(one, F.lit(-1))["name"])), organism_key(name)["genus"])


def same_organism(name: Column, taxon: Column, lineage: Column, hit_name: Column, hit_taxon: Column) -> Column:
    """Struct (determined, species, genus): whether a hit is of the query's species and genus.

    A hit's taxon at or below the query's species decides at once. Else names do: with a lineage its
    genus and equal epithets, or names that are one in spite of a renaming. Of an organism without a
    name nothing is determined but by taxon."""
    sure = lambda c: F.coalesce(c, F.lit(False))
    empty = F.array().cast("array<struct<name:string,taxon:long>>")
    below = F.transform(F.filter(F.coalesce(lineage, empty), lambda x: sure(F.trim(x["name"]).contains(" "))), lambda x: x["taxon"])
    hit_id = F.when(hit_taxon != 0, hit_taxon.cast("long"))
    by_taxon = sure(F.array_contains(below, hit_id)) | sure(hit_id == taxon.cast("long"))
    determined = F.trim(F.coalesce(name, F.lit(""))) != ""
    named = determined & (F.trim(F.coalesce(hit_name, F.lit(""))) != "")
    has = F.size(F.coalesce(lineage, empty)) > 0
    hit, own = organism_key(hit_name), organism_key(name)
    spelled = has & (hit["genus"] == genus_of(lineage, name))
    species = by_taxon | (named & sure((hit["species"] != "") & (own["species"] != "") & ((spelled & (hit["species"] == own["species"])) | one_species(name, hit_name))))
    genus = species | (named & sure(spelled | one_genus(name, hit_name)))
    return F.struct(determined.alias("determined"), species.alias("species"), genus.alias("genus"))
