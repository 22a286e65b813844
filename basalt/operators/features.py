"""Joins and summaries of feature tables: bindings, arrays, crosswalk choices and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.functions.scalar import as_float
from basalt.operators.best import first_per_key
from basalt.operators.keyed import once, refuse, repeated
from basalt.operators.staging import staged


def role_bindings(subsystems: DataFrame) -> DataFrame:
    """Rows (feature_id, bindings): subsystem, classification and role of every feature that a
    subsystem's role binds. ``subsystems`` has name, classification and role_bindings, an array
    of (role_id, features)."""
    bound = subsystems.select("name", "classification", F.explode("role_bindings").alias("b"))
    each = bound.select(F.explode("b.features").alias("feature_id"), F.struct("name", "classification", F.col("b.role_id").alias("role")).alias("binding"))
    return each.groupBy("feature_id").agg(F.array_sort(F.collect_list("binding")).alias("bindings"))


def specialty_arrays(features: DataFrame, specialty: DataFrame, kmers: DataFrame | None = None) -> DataFrame:
    """Features with ``specialty``, their specialty rows as an array (empty: none), and ``kmer``,
    the confidence of rows found by k-mers (null: none)."""
    number = lambda c: as_float(F.col(c)).alias(c)
    row = F.struct("property", "classification", "evidence", number("identity"), number("query_coverage"))
    listed = specialty.where("feature_id is not null").groupBy("feature_id").agg(F.array_sort(F.collect_list(row)).alias("specialty"))
    joined = features.join(listed, "feature_id", "left")
    out = joined.withColumn("specialty", F.coalesce("specialty", F.array().cast(listed.schema["specialty"].dataType)))
    return out.join(kmers.select("feature_id", F.struct(*(c for c in kmers.columns if c != "feature_id")).alias("kmer")), "feature_id", "left") if kmers is not None else out


def first_words(texts: DataFrame, key: str, text: str, none: tuple[str, ...] = ("", "-")) -> DataFrame:
    """Rows (key, word, pos): every word that spaces part in a key's texts, once, at its least place;
    the words in ``none`` say nothing.

    A text's words are told apart within its row. Only texts of keys that repeat are shuffled, and
    then only each text's different words."""

    def each(rows: DataFrame) -> DataFrame:
        placed = F.transform(F.split(text, " "), lambda word, i: F.struct(word.alias("word"), i.cast("long").alias("pos")))
        ordered = F.sort_array(F.filter(placed, lambda x: ~x["word"].isin(*none)))
        # Bound to a name of its own, or the list would be made anew for every word.
        first = F.transform(F.array(ordered), lambda words: F.filter(words, lambda x, i: (i == 0) | (F.get(words, i - 1)["word"] != x["word"])))
        return rows.select(key, F.inline(F.get(first, 0)))

    held = texts.select(key, text).where(F.col(text).isNotNull())
    repeats = held.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    if repeats.isEmpty():
        return each(held)
    repeats = staged(repeats)
    among = held[key].eqNullSafe(repeats["_key"])
    shared = each(held.join(repeats, among, "left_semi")).groupBy(key, "word").agg(F.min("pos").alias("pos"))
    return each(held.join(repeats, among, "left_anti")).unionByName(shared)


def overwrite_known(rows: DataFrame, key: str, metadata: DataFrame) -> DataFrame:
    """Rows with the metadata's values where it knows any, matched on the upper-cased key; an
    unmatched row keeps its own. Two metadata rows of one key, case aside, are an error for the
    rows that meet them."""
    side = once(metadata.select(*(c for c in metadata.columns if c != key), F.col(key).alias("_id")), F.upper("_id"), "_new_")
    joined = refuse(rows.join(side, F.upper(rows[key]) == side["_new_key"], "left"), repeated("_new_"))
    fresh = [c for c in metadata.columns if c != key]
    kept = [F.coalesce(f"_new_{c}", c).alias(c) if c in fresh else F.col(c) for c in rows.columns]
    return joined.select(*kept, *(F.col(f"_new_{c}").alias(c) for c in fresh if c not in rows.columns))


def choose_accession(refs: DataFrame, key: str) -> DataFrame:
    """Rows (key, accession, candidates): of the active cross-references to UniProtKB the first
    of the same taxon, then of the reviewed part, then in order. ``refs`` has database, active,
    accession, taxon, wanted_taxon and pos."""
    usable = refs.where(F.col("active") & F.col("database").startswith("UniProtKB"))
    same = F.coalesce(F.col("taxon") == F.col("wanted_taxon"), F.lit(False))
    best = first_per_key(usable, [key], [F.desc(same), F.desc(F.col("database") == "UniProtKB/Swiss-Prot"), F.col("pos")])
    return best.select(key, "accession").join(usable.groupBy(key).agg(F.count("*").alias("candidates")), key)


def sequences_by_checksum(wanted: DataFrame, features: DataFrame, sequences: DataFrame) -> DataFrame:
    """Wanted features with their sequence, through the checksum; each sequence counts once."""
    checked = wanted.join(features.select("feature_id", "md5"), "feature_id")
    return checked.join(sequences.dropDuplicates(["md5"]).select("md5", "sequence"), "md5")


def lookup_by_hint(rows: DataFrame, species: str, knowledge: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the knowledge of their species, or else of their genus; ``hint`` tells which.
    ``knowledge`` has a ``name``, of a species or a genus; a name that it has twice, case aside, is
    an error for the rows that meet it."""
    side = lambda n: once(knowledge.select("name", *columns), F.lower("name"), f"_{n}_")
    one, two = side("s"), side("g")
    joined = refuse(rows.join(one, F.lower(rows[species]) == one["_s_key"], "left"), repeated("_s_"))
    joined = refuse(joined.join(two, F.lower(F.split_part(joined[species], F.lit(" "), F.lit(1))) == two["_g_key"], "left"), F.when(F.col("_s_key").isNull(), repeated("_g_")))
    hint = F.when(F.col("_s_key").isNotNull(), "species").when(F.col("_g_key").isNotNull(), "genus")
    return joined.select(*rows.columns, *(F.when(F.col("_s_key").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(f"_g_{c}")).alias(c) for c in columns), hint.alias("hint"))


def verified_targets(targets: DataFrame) -> DataFrame:
    """Targets with ``verified``: their accession is among the target's own components."""
    return targets.withColumn("verified", F.coalesce(F.array_contains("components", F.col("accession")), F.lit(False)))


def specialty_index(specialty: DataFrame, kind: Column) -> DataFrame:
    """Rows (feature_id, types, classes, properties, rows): what a feature's rows name, sorted."""
    names = lambda c: F.array_sort(F.collect_set(c))
    return specialty.groupBy("feature_id").agg(names(kind).alias("types"), names(F.nullif(F.trim("classification"), F.lit(""))).alias("classes"), names(F.col("property")).alias("properties"), F.count("*").alias("rows"))


def typical_value(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Rows (keys, value, n): the commonest value that says something, first by value on ties."""
    counts = rows.withColumn("value", value).where("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"))
    return first_per_key(counts, keys, [F.desc("n"), F.col("value")])


def richest(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: with aspect and name before name alone before neither, then in order."""
    known = lambda c: F.coalesce(F.trim(c) != "", F.lit(False)).cast("int")
    return first_per_key(rows, [key], [F.desc(known("name") * (1 + known("aspect"))), F.col("pos")])


def preferred_term(terms: Column, kinds: tuple[str, ...]) -> Column:
    """The id of the first term of the kind liked best, or else of the first term at all.
    ``terms`` is an array of (kind, id)."""
    of_kind = lambda k: F.filter(terms, lambda x: x["kind"] == k)
    liked = [F.get(of_kind(k), 0)["id"] for k in kinds]
    return F.coalesce(*liked, F.get(terms, 0)["id"])


def receptor_atoms(lines: DataFrame, chains: tuple[str, ...] = ()) -> DataFrame:
    """Atom lines of the first model that belong to the kept chains (none named: all), without
    alternative places but the first. ``lines`` has structure, pos and line."""
    end = lines.where(F.col("line").startswith("ENDMDL")).groupBy("structure").agg(F.min("pos").alias("end"))
    first = lines.join(end, "structure", "left").where("end is null or pos < end").drop("end")
    alternative, chain = F.substring("line", 17, 1), F.substring("line", 22, 1)
    kept = first.where(F.col("line").startswith("ATOM") & alternative.isin(" ", "A"))
    return kept.where(chain.isin(*chains)) if chains else kept


def view_top(ranked: DataFrame, n: int) -> DataFrame:
    """The first ``n`` selected rows by rank, or of all rows where none is selected: each task keeps
    its first ``n`` of either kind, so the ranking is read once."""
    first = lambda df: df.orderBy("rank").limit(n)
    few = first(ranked.where("selected")).unionByName(first(ranked.where("not coalesce(selected, false)")))
    # At most 2 n rows: they fit where one window over all of them runs.
    kinds = few.withColumn("_some", F.coalesce(F.max(F.col("selected").cast("int")).over(W.partitionBy(F.lit(0))), F.lit(0)))
    return kinds.where(F.col("selected") | (F.col("_some") == 0)).drop("_some").orderBy("rank").limit(n)
