"""Outputs of annotation providers as calls and terms.

Calls have feature_id, flag, value (text), source, evidence and pos; terms have feature_id, kind,
id, name, source, evidence and pos. ``pos`` grows in the order in which a file says things. Every
reader is a scan by lines or records, so that one large file is read by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.functions.scalar import localisation, split_list
from basalt.functions.sequence import WINDOW, membrane_spans, targeting
from basalt.sources.tabular import EMAPPER_COLUMNS, INTERPRO_COLUMNS

#: Analyses that speak of topology, by name. Fixed values.
PASS_ANALYSES = ("TMHMM", "DEEPTMHMM")
MIXED_ANALYSIS = "PHOBIUS"
SIGNAL_ANALYSES = ("SIGNALP", "SIGNALP_EUK", "SIGNALP_GRAM_POSITIVE", "SIGNALP_GRAM_NEGATIVE", MIXED_ANALYSIS)
#: Last residue at which a signal peptide may be cut. Fixed value.
LAST_CLEAVAGE = 45


def _place() -> Column:
    """Where a line stands: file, split, and number within the task that reads the split."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))


def _lines(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    read = spark.read.option("lineSep", separator) if separator else spark.read
    return read.text(path).select(F.regexp_replace("value", "^﻿|\r$", "").alias("value"), _place().alias("pos"))


def _fields(value: Column) -> Column:
    """Tab-separated fields, or words where a line has no tab."""
    return F.when(value.contains("\t"), F.split(value, "\t")).otherwise(F.split(F.trim(value), r"\s+"))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    lines = _lines(spark, path).where((F.trim("value") != "") & ~F.col("value").rlike("^(#|//)"))
    return lines.select(_fields(F.col("value")).alias("f"), "value", "pos")


def _union(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def eggnog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Orthology annotations: descriptions as calls, everything else as terms.

    Columns go by the ``#query`` line of their own file, whatever its release; a file without one
    has the order of release 2.1. A lone dash is no value, rows without a query are skipped."""
    lines = _lines(spark, path).where(F.trim("value") != "").withColumn("file", F.col("pos.file"))
    named = lines.where(F.lower("value").startswith("#q")).groupBy("file").agg(F.max("value").alias("header"))
    header = F.coalesce(F.transform(F.split("header", "\t"), lambda c: F.trim(c)), F.array(*map(F.lit, EMAPPER_COLUMNS)))
    rows = lines.where(~F.col("value").startswith("#")).join(named, "file", "left").select(F.split("value", "\t").alias("f"), header.alias("header"), "pos")
    # The first column is the query, by whatever name.
    field = lambda name: F.nullif(F.trim(F.get("f", (F.nullif(F.array_position("header", name), F.lit(0)) - 1).cast("int"))), F.lit("-"))
    query, text = F.trim(F.get("f", 0)), lambda name: F.coalesce(field(name), F.lit(""))
    rows = rows.where(query != "").select(
        query.alias("feature_id"), "pos", text("Description").alias("description"), text("Preferred_name").alias("name"), text("seed_ortholog").alias("seed"),
        F.filter(F.split(text("COG_category"), ""), lambda c: c.rlike("[A-Za-z]")).alias("categories"),
        F.filter(F.transform(split_list(text("eggNOG_OGs")), lambda g: F.substring_index(g, "@", 1)), lambda g: g.startswith("COG")).alias("groups"),
        *(F.transform(split_list(text(c)), lambda x: F.replace(x, F.lit("ko:"))).alias(k) for k, c in (("go", "GOs"), ("ec", "EC"), ("ko", "KEGG_ko"), ("kegg_pathway", "KEGG_Pathway"), ("pfam", "PFAMs"))),
    )
    source = F.lit("eggnog").alias("source")
    evidence = F.when(F.col("seed") != "", F.concat(F.lit("eggNOG seed ortholog "), "seed")).otherwise("eggNOG").alias("evidence")
    calls = rows.where("description <> ''").select("feature_id", F.lit("description").alias("flag"), F.col("description").alias("value"), source, evidence, "pos")
    kinds = F.create_map(
        F.lit("gene_name"), F.filter(F.array("name"), lambda n: n != ""), F.lit("cog_category"), F.col("categories"), F.lit("cog"), F.col("groups"),
        *(x for k in ("go", "ec", "ko", "kegg_pathway", "pfam") for x in (F.lit(k), F.col(k))),
    )
    each = rows.select("feature_id", F.posexplode(F.map_entries(kinds)).alias("n", "e"), "pos").select("feature_id", "pos", "n", F.col("e.key").alias("kind"), F.posexplode("e.value").alias("m", "id"))
    terms = each.select("feature_id", "kind", "id", F.lit("").alias("name"), source, F.lit("").alias("evidence"), F.struct("pos.*", (F.col("n") * 100000 + F.col("m")).alias("item")).alias("pos"))
    return calls, terms


def psortb(spark: SparkSession, path: str) -> DataFrame:
    """Localisation calls of terse or long reports. A long one is read record by record, never as
    rows of words; a place that no rule knows is no call."""
    long = bool(_lines(spark, path).where(F.col("value").contains("Final Prediction")).limit(1).collect())
    if long:
        records = _lines(spark, path, "SeqID:")
        final = F.regexp_extract("value", r"Final Prediction:[^\n]*\n\s*([^\n]+)", 1)
        named = records.select(F.regexp_extract("value", r"^[ \t]*(\S+)", 1).alias("feature_id"), F.trim(F.regexp_replace(final, "\r", "")).alias("final"), "pos")
        rows = named.select("feature_id", F.regexp_replace("final", r"\s+\S+$", "").alias("said"), F.regexp_extract("final", r"\s(\S+)$", 1).alias("score"), "pos").where("said <> ''")
    else:
        words = _rows(spark, path).where((F.size("f") >= 2) & (F.lower(F.get("f", 0)) != "seqid"))
        rows = words.select(F.trim(F.get("f", 0)).alias("feature_id"), F.trim(F.get("f", 1)).alias("said"), F.coalesce(F.trim(F.get("f", 2)), F.lit("")).alias("score"), "pos")
    where = F.nullif(localisation(F.col("said")), F.lit(""))
    evidence = F.concat(F.lit("PSORTb "), "said", F.when(F.col("score") != "", F.concat(F.lit(" (score "), "score", F.lit(")"))).otherwise(""))
    return rows.where("feature_id <> ''").select("feature_id", F.lit("localization").alias("flag"), where.alias("value"), F.lit("psortb").alias("source"), evidence.alias("evidence"), "pos").where("value is not null")


def signalp(spark: SparkSession, path: str) -> DataFrame:
    """Signal and lipoprotein calls: a lipid anchor is a signal too, OTHER is neither."""
    rows = _rows(spark, path).where(F.size("f") >= 2).select(F.trim(F.get("f", 0)).alias("feature_id"), F.trim(F.get("f", 1)).alias("said"), F.regexp_extract("value", r"CS pos:\s*(\d+-\d+)", 1).alias("cut"), "pos")
    kind = F.upper("said")
    flags = F.create_map(F.lit("signal_peptide"), ~kind.isin("OTHER", ""), F.lit("lipoprotein"), kind.contains("LIPO"))
    evidence = F.concat("said", F.when(F.col("cut") != "", F.concat(F.lit(", cleavage "), "cut")).otherwise(""))
    each = rows.where("feature_id <> ''").select("feature_id", F.explode(flags).alias("flag", "value"), evidence.alias("evidence"), "pos")
    return each.select("feature_id", "flag", F.col("value").cast("string").alias("value"), F.lit("signalp").alias("source"), "evidence", "pos")


def interpro_hits(spark: SparkSession, path: str) -> DataFrame:
    """Signature hits of a TSV or JSON report as rows for ``absorb_hits``.

    Reports in JSON are objects with ``results`` or bare lists of entries; an entry goes by its
    first reference that has an id."""
    if not path.lower().rstrip("/").endswith(".json"):
        field = lambda name: F.coalesce(F.trim(F.get("f", INTERPRO_COLUMNS.index(name))), F.lit(""))
        rows = _rows(spark, path).where(field("protein_accession") != "")
        return rows.select(
            field("protein_accession").alias("feature_id"), field("analysis").alias("analysis"), field("signature_accession").alias("signature"), field("signature_description").alias("description"),
            field("interpro_accession").alias("entry"), field("interpro_description").alias("entry_description"), split_list(field("go_annotations")).alias("go"), F.lit(1).alias("locations"), F.struct("pos.*", F.lit(0).alias("item")).alias("pos"),
        )
    match = "struct<signature: struct<accession: string, description: string, signatureLibraryRelease: struct<library: string>, entry: struct<accession: string, description: string, goXRefs: array<struct<id: string>>>>, locations: array<string>>"
    one = f"xref array<struct<id: string>>, matches array<{match}>"
    read = spark.read.schema(f"results array<struct<{one}>>, {one}").option("multiLine", True).json(path).withColumn("pos", _place())
    entries = read.select("pos", F.posexplode(F.coalesce("results", F.array(F.struct("xref", "matches")))).alias("n", "e"))
    key = F.get(F.filter(F.transform("e.xref", lambda x: x["id"]), lambda i: F.coalesce(i, F.lit("")) != ""), 0)
    each = entries.select(key.alias("feature_id"), "pos", "n", F.posexplode("e.matches").alias("m", "h")).where("feature_id is not null and h.signature is not null")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return each.select(
        "feature_id", text("h.signature.signatureLibraryRelease.library").alias("analysis"), text("h.signature.accession").alias("signature"), text("h.signature.description").alias("description"),
        text("h.signature.entry.accession").alias("entry"), text("h.signature.entry.description").alias("entry_description"),
        F.filter(F.coalesce(F.transform("h.signature.entry.goXRefs", lambda g: g["id"]), F.array().cast("array<string>")), lambda g: F.coalesce(g, F.lit("")) != "").alias("go"),
        F.greatest(F.coalesce(F.size("h.locations"), F.lit(1)), F.lit(1)).alias("locations"), F.struct("pos.*", (F.col("n").cast("long") * 1000000 + F.col("m")).alias("item")).alias("pos"),
    )


def absorb_hits(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and terms of signature hits.

    Rows of a membrane predictor are passes and are counted; of a mixed predictor only rows that
    say TRANSMEMBRANE count. Rows that say SIGNAL, of predictors that can, call a signal. The
    first entry with a description names the protein. Topology rows give no signature terms."""
    key = F.replace(F.upper("analysis"), F.lit("-"), F.lit("_"))
    label = F.upper(F.concat_ws(" ", "signature", "description"))
    passes = key.isin(*PASS_ANALYSES) | ((key == MIXED_ANALYSIS) & label.contains("TRANSMEMBRANE"))
    signals = key.isin(*SIGNAL_ANALYSES) & label.contains("SIGNAL")
    topology = key.isin(*PASS_ANALYSES, *SIGNAL_ANALYSES)
    known = ~F.col("entry").isin("", "-")
    marked = hits.withColumns({"passes": passes, "signals": signals, "kind": F.when((F.col("signature") != "") & ~topology, F.when(key == "PFAM", "pfam").otherwise("signature")), "known": known})

    shown = F.concat("analysis", F.lit(":"), F.when(F.col("signature") != "", F.col("signature")).otherwise(F.col("description")))
    said = marked.groupBy("feature_id").agg(
        F.sum(F.when(F.col("passes"), F.col("locations"))).alias("count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("signals"), F.struct("pos", shown.alias("shown"))))), lambda x: x["shown"]), ";").alias("signal"),
        F.min(F.when(F.col("known") & (F.col("entry_description") != ""), F.struct("pos", "entry_description", "entry", "analysis"))).alias("first"), F.min("pos").alias("pos"),
    )
    count = F.col("count").cast("string")
    given = F.array(
        F.when(count.isNotNull(), F.struct(F.lit("tm_helices").alias("flag"), count.alias("value"), F.concat(count, F.lit(" transmembrane regions from InterProScan")).alias("evidence"))),
        F.when(F.col("signal") != "", F.struct(F.lit("signal_peptide").alias("flag"), F.lit("true").alias("value"), F.col("signal").alias("evidence"))),
        F.when(F.col("first").isNotNull(), F.struct(F.lit("description").alias("flag"), F.col("first.entry_description").alias("value"), F.concat(F.lit("InterPro "), "first.entry", F.lit(" via "), "first.analysis").alias("evidence"))),
    )
    source = F.lit("interproscan").alias("source")
    calls = said.select("feature_id", F.explode(F.filter(given, lambda x: x.isNotNull())).alias("c"), "pos").select("feature_id", "c.flag", "c.value", source, "c.evidence", "pos")

    term = lambda kind, identifier, name: F.struct(kind.alias("kind"), identifier.alias("id"), name.alias("name"))
    go = F.filter(F.transform("go", lambda g: F.trim(F.substring_index(g, "(", 1))), lambda g: g.startswith("GO:"))
    own = F.array(F.when(F.col("kind").isNotNull(), term(F.col("kind"), F.col("signature"), F.col("description"))), F.when(F.col("known"), term(F.lit("interpro"), F.col("entry"), F.col("entry_description"))))
    listed = F.concat(F.filter(own, lambda x: x.isNotNull()), F.transform(go, lambda g: term(F.lit("go"), g, F.lit(""))))
    each = marked.select("feature_id", F.posexplode(listed).alias("n", "t"), F.col("analysis").alias("evidence"), "pos")
    return calls, each.select("feature_id", "t.kind", "t.id", "t.name", source, "evidence", F.struct("pos.*", "n").alias("pos"))


def interproscan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return absorb_hits(interpro_hits(spark, path))


def heuristic(proteins: DataFrame) -> DataFrame:
    """Calls from sequences alone (feature_id, sequence), with ``first_span``, where the first
    counted span begins. A first span that the own signal or lipid anchor reaches is that signal's
    and is not counted. Proteins without a sequence get no calls."""
    clean = proteins.select("feature_id", F.regexp_replace(F.upper("sequence"), r"\*+$", "").alias("sequence")).where("sequence <> ''")
    read = membrane_spans(clean.withColumn("t", targeting(F.col("sequence"))))
    head, reach = F.get("spans", 0), F.greatest("t.cleavage", "t.cysteine")
    taken = (F.col("t.signal") | F.col("t.lipoprotein")) & (head["start"] <= LAST_CLEAVAGE) & (head["end"] <= reach + WINDOW)
    counted = F.when(taken, F.slice("spans", 2, F.greatest(F.size("spans") - 1, F.lit(0)))).otherwise(F.col("spans"))
    shown = F.array_join(F.transform(counted, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    read = read.withColumns({"counted": counted, "shown": F.when(shown != "", shown).otherwise("none"), "taken": F.coalesce(taken, F.lit(False))})
    flags = F.create_map(
        F.lit("tm_helices"), F.array(F.size("counted").cast("string"), F.concat(F.lit("hydropathy: "), "shown", F.when(F.col("taken"), "; N-terminal segment assigned to the signal peptide").otherwise(""))),
        F.lit("signal_peptide"), F.array(F.col("t.signal").cast("string"), F.concat(F.lit("cleavage "), F.col("t.cleavage").cast("string"))),
        F.lit("lipoprotein"), F.array(F.col("t.lipoprotein").cast("string"), F.concat(F.lit("cysteine "), F.col("t.cysteine").cast("string"))),
    )
    each = read.select("feature_id", F.explode(flags).alias("flag", "v"), F.get("counted", 0)["start"].alias("first_span"))
    return each.select("feature_id", "flag", F.get("v", 0).alias("value"), F.lit("heuristic").alias("source"), F.get("v", 1).alias("evidence"), "first_span")


def renumbered(*tables: DataFrame) -> DataFrame:
    """Calls or terms of several providers in one table, earlier providers first: ``pos`` becomes
    (provider, place in its own order)."""
    columns = [c for c in tables[0].columns if c != "pos"]
    shape = "struct<file: string, split: long, line: long, item: long, part: long>"

    def numbered(i: int, df: DataFrame) -> DataFrame:
        names = df.schema["pos"].dataType.names if "pos" in df.columns and df.schema["pos"].dataType.typeName() == "struct" else []
        parts = {"file": F.lit("").cast("string"), "split": F.lit(0), "line": F.lit(0), "item": F.lit(0), "n": F.lit(0)}
        inner = F.struct(*((F.col(f"pos.{p}") if p in names else d).alias(p) for p, d in parts.items())).cast(shape)
        return df.select(*columns, F.struct(F.lit(i).alias("provider"), inner.alias("place")).alias("pos"))

    return _union(*(numbered(i, df) for i, df in enumerate(tables)))
