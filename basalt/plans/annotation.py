"""What providers say of proteins, merged into flags that keep their sources, and long terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.plans.triage import SOURCE_RANK
from basalt.sources.providers import LAST_CLEAVAGE

#: How a source knows what it says. Fixed values.
CONFIDENCE = {
    "uniprot_experimental": "experimental", "deeptmhmm": "predicted", "signalp": "predicted", "psortb": "predicted", "interproscan": "predicted",
    "uniprot": "inferred", "eggnog": "inferred", "heuristic": "heuristic",
}
#: Ranks of sources of names and summaries; other sources keep their own rank. Fixed values.
NAME_RANK = {"uniprot_experimental": 60, "uniprot": 50, "eggnog": 40, "interproscan": 30}
#: Fixed values.
SURFACE_PLACES = ("outer membrane", "cell wall", "extracellular")
MEMBRANE_PLACES = ("cytoplasmic membrane", "outer membrane")
UNCOVERED, UNKNOWN = "uncovered", "unknown"
ASKED = ("tm_helices", "signal_peptide", "lipoprotein", "localization", "description", "summary")
FLAGS = ("membrane", "signal_peptide", "lipoprotein", "localization", "secreted", "surface_exposed")


def _lookup(values: dict, key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[key]


def by_alias(calls: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls under the proteins' own ids, and rows (source, feature_id) that no protein goes by.

    ``names`` has rows (feature_id, name, pos) of all names of a protein in order, its id first.
    A protein takes each source's rows under the first of its names that the source uses."""
    known = calls.select("source", F.col("feature_id").alias("name")).distinct()
    met = known.join(names, "name")
    chosen = met.groupBy("source", "feature_id").agg(F.min(F.struct("pos", "name"))["name"].alias("name"))
    said = calls.withColumnRenamed("feature_id", "name")
    own = said.join(chosen, ["source", "name"]).select(*calls.columns)
    return own, known.join(chosen, ["source", "name"], "left_anti").withColumnRenamed("name", "feature_id")


def merge(proteins: DataFrame, calls: DataFrame) -> DataFrame:
    """One row for each protein (feature_id): what the highest-ranked source says of each flag,
    the first by ``pos`` on ties, and what follows from it; null where nobody looked.

    ``calls`` has feature_id, flag, value, source, evidence, pos and, from a heuristic, may have
    first_span: a heuristic count loses its N-terminal segment to a signal peptide that a better
    source calls. A membrane is a counted pass or a membrane place; secreted is outside, or a
    signal without a pass and without an anchor; exposed is secreted, on the surface, or anchored.
    One shuffle: best calls are greatest structs, taken before it as well as after."""
    if "first_span" not in calls.columns:
        calls = calls.withColumn("first_span", F.lit(None).cast("int"))
    rank = F.coalesce(_lookup(SOURCE_RANK, F.col("source")), F.lit(0))
    named = F.coalesce(_lookup(NAME_RANK, F.col("source")), rank)
    ranked = calls.where("value is not null").withColumn("rank", F.when(F.col("flag").isin("description", "summary"), named).otherwise(rank))
    call = F.struct((-F.col("rank")).alias("order"), "pos", "value", "source", "evidence", "rank", "first_span")
    best = ranked.groupBy("feature_id").agg(*(F.min(F.when(F.col("flag") == f, call)).alias(f) for f in ASKED))
    joined = proteins.join(best, "feature_id", "left")

    tm, signal, anchor, place = (F.col(f) for f in ASKED[:4])
    said = lambda c: F.lower(c["value"]).isin("true", "1")
    count = F.coalesce(tm["value"].try_cast("int"), F.lit(0))
    signalled, anchored = F.coalesce(said(signal), F.lit(False)), F.coalesce(said(anchor), F.lit(False))
    moved = F.coalesce((tm["source"] == "heuristic") & (count > 0) & (tm["first_span"] <= LAST_CLEAVAGE) & signalled & (signal["rank"] > tm["rank"]), F.lit(False))
    helices = F.when(moved, count - 1).otherwise(count)
    where = F.coalesce(place["value"], F.lit(UNKNOWN))
    inside = where.isin(*MEMBRANE_PLACES)
    by_place = inside & ~(helices > 0)
    secreted = (where == "extracellular") | (signalled & (helices == 0) & ~anchored)
    told = F.concat(tm["evidence"], F.when(moved, F.concat(F.lit("; N-terminal segment reassigned to the signal peptide called by "), signal["source"])).otherwise(""))
    flat = joined.select(
        *proteins.columns, helices.alias("helices"), signalled.alias("signalled"), anchored.alias("anchored"), where.alias("localization"), ((helices > 0) | inside).alias("inside"),
        secreted.alias("out"), (secreted | where.isin(*SURFACE_PLACES) | anchored).alias("exposed"), F.when(by_place, place["source"]).otherwise(tm["source"]).alias("membrane_source"),
        F.when(by_place, place["evidence"]).otherwise(told).alias("membrane_evidence"), signal["source"].alias("signal_peptide_source"), signal["evidence"].alias("signal_peptide_evidence"),
        anchor["source"].alias("lipoprotein_source"), anchor["evidence"].alias("lipoprotein_evidence"), place["source"].alias("localization_source"), place["evidence"].alias("localization_evidence"),
        *(F.col(f)[x].alias(f if x == "value" else f"{f}_{x}") for f in ("description", "summary") for x in ("value", "source")),
    )
    asked = F.coalesce("signal_peptide_source", "localization_source").isNotNull()
    inputs = [F.col(f"{f}_source") for f in ("localization", "signal_peptide", "membrane", "lipoprotein")]
    behind = {f: inputs if f in ("secreted", "surface_exposed") else [F.col(f"{f}_source")] for f in FLAGS}
    known = {
        "membrane": F.when(F.col("membrane_source").isNotNull(), F.col("inside")), "tm_helices": F.when(F.col("membrane_source").isNotNull(), F.col("helices")),
        "signal_peptide": F.when(F.col("signal_peptide_source").isNotNull(), F.col("signalled")), "lipoprotein": F.when(F.col("lipoprotein_source").isNotNull(), F.col("anchored")),
        "secreted": F.when(asked, F.col("out")), "surface_exposed": F.when(asked, F.col("exposed")),
    }
    evidence = [f"{f}_{x}" for f in ("membrane", "signal_peptide", "lipoprotein", "localization") for x in ("source", "evidence")]
    return flat.select(
        *proteins.columns, *(c.alias(n) for n, c in known.items()), "localization", *evidence, "description", "description_source", "summary", "summary_source",
        *(F.coalesce(weakest(*sources), F.lit(UNCOVERED)).alias(f"{f}_confidence") for f, sources in behind.items()),
        *(_label(*behind[f]).alias(f"{f}_sources") for f in ("secreted", "surface_exposed")),
        weakest(F.col("membrane_source"), F.col("signal_peptide_source")).alias("confidence"),
    )


def weakest(*sources: Column) -> Column:
    """Confidence of the lowest-ranked source that is there, or null."""
    given = F.filter(F.array(*sources), lambda s: s.isNotNull())
    lowest = F.array_min(F.transform(given, lambda s: F.struct(F.coalesce(_lookup(SOURCE_RANK, s), F.lit(0)).alias("rank"), s.alias("source"))))
    return _lookup(CONFIDENCE, lowest["source"])


def _label(*sources: Column) -> Column:
    """The different sources, sorted and joined, or ``none``."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*sources), lambda s: s.isNotNull()))), "+"), F.lit("")), F.lit("none"))


def distinct_terms(terms: DataFrame) -> DataFrame:
    """The long table of terms: each (protein, kind, id, source) once, as first said, with the
    confidence of its source."""
    first = terms.groupBy("feature_id", "kind", "id", "source").agg(F.min(F.struct("pos", "name", "evidence")).alias("t"))
    return first.select("feature_id", "kind", "id", "t.name", "source", F.coalesce(_lookup(CONFIDENCE, F.col("source")), F.lit("")).alias("confidence"), "t.evidence")


def report(merged: DataFrame) -> DataFrame:
    """Rows (measure, value, n) of a run: how many proteins carry each flag, and each flag's
    confidences and the sources of membrane flags."""
    text = lambda c: F.col(c).cast("string")
    facts = [(f, text(f)) for f in ("membrane", "signal_peptide", "lipoprotein", "secreted", "surface_exposed")] + [("localization", F.col("localization"))]
    facts += [(f"{f}_confidence", F.col(f"{f}_confidence")) for f in FLAGS] + [("membrane_source", F.coalesce("membrane_source", F.lit("none"))), ("confidence", F.coalesce("confidence", F.lit("none")))]
    long = merged.select(F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), c.alias("value")) for n, c in facts))).alias("x")).select("x.*")
    return long.where("value is not null").groupBy("measure", "value").agg(F.count("*").alias("n"))
