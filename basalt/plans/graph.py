"""A small graph with sources for every edge: proteins, partners, homologs, targets, compounds.

Replies are cached tables (cache_key, payload_json). A homolog's annotation is never the
protein's own: compounds hang on targets, targets on homologs, homologs on proteins with the
identity that justifies the step."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.scalar import as_float, as_int, slug
from basalt.operators.aggregates import upsert_nodes

_PARTNER = "array<struct<stringId_B: string, preferredName_B: string, score: string, escore: string, dscore: string, tscore: string>>"
_TARGET = "targets array<struct<target_chembl_id: string, pref_name: string, organism: string, target_type: string, target_components: array<struct<accession: string>>>>"
_ACTIVITY = "activities array<struct<molecule_chembl_id: string, standard_type: string, standard_value: string, standard_units: string, pchembl_value: string, assay_chembl_id: string>>"

#: What an edge is not. Fixed values.
NOTES = {
    "interacts_with": "the score is aggregated evidence, not a measured interaction",
    "homolog_of": "the homolog's annotation is not this protein's function",
    "target_of": "measured against this target, which is a homolog of the protein",
}


@dataclass(frozen=True)
class Caps:
    """How much of every reply is kept; bounded by choice, and said so in the output."""

    partners: int = 10
    targets: int = 5
    compounds: int = 10


def _place(*parts) -> Column:
    """Where a row stands in the order in which the graph grows: protein, step, and places within."""
    padded = [*parts, *([0] * (5 - len(parts)))]
    return F.struct(*((F.lit(p) if isinstance(p, int) else p).cast("long").alias(f"p{i}") for i, p in enumerate(padded)))


def _asked(asked: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """``asked`` with the reply for ``key`` and, in ``error``, why there is none."""
    status = as_int(F.get_json_object("payload_json", "$._http_status"))
    read = cache.select(F.col("cache_key").alias(key), "payload_json", status.alias("_status"))
    joined = asked.join(read, key, "left")
    error = F.when(F.col("payload_json").isNull(), "no reply is kept").when(F.col("_status").isNotNull(), F.concat(F.lit("HTTP "), F.col("_status").cast("string")))
    return joined.withColumn("error", error).drop("_status")


def _edge(rows: DataFrame, source: Column, target: Column, kind: str, evidence: list[Column], origin: str, method: str) -> DataFrame:
    note = [F.lit(NOTES[kind]).alias("note")] if kind in NOTES else []
    return rows.select(source.alias("source_id"), target.alias("target_id"), F.lit(kind).alias("type"), F.to_json(F.struct(*evidence, *note)).alias("evidence"), F.lit(origin).alias("source"), F.lit(method).alias("method"))


def _node(rows: DataFrame, identifier: Column, kind: str, name: Column, source: str, pos: str = "pos", organism: Column | None = None) -> DataFrame:
    organism = F.lit(None).cast("string") if organism is None else organism
    return rows.select(identifier.alias("id"), F.lit(kind).alias("type"), F.coalesce(name, F.lit("")).alias("name"), F.lit(source).alias("source"), organism.alias("organism"), F.col(pos).alias("pos"))


def _failure(rows: DataFrame, source: str, step: str, key: str, error: Column | str = "error") -> DataFrame:
    error = F.col(error) if isinstance(error, str) else error
    return rows.where(error.isNotNull()).select(F.lit(source).alias("source"), F.lit(step).alias("step"), F.col(key).cast("string").alias("key"), error.alias("error"))


def build(proteins: DataFrame, homologs: DataFrame, partner_replies: DataFrame, target_replies: DataFrame, activity_replies: DataFrame, caps: Caps = Caps()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, failures) of the graph around ``proteins``.

    ``proteins``: feature_id, locus_tag, product, human_identity, pos (unique). ``homologs``:
    feature_id, accession, identity, coverage, organism, via, name, pos. Partner replies are kept
    by locus tag, target replies by accession, activity replies by target. An accession or a
    target that several proteins lead to is asked and linked once. A target whose components are
    listed without the accession is refused, with a row in ``failures``; so is every reply that is
    an error or missing, and nothing else stops. Nodes are the first mention of their id, named by
    the first that is not blank. Replies are cut at ``caps`` before anything is exploded, so no key
    grows beyond them; proteins without an id are left out."""
    protein = F.concat(F.lit("brc:"), "feature_id")
    base = proteins.where(F.coalesce("feature_id", F.lit("")) != "").withColumnRenamed("pos", "_p").withColumn("pos", _place(F.col("_p"), 0))
    nodes = [_node(base, protein, "protein", F.col("product"), "proteins")]

    tagged = _asked(base.where(F.coalesce("locus_tag", F.lit("")) != "").select("feature_id", "locus_tag", "_p"), partner_replies, "locus_tag")
    nodes.append(_node(tagged.where("error is null").withColumn("pos", _place(F.col("_p"), 1)), protein, "protein", F.col("locus_tag"), "proteins"))
    rows = F.slice(F.from_json("payload_json", _PARTNER), 1, caps.partners)
    partners = tagged.where("error is null").select("feature_id", "_p", F.posexplode(rows).alias("n", "r"))
    name = F.coalesce(F.nullif("r.preferredName_B", F.lit("")), F.col("r.stringId_B"))
    partners = partners.withColumn("name", name).where("name <> ''").withColumn("partner", F.concat(F.lit("string:"), F.coalesce("r.stringId_B", "name"))).withColumn("pos", _place(F.col("_p"), 1, 1, F.col("n")))
    nodes.append(_node(partners, F.col("partner"), "protein", F.col("name"), "STRING"))
    scores = [as_float(F.col(f"r.{c}")).alias(n) for c, n in (("score", "combined_score"), ("escore", "experimental_score"), ("dscore", "database_score"), ("tscore", "textmining_score"))]
    edges = [_edge(partners, protein, F.col("partner"), "interacts_with", scores, "STRING", "interaction_partners")]

    own = homologs.where(F.coalesce("accession", F.lit("")) != "").withColumnRenamed("pos", "_h").join(base.select("feature_id", "_p"), "feature_id")
    own = own.withColumn("pos", _place(F.col("_p"), 2, F.col("_h"))).withColumn("homolog", F.concat(F.lit("uniprot:"), "accession"))
    nodes.append(_node(own, F.col("homolog"), "protein", F.col("name"), "UniProt", organism=F.col("organism")))
    edges.append(_edge(own, protein, F.col("homolog"), "homolog_of", [F.col("identity").alias("percent_identity"), "coverage", "organism", "via"], "homology", "sequence comparison"))

    first = own.groupBy("accession").agg(F.min(F.struct("_p", "_h")).alias("at")).select("accession", "at.*")
    replies = _asked(first, target_replies, "accession")
    found = replies.where("error is null").select("accession", "_p", "_h", F.posexplode(F.slice(F.from_json("payload_json", _TARGET)["targets"], 1, caps.targets)).alias("n", "t")).where("t.target_chembl_id <> ''")
    listed = F.coalesce(F.size("t.target_components"), F.lit(0)) > 0
    meant = ~listed | F.coalesce(F.exists("t.target_components", lambda c: c["accession"] == F.col("accession")), F.lit(False))
    found = found.select("accession", F.col("t.target_chembl_id").alias("target"), "t.pref_name", "t.organism", meant.alias("meant"), _place(F.col("_p"), 2, F.col("_h"), 1 + F.col("n")).alias("pos"))
    refused = F.when(~F.col("meant"), F.concat("target", F.lit(" does not list "), "accession", F.lit(" as a component; the filter did not apply")))
    kept = found.where("meant")
    node = F.concat(F.lit("chembl:"), "target")
    nodes.append(_node(kept, node, "chembl_target", F.col("pref_name"), "ChEMBL", organism=F.col("organism")))
    edges.append(_edge(kept, F.concat(F.lit("uniprot:"), "accession"), node, "represented_by", ["accession"], "ChEMBL", "target"))

    once = kept.groupBy("target").agg(F.min("pos").alias("at"))
    measured = _asked(once, activity_replies, "target")
    each = measured.where("error is null").select("target", "at", F.posexplode(F.slice(F.from_json("payload_json", _ACTIVITY)["activities"], 1, caps.compounds)).alias("m", "a")).where("a.molecule_chembl_id <> ''")
    each = each.withColumn("pos", _place(F.col("at.p0"), 2, F.col("at.p2"), F.col("at.p3"), 1 + F.col("m"))).withColumn("compound", F.concat(F.lit("compound:"), "a.molecule_chembl_id"))
    nodes.append(_node(each, F.col("compound"), "compound", F.col("a.molecule_chembl_id"), "ChEMBL"))
    values = [F.col(f"a.{c}") for c in ("standard_type", "standard_value", "standard_units", "pchembl_value", "assay_chembl_id")]
    edges.append(_edge(each, F.col("compound"), node, "target_of", values, "ChEMBL", "activity"))

    # A relation to a human protein that is known by name alone gets no accession.
    human = base.where("human_identity <> 0").withColumn("pos", _place(F.col("_p"), 3))
    known = F.concat(F.lit("human:"), F.coalesce(F.nullif(slug(F.coalesce("product", F.lit(""))), F.lit("")), slug(F.col("feature_id"))))
    nodes.append(_node(human, known, "protein", F.col("product"), "specialty table", organism=F.lit("Homo sapiens")))
    edges.append(_edge(human, protein, known, "homolog_of", [F.col("human_identity").alias("percent_identity"), F.lit("Homo sapiens").alias("organism"), F.lit("specialty table").alias("via")], "specialty table", "specialty table"))

    failures = [_failure(tagged, "STRING", "interaction_partners", "feature_id"), _failure(replies, "ChEMBL", "target", "accession"), _failure(found, "ChEMBL", "target", "accession", refused), _failure(measured, "ChEMBL", "activity", "target")]
    return upsert_nodes(_all(nodes)), _all(edges), _all(failures)


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def summary(nodes: DataFrame, edges: DataFrame, caps: Caps = Caps()) -> DataFrame:
    """Rows (part, type, n): how many nodes and edges of each type, and the caps that bound them."""
    count = lambda df, part: df.groupBy(F.lit(part).alias("part"), "type").agg(F.count("*").alias("n"))
    bounds = nodes.sparkSession.createDataFrame([("cap", k, v) for k, v in asdict(caps).items()], "part string, type string, n long")
    return _all([count(nodes, "node"), count(edges, "edge"), bounds])


def dangling(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ends of edges that no node has; none in a sound graph."""
    ends = edges.select(F.explode(F.array("source_id", "target_id")).alias("id")).distinct()
    return ends.join(nodes, "id", "left_anti")
