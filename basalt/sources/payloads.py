"""Cached service replies (key, payload_json) as tables, by explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.scalar import as_float, as_int, coverage
from basalt.operators.best import first_per_key

#: Components of structure entries that are no ligands. Fixed values.
ADDITIVES = (
    "HOH DOD GOL EDO PEG PG4 PGE PGO P6G 1PE 2PE MPD MRD SO4 PO4 ACT ACY FMT CIT FLC TRS TAR MES EPE IMD DMS DMF URE NH4 AZI BME OXL SCN NO3 CO3 BCT "
    "IOD BR CL FLU UNX UNL"
).split()
METALS = "NA K MG CA ZN MN FE FE2 NI CU CU1 CO CD HG PT AU AG PB SR BA CS RB LI AL W MO V".split()
GLYCANS = "NAG NDG BMA MAN BGC GLC GAL GLA FUC FUL XYS XYP SIA NGA A2G RIB SUC".split()
#: Evidence codes that stand for an experiment. Fixed values.
EXPERIMENTAL = ("ECO:0000269", "ECO:0007744")

_CONTEXT = "sequence_identity string, evalue string, bitscore string, query_beg string, query_end string, query_length string, subject_length string"
SEARCH = f"result_set array<struct<identifier: string, services: array<struct<nodes: array<struct<match_context: array<struct<{_CONTEXT.replace(' string', ': string')}>>>>>>>>"
PREDICTION = (
    "entryId string, latestVersion string, globalMetricValue string, uniprotStart string, uniprotEnd string, uniprotSequence string, cifUrl string, modelCreatedDate string"
)
ALIGNMENTS = "target: string, eval: string, prob: string, seqId: string, score: string, qLen: string, qStartPos: string, qEndPos: string, dbLen: string, dbStartPos: string, dbEndPos: string, taxName: string"
FOLD_SEARCH = f"results array<struct<db: string, alignments: array<array<struct<{ALIGNMENTS}>>>>>"
ENTRY = (
    "primaryAccession string, uniProtkbId string, proteinDescription struct<recommendedName: struct<fullName: struct<value: string>, ecNumbers: array<struct<value: string>>>>, "
    "genes array<struct<geneName: struct<value: string>>>, organism struct<taxonId: string>, "
    "uniProtKBCrossReferences array<struct<database: string, id: string, properties: array<struct<key: string, value: string>>>>, "
    "comments array<struct<commentType: string, subcellularLocations: array<struct<location: struct<value: string, evidences: array<struct<evidenceCode: string>>>>>>>"
)


def classify_components(components: Column) -> tuple[Column, Column]:
    """Sorted unique (ligands, metals); additives and glycans are neither."""
    clean = F.array_distinct(F.filter(F.transform(components, lambda x: F.upper(F.trim(x))), lambda x: x.isNotNull() & (x != "")))
    ligands = F.filter(clean, lambda x: ~x.isin(*ADDITIVES, *METALS, *GLYCANS))
    return F.array_sort(ligands), F.array_sort(F.filter(clean, lambda x: x.isin(*METALS)))


def structure_search(cache: DataFrame) -> DataFrame:
    """Hits of sequence searches: for each entity the match with the best bit score, the first
    on ties, with its query coverage. A reply that cannot be read is ``query-failed``."""
    parsed = cache.select("cache_key", F.from_json("payload_json", SEARCH).alias("r"))
    entities = parsed.select("cache_key", F.col("r.result_set").isNull().alias("failed"), F.explode_outer("r.result_set").alias("e"))
    contexts = F.flatten(F.transform(F.flatten(F.transform("e.services", lambda s: s["nodes"])), lambda n: n["match_context"]))
    each = entities.select("cache_key", "failed", F.col("e.identifier").alias("entity_id"), F.posexplode_outer(contexts).alias("pos", "c"))
    rows = each.select(
        "cache_key", "failed", "entity_id", "pos", F.coalesce(as_float(F.col("c.sequence_identity")), F.lit(0.0)).alias("identity"),
        F.coalesce(as_float(F.col("c.evalue")), F.lit(1.0)).alias("evalue"), F.coalesce(as_float(F.col("c.bitscore")), F.lit(0.0)).alias("bitscore"),
        F.coalesce(as_int(F.col("c.query_beg")), F.lit(1)).alias("query_beg"), F.coalesce(as_int(F.col("c.query_end")), F.lit(0)).alias("query_end"),
        F.coalesce(as_int(F.col("c.query_length")), F.lit(0)).alias("query_length"),
    )
    best = first_per_key(rows, ["cache_key", "entity_id"], [F.desc("bitscore"), F.col("pos")])
    found = best.withColumn("query_coverage", coverage(F.col("query_beg"), F.col("query_end"), F.col("query_length"))).withColumn("entry_id", F.substring_index("entity_id", "_", 1))
    return found.withColumn("status", F.when(F.col("failed"), "query-failed").when(F.col("entity_id").isNull(), "no-hit").otherwise("found")).drop("failed", "pos")


def predicted_models(cache: DataFrame) -> DataFrame:
    """One row per lookup: the most confident fragment, or why there is none. A stored status
    of 404 means that no model exists, 400 that the identifier was refused."""
    code = as_int(F.get_json_object("payload_json", "$._http_status"))
    read = cache.withColumn("code", code).withColumn("entries", F.from_json("payload_json", f"array<struct<{PREDICTION.replace(' string', ': string')}>>"))
    scored = F.transform("entries", lambda e, i: F.struct(F.coalesce(as_float(e["globalMetricValue"]), F.lit(0.0)).alias("plddt"), (-i).alias("order"), e.alias("e")))
    best = read.withColumn("best", F.array_max(F.filter(scored, lambda x: x["e"]["entryId"].isNotNull())))
    status = (
        F.when(F.col("code") == 404, "no-model").when(F.col("code") == 400, "invalid").when(F.col("code").isNotNull(), "failed")
        .when(F.col("best").isNotNull(), "found").when(F.size("entries") == 0, "no-model").otherwise("failed")
    )
    begin, end, length = as_int(F.col("best.e.uniprotStart")), as_int(F.col("best.e.uniprotEnd")), F.length("best.e.uniprotSequence")
    return best.select(
        "cache_key", status.alias("status"), F.col("best.e.entryId").alias("entry_id"), F.nullif(F.col("best.plddt"), F.lit(0.0)).alias("mean_plddt"),
        F.when(length > 0, coverage(begin, end, length)).alias("coverage"), F.col("best.e.cifUrl").alias("url"),
    )


def fold_search(cache: DataFrame, max_evalue: float = 1e-4, min_coverage: float = 0.4) -> DataFrame:
    """Significant structure alignments, best first by ``pos``; the coverage gate applies only
    where coverage is known."""
    parsed = cache.select("cache_key", F.explode(F.from_json("payload_json", FOLD_SEARCH)["results"]).alias("r"))
    each = parsed.select("cache_key", F.col("r.db").alias("database"), F.posexplode(F.flatten("r.alignments")).alias("pos", "a"))
    span = lambda lo, hi, n: F.when(as_float(F.col(n)) > 0, coverage(as_float(F.col(lo)), as_float(F.col(hi)), as_float(F.col(n))))
    rows = each.select(
        "cache_key", "database", "pos", F.col("a.target").alias("target"), as_float(F.col("a.eval")).alias("evalue"), as_float(F.col("a.prob")).alias("probability"),
        as_float(F.col("a.seqId")).alias("identity"), span("a.qStartPos", "a.qEndPos", "a.qLen").alias("query_coverage"), span("a.dbStartPos", "a.dbEndPos", "a.dbLen").alias("target_coverage"),
        F.col("a.taxName").alias("taxonomy"),
    )
    return rows.where((F.col("evalue") <= max_evalue) & (F.col("query_coverage").isNull() | (F.col("query_coverage") >= min_coverage)))


def entries(cache: DataFrame) -> DataFrame:
    """Protein entries: names, gene, taxon and the identifiers that they cross-reference."""
    r = cache.select("cache_key", F.from_json("payload_json", ENTRY).alias("r")).where(F.col("r.primaryAccession").isNotNull())
    refs = lambda db: F.coalesce(F.array_distinct(F.transform(F.filter("r.uniProtKBCrossReferences", lambda x: (x["database"] == db) & (x["id"] != "")), lambda x: x["id"])), F.array().cast("array<string>"))
    return r.select(
        "cache_key", F.col("r.primaryAccession").alias("accession"), F.col("r.uniProtkbId").alias("entry_name"), F.col("r.proteinDescription.recommendedName.fullName.value").alias("protein_name"),
        F.get("r.genes", 0)["geneName"]["value"].alias("gene"), as_int(F.col("r.organism.taxonId")).alias("taxon_id"), *(refs(db).alias(db.lower()) for db in ("PDB", "ChEMBL", "RefSeq")),
    )


def entry_terms(cache: DataFrame) -> DataFrame:
    """Long terms (cache_key, kind, id, name, evidence) of protein entries."""
    r = cache.select("cache_key", F.from_json("payload_json", ENTRY).alias("r"))
    each = r.select("cache_key", F.explode("r.uniProtKBCrossReferences").alias("x"))
    named = F.map_from_entries(F.coalesce(F.transform("x.properties", lambda p: F.struct(p["key"], p["value"])), F.array().cast("array<struct<key:string,value:string>>")))
    kind = F.create_map(*(F.lit(v) for v in ("GO", "go", "KEGG", "kegg_gene", "Pfam", "pfam", "InterPro", "interpro")))[F.col("x.database")]
    refs = each.select("cache_key", kind.alias("kind"), F.col("x.id").alias("id"), F.coalesce(named["GoTerm"], named["EntryName"]).alias("name"), named["GoEvidenceType"].alias("evidence")).where("kind is not null and id <> ''")
    numbers = r.select("cache_key", F.lit("ec").alias("kind"), F.explode("r.proteinDescription.recommendedName.ecNumbers.value").alias("id"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("evidence"))
    return refs.unionByName(numbers)


def entry_locations(cache: DataFrame) -> DataFrame:
    """Locations with their source: an experiment outranks an inference."""
    r = cache.select("cache_key", F.explode(F.from_json("payload_json", ENTRY)["comments"]).alias("c")).where("c.commentType = 'SUBCELLULAR LOCATION'")
    each = r.select("cache_key", F.explode("c.subcellularLocations.location").alias("l"))
    tested = F.coalesce(F.exists("l.evidences", lambda e: e["evidenceCode"].isin(*EXPERIMENTAL)), F.lit(False))
    return each.select("cache_key", F.col("l.value").alias("location"), F.when(tested, "uniprot_experimental").otherwise("uniprot").alias("source"))
