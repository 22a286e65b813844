"""The full score of a protein: all evidence, where it comes from, and a reason for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions import scalar as S
from basalt.operators.best import best_per_key
from basalt.operators.organisms import one_genus, one_species
from basalt.plans import triage as G

#: Name of the source that calls from specialty rows get.
SPECIALTY_SOURCE = "specialty"
#: Taxon of people, whose structures are marked. Fixed value.
HUMAN_TAXON = 9606
#: Components that a run may not have measured, and the columns that say whether it did.
OPTIONAL = {"surface_bonus": "surface_measured", "ligandable_homolog": "ligandable_measured", "membrane_penalty": "membrane_measured"}
#: Longest text of an evidence's basis. Fixed value.
BASIS_LENGTH = 120


def resistance_basis(specialty: DataFrame) -> DataFrame:
    """Rows (feature_id, amr_basis, antibiotic_target): what a feature's resistance rows rest on."""
    said = F.lower(F.coalesce("classification", F.lit("")))
    mechanism = F.exists(F.array(*map(F.lit, G.RESISTANCE)), lambda m: said.contains(m))
    target = said.contains(G.TARGET_ONLY) & ~mechanism
    rows = specialty.where(F.lower(F.trim("property")) == "antibiotic resistance").select("feature_id", "classification", mechanism.alias("mechanism"), target.alias("target"))
    named = F.array_join(F.array_sort(F.collect_set(F.when(F.col("mechanism"), F.col("classification")))), "; ")
    out = rows.groupBy("feature_id").agg(named.alias("names"), F.bool_or("mechanism").alias("some"), F.bool_and("target").alias("only"), F.bool_or("target").alias("antibiotic_target"))
    basis = F.when(F.col("some"), F.left("names", F.lit(BASIS_LENGTH))).when(F.col("only"), G.TARGET_ONLY).otherwise("AMR row with no classification recorded")
    return out.select("feature_id", basis.alias("amr_basis"), "antibiotic_target")


def holo_hits(scored: DataFrame) -> DataFrame:
    """Per feature the best qualifying hit whose entry binds something: one with a ligand before one
    with metals alone."""
    bound = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    order = [F.desc(bound("ligands")), F.desc("hit_score"), F.desc("bitscore"), F.col("pos")]
    return best_per_key(scored, ["feature_id"], order, F.col("qualifies") & (bound("ligands") | bound("metals")), "gate_then_max").select("feature_id", F.col("entry_id").alias("holo_entry"))


def _optional(joined: DataFrame, part: DataFrame | None, columns: dict[str, str]) -> DataFrame:
    """Left join on feature_id, or null columns where nobody looked."""
    if part is not None:
        return joined.join(part.select("feature_id", *columns), "feature_id", "left")
    return joined.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items()})


def score_proteins(
    proteins: DataFrame, specialty: DataFrame, hits: DataFrame, annotation: DataFrame | None = None, human: DataFrame | None = None,
    essential: DataFrame | None = None, assays: DataFrame | None = None, retrieval: DataFrame | None = None, organism: Column | None = None,
) -> DataFrame:
    """One row per protein: components, whether each was measured, flags and their sources.

    ``proteins`` has feature_id and product; ``hits`` what ``triage.scored_hits`` wants and entry_id,
    ligands, metals, organism and taxon. Computed evidence comes before the specialty table's:
    ``human`` (feature_id, human_pct, human_source) and ``essential`` (feature_id, essential_call,
    essential_from; a null call decides nothing). ``assays`` (feature_id, assay_targets) lists targets
    with assayed compounds, ``retrieval`` (feature_id, retrieval_status, error) how the search went:
    a failed search is not an absent hit. ``organism`` names the query's organism, a column of
    ``proteins`` or a literal; blank or absent, nothing is said about species and genus."""
    scored = G.scored_hits(hits)
    best = G.best_hits(scored).select(
        "feature_id", "hit_score", "entry_id", "identity", "query_coverage", "resolution", "ligands", "metals", "has_ligand", "has_partner",
        F.col("organism").alias("hit_organism"), F.col("taxon").alias("hit_taxon"), "qualifying_hits", "distinct_entries",
    )
    joined = proteins.withColumn("query_organism", organism if organism is not None else F.lit(None).cast("string"))
    joined = joined.join(G.specialty_flags(specialty), "feature_id", "left").join(resistance_basis(specialty), "feature_id", "left")
    joined = joined.join(best, "feature_id", "left").join(holo_hits(scored), "feature_id", "left")
    joined = _optional(joined, annotation, {"membrane_value": "boolean", "membrane_source": "string", "exposed": "boolean", "signal_source": "string", "surface_source": "string", "secreted_source": "string"})
    joined = _optional(joined, human, {"human_pct": "double", "human_source": "string"})
    joined = _optional(joined, essential, {"essential_call": "boolean", "essential_from": "string"})
    joined = _optional(joined, assays, {"assay_targets": "array<string>"})
    joined = _optional(joined, retrieval, {"retrieval_status": "string", "error": "string"})

    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    sure = lambda c: F.coalesce(c, F.lit(False))
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    col, hit = F.col, F.col("hit_score").isNotNull()
    listed = lambda c: F.array_join(F.slice(c, 1, 3), ",")
    shared_entry = some("ligands") & sure(col("has_partner"))
    own_ligand = some("ligands") & ~sure(col("has_partner"))
    basis = (
        F.when(own_ligand, F.concat(F.lit("ligand bound in "), "entry_id", F.lit(": "), listed("ligands")))
        .when(some("assay_targets"), F.concat(F.lit("compounds assayed against the mapped target: "), F.array_join(F.slice("assay_targets", 1, 3), ";")))
        .when(shared_entry, F.concat(F.lit("ligand in "), "entry_id", F.lit(" not credited: the entry has partners")))
        .otherwise("")
    )
    pct = F.coalesce("human_pct", "human_identity_pct")
    called = F.coalesce("essential_call", sure(col("essential")))
    determined = F.trim(F.coalesce("query_organism", F.lit(""))) != ""
    failed = sure(col("retrieval_status") == "query-failed")
    surface_from = F.coalesce("signal_source", "surface_source", "secreted_source")
    return joined.withColumns({"human_identity_pct": pct, "is_essential": called}).withColumns(
        {
            "pdb_evidence": F.round(F.coalesce("hit_score", F.lit(0.0)) / S.MAX_HIT_SCORE, 6),
            "virulence_amr": F.greatest(one(col("virulence")), F.coalesce("amr_value", F.lit(0.0))),
            "drug_target": one(col("drug_target")),
            "essential": one(col("is_essential")),
            "annotation_gap": one(S.matches(col("product"), S.UNCHARACTERISED)),
            "surface_bonus": one(surface_from.isNotNull() & sure(col("exposed"))),
            "ligandable_homolog": one(own_ligand | some("assay_targets")),
            "membrane_penalty": one(col("membrane_value")),
            "human_homolog_penalty": F.round(F.coalesce("human_identity_pct", F.lit(0.0)) / 100, 6),
            "qualifying_hits": F.coalesce("qualifying_hits", F.lit(0)), "distinct_entries": F.coalesce("distinct_entries", F.lit(0)),
            "surface_measured": surface_from.isNotNull(), "membrane_measured": col("membrane_source").isNotNull(), "ligandable_measured": hit | some("assay_targets"),
            "human_homolog_source": F.when(col("human_pct").isNotNull(), F.coalesce("human_source", F.lit(""))).when(col("human_identity_pct").isNotNull(), SPECIALTY_SOURCE).otherwise(""),
            "essential_source": F.when(col("essential_call").isNotNull(), F.coalesce("essential_from", F.lit(""))).otherwise(SPECIALTY_SOURCE),
            "close_human_homolog": sure(col("human_identity_pct") >= G.CLOSE_HUMAN_IDENTITY),
            "amr_basis": F.coalesce("amr_basis", F.lit("")), "antibiotic_target": sure(col("antibiotic_target")),
            "ligandable_basis": basis, "surface_source": F.coalesce(surface_from, F.lit("")), "membrane_source": F.coalesce("membrane_source", F.lit("")),
            "no_hit": ~hit & ~failed, "search_failed": failed, "human_hit": sure(col("hit_taxon") == HUMAN_TAXON), "organism_determined": determined,
            "same_species_hit": F.when(determined, sure(one_species(col("query_organism"), col("hit_organism")))),
            "same_genus_hit": F.when(determined, sure(one_genus(col("query_organism"), col("hit_organism")))),
        }
    )


def reason() -> Column:
    """A sentence for every row of ``rank_proteins``, kept or not."""
    col = F.col
    percent = lambda c: F.format_string("%.0f%%", F.bround(c * 100, 0))
    resolution = F.concat(F.lit(", "), S.fixed(col("resolution"), 2), F.lit(" A"))
    hit = F.concat(F.lit("PDB "), col("entry_id").cast("string"), F.lit(" identity "), percent(col("identity")), F.lit(", coverage "), percent(col("query_coverage")), F.when(col("resolution").isNotNull(), resolution).otherwise(""))
    parts = [
        F.when(col("hit_score").isNotNull(), hit).when(col("search_failed"), "PDB search failed; no structural evidence recorded").otherwise("no qualifying PDB hit"),
        F.when(F.coalesce(F.size("ligands"), F.lit(0)) > 0, F.concat(F.lit("ligand-bound homolog: "), F.array_join(F.slice("ligands", 1, 3), ","))),
        F.when(col("virulence_amr") > 0, "virulence/AMR"),
        F.when(col("essential") > 0, "essential-gene ortholog"),
        F.when(col("drug_target") > 0, "known drug target"),
        F.when(col("annotation_gap") > 0, "uncharacterized product"),
        F.when(col("ligandable_homolog") > 0, F.concat(F.lit("ligandable homolog ("), "ligandable_basis", F.lit(")"))),
        F.when(col("surface_bonus") > 0, "surface-exposed or secreted"),
        F.when(col("membrane_penalty") > 0, "predicted membrane protein (penalty)"),
        F.when(col("human_homolog_penalty") > 0, F.concat(F.lit("human homolog "), percent(col("human_homolog_penalty")), F.lit(" identity (penalty)"))),
        F.when(col("same_species_hit"), "best structural hit is of the same species").when(col("same_genus_hit"), "best structural hit is of the same genus"),
        F.when(col("antibiotic_target"), "antibiotic target in a susceptible species, not a resistance gene"),
        F.when(col("disqualified_why") != "", F.concat(F.lit("DISQUALIFIED: "), "disqualified_why")),
    ]
    return F.concat_ws("; ", *parts)


def rank_proteins(scored: DataFrame, n: int, profile: G.Profile = G.PROFILES["bacterial-target"], run: list[str] | None = None) -> DataFrame:
    """``score_proteins`` with score, rank, selection, ``disqualified_why`` and ``reason``."""
    ranked = G.triage(scored, n, profile, run)
    source = F.when(F.col("human_homolog_source") != "", F.col("human_homolog_source")).otherwise("unknown source")
    why = F.when(F.col("disqualified"), F.concat(F.lit("human homolog "), S.fixed(F.col("human_identity_pct"), 1), F.lit("% identity ("), source, F.lit(")"))).otherwise("")
    return ranked.withColumn("disqualified_why", why).withColumn("reason", reason())


def run_manifest(ranked: DataFrame) -> DataFrame:
    """Rows (part, name, n): the counts of one run in one pass over its rows; parts are ``counts``,
    ``measured``, ``nonzero``, ``same_organism`` and ``retrieval``. Where no row's organism is
    determined, nothing is known of ``same_organism``: its numbers are null."""
    col = F.col
    sure = lambda c: F.coalesce(c, F.lit(False))
    known = F.bool_or("organism_determined")
    counted = {
        ("counts", "proteins_scored"): F.count("*"), ("counts", "selected"): F.count_if(col("selected")), ("counts", "disqualified"): F.count_if(col("disqualified")),
        ("counts", "no_hit"): F.count_if(col("no_hit")), ("counts", "search_failed"): F.count_if(col("search_failed")), ("counts", "hits_qualifying"): F.coalesce(F.sum("qualifying_hits"), F.lit(0)),
        **{("measured", c): F.count_if(col(flag)) for c, flag in OPTIONAL.items()},
        **{("nonzero", c): F.count_if(col(c) != 0) for c in G.WEIGHTS},
        **{("same_organism", f"{what}_{where}"): F.when(known, F.count_if(sure(col(f"same_{what}_hit")) & test)) for what in ("species", "genus") for where, test in (("total", F.lit(True)), ("selected", col("selected")))},
    }
    keys = list(counted)
    row = ranked.agg(*(x.cast("long").alias(f"_{i}") for i, x in enumerate(counted.values())))
    flat = row.select(F.explode(F.array(*(F.struct(F.lit(part).alias("part"), F.lit(name).alias("name"), col(f"_{i}").alias("n")) for i, (part, name) in enumerate(keys)))).alias("x")).select("x.*")
    status = ranked.groupBy(F.coalesce("retrieval_status", F.lit("not asked")).alias("name")).agg(F.count("*").alias("n"))
    return flat.unionByName(status.select(F.lit("retrieval").alias("part"), "name", "n"))


def failures(ranked: DataFrame) -> DataFrame:
    """Rows (step, key, error) of searches that failed: they stop no table of the run."""
    return ranked.where("search_failed").select(F.lit("search").alias("step"), F.col("feature_id").cast("string").alias("key"), F.coalesce("error", F.lit("")).alias("error"))
