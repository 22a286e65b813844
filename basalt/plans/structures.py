"""Which structure a protein gets, whether it is good enough, and where its pockets are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions import scalar as S
from basalt.operators.aggregates import check, checks_pass, contacts, failed_reasons, islands

#: Quality thresholds. Fixed values.
MIN_IDENTITY, MIN_COVERAGE, MAX_RESOLUTION, MIN_PLDDT, MIN_MODEL_COVERAGE = 0.25, 0.50, 3.50, 70.0, 0.80
CONTACT = 4.5


def choose(proteins: DataFrame) -> DataFrame:
    """Source and accession: an experimental homolog, in whose place a homolog that binds
    something may stand, else a predicted model, else a cross-reference, else a prediction is
    required. ``swapped`` tells that the best identity was given up for a bound site."""
    swap = F.col("holo_entity").isNotNull() & (F.col("holo_entity") != F.col("best_entity")) & F.col("best_entity").isNotNull()
    entity = F.when(swap, F.col("holo_entity")).otherwise(F.col("best_entity"))
    pick = lambda source, accession: F.when(accession.isNotNull(), F.struct(F.lit(source).alias("source"), accession.alias("accession")))
    found = F.coalesce(pick("pdb", entity), pick("afdb", F.col("model_id")), pick("pdb", F.get("pdb_refs", 0)), pick("afdb", F.col("model_ref")))
    return proteins.withColumn("choice", found).withColumn("swapped", swap).withColumn("status", F.when(found.isNull(), "prediction_required").otherwise("collected"))


def gate(structures: DataFrame) -> DataFrame:
    """``checks``, ``passed`` and ``reasons``; resolution is not asked of NMR structures."""
    nmr = F.upper(F.coalesce("method", F.lit(""))).contains("NMR")
    base = F.array(check("identity", F.col("identity"), ">=", MIN_IDENTITY), check("coverage", F.col("coverage"), ">=", MIN_COVERAGE))
    solved = F.when(nmr, base).otherwise(F.concat(base, F.array(check("resolution", F.col("resolution"), "<=", MAX_RESOLUTION))))
    model = F.array(check("mean_plddt", F.col("mean_plddt"), ">=", MIN_PLDDT), check("coverage", F.col("coverage"), ">=", MIN_MODEL_COVERAGE))
    out = structures.withColumn("checks", F.when(F.col("source") == "pdb", solved).otherwise(model))
    return out.withColumn("passed", checks_pass(F.col("checks"))).withColumn("reasons", failed_reasons(F.col("checks")))


def usable(model: DataFrame, min_plddt: float = MIN_PLDDT, min_coverage: float | None = MIN_MODEL_COVERAGE) -> DataFrame:
    """Whether a predicted model will do, and why (not); unknown numbers do not refuse it."""
    low = F.coalesce(F.col("mean_plddt") < min_plddt, F.lit(False))
    short = F.coalesce(F.col("coverage") < min_coverage, F.lit(False)) if min_coverage is not None else F.lit(False)
    reason: Column = (
        F.when(F.col("status") != "found", F.concat(F.lit("no model ("), "status", F.lit(")")))
        .when(low, F.concat(F.lit("confidence is "), S.confidence_band(F.col("mean_plddt"))))
        .when(short, F.lit("covers too little"))
    )
    return model.withColumn("usable", reason.isNull()).withColumn("reason", F.coalesce(reason, S.confidence_band(F.col("mean_plddt"))))


def weak_regions(residues: DataFrame, below: float = MIN_PLDDT) -> DataFrame:
    """Runs of consecutive residues of low confidence, with their mean."""
    return islands(residues, ["structure", "chain"], "seq_id", F.col("b") < below, "b")


def pockets(atoms: DataFrame, skip: tuple[str, ...] = ("HOH",), radius: float = CONTACT) -> DataFrame:
    """One row per bound component: its residues in contact, nearest distances and the centre of
    their nearest atoms."""
    protein = atoms.where("group_PDB = 'ATOM'").select("structure", "chain", "seq_id", F.col("component").alias("residue"), "x", "y", "z", "b")
    bound = atoms.where((F.col("group_PDB") == "HETATM") & ~F.col("component").isin(*skip)).select("structure", F.col("component").alias("ligand"), F.col("chain").alias("ligand_chain"), "x", "y", "z")
    near = contacts(protein, bound.select("structure", "ligand", "ligand_chain", "x", "y", "z"), "structure", radius)
    keys = ["structure", "ligand_2", "ligand_chain_2", "chain", "seq_id", "residue"]
    closest = near.groupBy(*keys).agg(F.min("distance").alias("distance"), F.min_by(F.struct("x", "y", "z", "b"), F.struct("distance", "x", "y", "z")).alias("at"))
    return closest.groupBy("structure", F.col("ligand_2").alias("ligand"), F.col("ligand_chain_2").alias("ligand_chain")).agg(
        F.count("*").alias("n_residues"), F.array_sort(F.collect_list(F.struct("chain", "seq_id", "residue", "distance"))).alias("residues"),
        F.avg("at.x").alias("x"), F.avg("at.y").alias("y"), F.avg("at.z").alias("z"), F.avg("at.b").alias("mean_b"),
    )


def reasons(scored: DataFrame) -> DataFrame:
    """``reason``: what speaks for and against each protein, in one line."""
    percent = lambda c: F.concat(F.round(c * 100, 0).cast("int"), F.lit("%"))
    hit = F.when(F.col("entity_id").isNotNull(), F.concat(F.lit("structure "), "entity_id", F.lit(" identity "), percent(F.col("identity")), F.lit(", coverage "), percent(F.col("query_coverage"))))
    none = F.when(F.col("status") == "query-failed", "structure search failed").otherwise("no qualifying structure")
    says = {"virulence_amr": "virulence or resistance", "essential": "essential", "drug_target": "known target", "annotation_gap": "uncharacterised", "ligandable_homolog": "bound homolog", "surface_bonus": "exposed", "membrane_penalty": "membrane protein (penalty)", "human_homolog_penalty": "human homolog (penalty)"}
    parts = [F.coalesce(hit, none), *(F.when(F.col(c) != 0, text) for c, text in says.items()), F.when(F.col("disqualified"), "disqualified")]
    return scored.withColumn("reason", F.concat_ws("; ", *parts))
