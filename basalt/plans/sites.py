"""Binding sites read from the entry that binds something, ranked, and a reason where there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.functions.scalar import fixed
from basalt.operators.aggregates import contacts

#: Reach of a contact, residues of a site at least, and its least mean confidence. Fixed values.
CONTACT, MIN_RESIDUES, MIN_PLDDT = 4.5, 3, 70.0

TEMPLATE = "structure string, accession string, source string, template string, ligands array<string>, metals array<string>"


def chains_of(rows: DataFrame, wanted: DataFrame, chains: DataFrame) -> DataFrame:
    """The rows (structure, chain, …) on chains of the wanted entity; of a structure whose file does
    not say which chains those are, all rows. ``wanted`` has structure and entity, ``chains``
    structure, entity and chain."""
    ours = chains.join(wanted.select("structure", "entity").distinct(), ["structure", "entity"]).select("structure", "chain").distinct()
    told = ours.select("structure").distinct()
    return rows.join(ours, ["structure", "chain"], "left_semi").unionByName(rows.join(told, "structure", "left_anti"))


def _templates(templates: DataFrame) -> DataFrame:
    """Templates with their entity, upper-cased component names, and whether the template is the very
    entry whose coordinates were collected."""
    entry = lambda c: F.upper(F.substring_index(F.coalesce(c, F.lit("")), "_", 1))
    names = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.upper(x)), lambda x: F.coalesce(x != "", F.lit(False)))
    own = (entry("template") != "") & (entry("accession") != "") & (entry("template") == entry("accession"))
    entity = F.when(F.instr("template", "_") > 0, F.expr("substring(template, instr(template, '_') + 1)")).otherwise("")
    return templates.select("structure", "source", "template", names("ligands").alias("ligands"), names("metals").alias("metals"), entity.alias("entity"), own.alias("own"))


def holo_sites(atoms: DataFrame, templates: DataFrame, chains: DataFrame, radius: float = CONTACT, least: int = MIN_RESIDUES, min_plddt: float = MIN_PLDDT) -> DataFrame:
    """One row for each copy of a named component that residues of our entity line.

    ``atoms`` has structure, pos (its place in the file), group_PDB, component, chain, seq_id,
    auth_seq_id, auth_chain, x, y, z and b; ``templates`` is as ``TEMPLATE``. Only the entry that binds
    a component holds its site, so a structure that is not its template's entry has none. A site needs
    ``least`` residues within ``radius`` of the component; ligands rank before metals, then by
    residues, then by place. A metal's site, and any site of an entry with one of the metals, needs a
    cofactor. In a predicted model the column b is a confidence: a site whose residues' mean lies
    below ``min_plddt`` is not usable, and says so."""
    wanted = _templates(templates).where(F.col("own") & (F.size("ligands") + F.size("metals") > 0))
    placed = atoms.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()).join(wanted.select("structure"), "structure", "left_semi")
    residue = F.struct("chain", "seq_id", "auth_seq_id", "component")
    bound = placed.where("group_PDB = 'HETATM'").join(wanted.select("structure", "ligands", "metals"), "structure")
    bound = bound.withColumn("kind", F.when(F.array_contains("ligands", F.col("component")), "ligand").when(F.array_contains("metals", F.col("component")), "metal")).where("kind is not null")
    copies = bound.groupBy("structure", "kind", residue.alias("copy")).agg(F.min("pos").alias("first"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.avg("z").alias("cz"))
    metals = bound.where(F.array_contains("metals", F.col("component"))).groupBy("structure").agg(F.array_sort(F.collect_set("component")).alias("metals_in_entry"))

    polymer = chains_of(placed.where("group_PDB = 'ATOM'"), wanted, chains)
    left = polymer.select("structure", residue.alias("residue"), "pos", "b", F.coalesce(F.nullif("auth_chain", F.lit("")), "chain").alias("shown"), "x", "y", "z")
    right = bound.select("structure", residue.alias("copy"), "x", "y", "z")
    near = contacts(left, right, "structure", radius).groupBy("structure", F.col("copy_2").alias("copy"), "residue")
    lining = near.agg(F.min("distance").alias("distance"), F.min_by(F.struct("b", "shown"), F.struct("distance", "pos")).alias("at"))
    listed = F.struct(F.col("at.shown").alias("chain"), F.coalesce("residue.seq_id", F.lit(0)).alias("place"), F.coalesce("residue.auth_seq_id", F.lit("")).alias("auth"), F.col("residue.component").alias("component"), F.round("distance", 2).alias("distance"))
    sites = lining.groupBy("structure", "copy").agg(F.count("*").alias("n_residues"), F.array_sort(F.collect_list(listed)).alias("residues"), F.avg("at.b").alias("mean_b")).where(F.col("n_residues") >= least)

    found = sites.join(copies, ["structure", "copy"]).join(metals, "structure", "left").join(wanted.select("structure", "source"), "structure")
    model = (F.col("source") == "afdb") & F.col("mean_b").isNotNull()
    poor = F.coalesce(model & (F.col("mean_b") < min_plddt), F.lit(False))
    why = F.concat(F.lit("mean pLDDT "), fixed(F.col("mean_b"), 1), F.lit(f" over the site's own residues is below {min_plddt:.0f}"))
    order = [F.col("kind") != "ligand", F.desc("n_residues"), F.col("first")]
    return found.select(
        "structure", F.concat("copy.component", F.lit("_"), "copy.chain", F.coalesce("copy.auth_seq_id", F.lit(""))).alias("site"), F.row_number().over(W.partitionBy("structure").orderBy(*order)).alias("rank"),
        F.col("copy.component").alias("component"), "kind", "n_residues", "residues", F.struct("cx", "cy", "cz").alias("center"),
        ((F.col("kind") == "metal") | F.col("metals_in_entry").isNotNull()).alias("cofactor_required"), "metals_in_entry", (~poor).alias("usable"), F.when(poor, why).otherwise("").alias("reason"),
        F.when(model, F.col("mean_b")).alias("confidence"),
    )


def site_status(templates: DataFrame, sites: DataFrame) -> DataFrame:
    """One row for each structure of ``templates``: how many sites it has, how many of them are
    usable, and if none, which case it fell into: not covered is another claim than none there."""
    counts = sites.groupBy("structure").agg(F.count("*").alias("sites"), F.count_if("usable").alias("usable"))
    joined = _templates(templates).join(counts, "structure", "left").na.fill(0, ["sites", "usable"])
    bound = F.array_join(F.concat("ligands", "metals"), ", ")
    reason = (
        F.when(F.col("sites") > 0, "")
        .when(F.trim(F.coalesce("template", F.lit(""))) == "", "no qualifying homolog binds a ligand or metal; a pocket detector is needed and none ran")
        .when(~F.col("own"), F.concat(F.lit("the binding site is in "), "template", F.lit(", not in the collected structure; transferring it needs a superposition")))
        .otherwise(F.concat(F.lit("no residue of our entity lines "), F.coalesce(F.nullif(bound, F.lit("")), F.lit("the bound components"))))
    )
    status = F.when(F.col("sites") == 0, "no_pocket").when(F.col("usable") > 0, "ok").otherwise("all_rejected")
    return joined.select("structure", status.alias("status"), "sites", "usable", F.col("own").alias("template_is_structure"), reason.alias("reason"))
