"""Evidence triage: specialty flags, priorities, annotation merge, scores and selection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions import scalar as S
from basalt.operators.aggregates import resistance_evidence
from basalt.operators.best import best_per_key, provider_precedence, rank_select

#: Weights of the score's components and of the priority's reasons. Fixed values.
WEIGHTS = {
    "pdb_evidence": 0.40, "virulence_amr": 0.20, "essential": 0.15, "drug_target": 0.15, "annotation_gap": 0.30,
    "surface_bonus": 0.10, "ligandable_homolog": 0.10, "membrane_penalty": -0.15, "human_homolog_penalty": -0.25,
}
PRIORITY = {"virulence": 3, "drug_target": 3, "amr": 2, "essential": 2, "mechanism": 2, "transporter": 1, "surface": 1, "named_gene": 1, "human_homolog": -2}
#: Source ranks: experiment over dedicated predictor over inference over heuristic. Fixed values.
SOURCE_RANK = {"uniprot_experimental": 60, "deeptmhmm": 50, "signalp": 50, "psortb": 45, "interproscan": 40, "uniprot": 30, "eggnog": 20, "heuristic": 10}
CLOSE_HUMAN_IDENTITY = 40.0

#: Property and classification texts of specialty tables. Fixed values.
VIRULENCE = ("virulence factor", "virulance factor")
TARGET_ONLY = "antibiotic target in susceptible species"
RESISTANCE = (
    "conferring antibiotic resistance", "antibiotic efflux", "antibiotic inactivation", "efflux pump", "antibiotic target alteration",
    "antibiotic target replacement", "antibiotic target protection", "resistance via absence", "reduced permeability",
)


@dataclass(frozen=True)
class Profile:
    """A policy: component weights, and whether a close human homolog keeps a protein out."""

    name: str
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    disqualify_human_homologs: bool = True

    def __post_init__(self) -> None:
        odd = set(self.weights) ^ set(WEIGHTS)
        if odd:
            raise ValueError(f"a profile names every component once; check {sorted(odd)}")

    def score(self) -> Column:
        return S.weighted({n: F.col(n) for n in WEIGHTS}, self.weights)


PROFILES = {
    "bacterial-target": Profile("bacterial-target"),
    "evidence-only": Profile("evidence-only", {n: {"pdb_evidence": 0.40, "ligandable_homolog": 0.10}.get(n, 0.0) for n in WEIGHTS}, False),
}


def specialty_flags(specialty: DataFrame) -> DataFrame:
    """One row per feature: what its specialty rows say."""
    name = F.lower(F.trim("property"))
    said = F.lower(F.coalesce("classification", F.lit("")))
    amr = name == "antibiotic resistance"
    mechanism = amr & F.exists(F.array(*map(F.lit, RESISTANCE)), lambda m: said.contains(m))
    target = said.contains(TARGET_ONLY) & ~mechanism
    any_of = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    return specialty.groupBy("feature_id").agg(
        any_of(name.isin(*VIRULENCE)).alias("virulence"),
        any_of(name == "essential gene").alias("essential"),
        (any_of(name == "drug target") | any_of(amr & target)).alias("drug_target"),
        any_of(name == "transporter").alias("transporter"),
        any_of(name == "metal resistance").alias("metal_resistance"),
        F.max(F.when(name == "human homolog", S.as_float(F.col("identity")))).alias("human_identity_pct"),
        resistance_evidence(F.when(amr, mechanism), F.when(amr, target), F.when(amr, F.lit(1))).alias("amr_value"),
        F.array_sort(F.collect_set(S.specialty_type(F.col("property")))).alias("types"),
    )


def priorities(features: DataFrame, flags: DataFrame, mechanisms: Column | None = None) -> DataFrame:
    """Additive priority with its reasons, and the rank over all features.

    ``features`` has feature_id, gene, product, length and pos."""
    joined = features.join(flags.select("feature_id", "types"), "feature_id", "left").withColumn("types", F.coalesce("types", F.array().cast("array<string>")))
    has = lambda t: F.array_contains("types", t)
    reasons = {
        "virulence": has("virulence"), "amr": has("amr"), "drug_target": has("drug_target"), "essential": has("essential"), "transporter": has("transporter"),
        "mechanism": F.size(mechanisms) > 0 if mechanisms is not None else F.lit(False),
        "surface": S.matches(F.col("product"), S.SURFACE), "named_gene": F.trim(F.coalesce("gene", F.lit(""))) != "", "human_homolog": has("human_homolog"),
    }
    given = F.array(*(F.when(test, F.struct(F.lit(PRIORITY[n]).alias("points"), F.lit(n).alias("reason"))) for n, test in reasons.items()))
    scored = joined.withColumn("breakdown", F.filter(given, lambda x: x.isNotNull()))
    scored = scored.withColumn("priority", F.aggregate("breakdown", F.lit(0), lambda s, x: s + x["points"]))
    chosen = has("virulence") | has("amr") | has("drug_target") | reasons["mechanism"]
    return rank_select(scored.withColumn("eligible", chosen), [F.desc("priority"), F.desc("length"), F.col("pos")], None, ~F.col("eligible"))


def scored_hits(hits: DataFrame) -> DataFrame:
    """Hits with their gate and score; a hit below the gate scores nothing."""
    passes = S.hit_qualifies(F.col("evalue"), F.col("query_coverage"))
    base = F.col("identity") * F.col("query_coverage") * S.structure_quality(F.col("method"), F.col("resolution"))
    bonus = F.when(F.col("has_ligand"), S.LIGAND_BONUS).otherwise(0.0) + F.when(F.col("has_partner"), S.PARTNER_BONUS).otherwise(0.0) + F.when(F.col("has_annotation"), S.ANNOTATION_BONUS).otherwise(0.0)
    return hits.withColumn("qualifies", passes).withColumn("hit_score", F.when(passes, base + bonus).otherwise(0.0))


def best_hits(scored: DataFrame) -> DataFrame:
    """Per feature: the best qualifying hit, how many qualify and from how many entries."""
    order = [F.desc("hit_score"), F.desc("bitscore"), F.col("pos")]
    best = best_per_key(scored, ["feature_id"], order, F.col("qualifies"), "gate_then_max")
    counts = scored.where("qualifies").groupBy("feature_id").agg(F.count("*").alias("qualifying_hits"), F.count_distinct("entry_id").alias("distinct_entries"))
    return best.join(counts, "feature_id")


def merge_calls(calls: DataFrame) -> DataFrame:
    """Calls (feature_id, flag, value, source, pos) to one row per feature: every flag's winning
    value and source (null: nobody looked), and what follows from them."""
    won = provider_precedence(calls, ["feature_id", "flag"], SOURCE_RANK)
    flags = ["membrane", "signal", "surface", "secreted"]
    wide = won.groupBy("feature_id").pivot("flag", flags).agg(F.first("value").alias("value"), F.first("source").alias("source"))
    exposed = F.coalesce(F.col("surface_value"), F.lit(False)) | F.coalesce(F.col("secreted_value"), F.lit(False))
    known = F.coalesce("surface_source", "secreted_source", "signal_source")
    ranks = F.create_map(*(F.lit(x) for pair in SOURCE_RANK.items() for x in pair))
    sources = F.filter(F.array(*(F.col(f"{f}_source") for f in flags)), lambda s: s.isNotNull())
    return wide.withColumn("exposed", F.when(known.isNotNull(), exposed)).withColumn("weakest_rank", F.array_min(F.transform(sources, lambda s: ranks[s])))


def components(proteins: DataFrame, flags: DataFrame, best: DataFrame, annotation: DataFrame | None = None) -> DataFrame:
    """The nine components of every protein, each beside whether it was measured."""
    joined = proteins.join(flags, "feature_id", "left").join(best.select("feature_id", "hit_score", "distinct_entries", "ligands", "has_partner"), "feature_id", "left")
    if annotation is not None:
        joined = joined.join(annotation.select("feature_id", "membrane_value", "exposed"), "feature_id", "left")
    else:
        joined = joined.withColumns({"membrane_value": F.lit(None).cast("boolean"), "exposed": F.lit(None).cast("boolean")})
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    return joined.withColumns(
        {
            "pdb_evidence": F.round(F.coalesce("hit_score", F.lit(0.0)) / S.MAX_HIT_SCORE, 6),
            "virulence_amr": F.greatest(one(F.col("virulence")), F.coalesce("amr_value", F.lit(0.0))),
            "essential": one(F.col("essential")),
            "drug_target": one(F.col("drug_target")),
            "annotation_gap": one(S.matches(F.col("product"), S.UNCHARACTERISED)),
            "surface_bonus": one(F.col("exposed")),
            "ligandable_homolog": one((F.size("ligands") > 0) & ~F.coalesce("has_partner", F.lit(False))),
            "membrane_penalty": one(F.col("membrane_value")),
            "human_homolog_penalty": F.round(F.coalesce("human_identity_pct", F.lit(0.0)) / 100, 6),
            "distinct_entries": F.coalesce("distinct_entries", F.lit(0)),
            "surface_measured": F.col("exposed").isNotNull(), "membrane_measured": F.col("membrane_value").isNotNull(), "hits_measured": F.col("hit_score").isNotNull(),
        }
    )


def triage(scored: DataFrame, n: int, profile: Profile = PROFILES["bacterial-target"], run: list[str] | None = None) -> DataFrame:
    """Score, rank and select; ties go by evidence, support and id."""
    close = F.coalesce(F.col("human_identity_pct") >= CLOSE_HUMAN_IDENTITY, F.lit(False)) if profile.disqualify_human_homologs else F.lit(False)
    out = scored.withColumn("score", profile.score()).withColumn("disqualified", close)
    return rank_select(out, [F.desc("score"), F.desc("pdb_evidence"), F.desc("distinct_entries"), F.col("feature_id")], n, F.col("disqualified"), run)
