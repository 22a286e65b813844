"""A finished run ranked again under another policy, from its recorded components alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.functions.scalar import as_float, fixed
from basalt.operators.best import rank_select
from basalt.plans.triage import CLOSE_HUMAN_IDENTITY, WEIGHTS, Profile

KEPT = ("feature_id", "product", "score", "original_rank", "original_score", "selected", "disqualified", "original_selected")


def rescore(recorded: DataFrame, profile: Profile, n: int = 50) -> DataFrame:
    """``recorded`` (feature_id, product, rank, score, selected, human_identity_pct,
    distinct_entries and the components) ranked under ``profile``; nothing is asked or measured
    again, ties and the bar on human homologs are those of the first ranking.

    Components may be text; blank and unreadable ones count zero. ``disqualified`` says why or is
    empty. A run that recorded fewer components is refused before any work, by name."""
    missing = sorted(set(WEIGHTS) - set(recorded.columns))
    if missing:
        raise ValueError(f"the run recorded no {', '.join(missing)} and cannot be scored again")
    zero = lambda c: F.coalesce(as_float(F.col(c)), F.lit(0.0))
    pct = as_float(F.col("human_identity_pct"))
    barred = (pct >= CLOSE_HUMAN_IDENTITY) if profile.disqualify_human_homologs else F.lit(False)
    why = F.when(barred, F.concat(F.lit("human homolog "), fixed(pct, 1), F.lit("% identity"))).otherwise("")
    read = recorded.select(
        "feature_id", "product", F.col("rank").alias("original_rank"), F.col("score").alias("original_score"), F.lower(F.col("selected").cast("string")).eqNullSafe("true").alias("original_selected"),
        why.alias("disqualified"), zero("distinct_entries").alias("_entries"), *(zero(c).alias(c) for c in WEIGHTS),
    ).withColumn("score", profile.score())
    ranked = rank_select(read, [F.desc("score"), F.desc("pdb_evidence"), F.desc("_entries"), F.col("feature_id")], n, F.col("disqualified") != "")
    return ranked.select("rank", *KEPT, *WEIGHTS)


def manifest(rescored: DataFrame, profile: Profile, n: int = 50) -> DataFrame:
    """Rows (name, value) of a rescore: the policy with its weights, and how its selection compares
    with the run's own. One pass over the rows."""
    now, then = F.col("selected"), F.col("original_selected")
    moved = F.abs(F.col("rank") - as_float(F.col("original_rank")))
    counts = {
        "proteins": F.count("*"), "selected": F.count_if(now), "selected_before": F.count_if(then), "overlap": F.count_if(now & then), "entered": F.count_if(now & ~then),
        "left": F.count_if(then & ~now), "disqualified": F.count_if(F.col("disqualified") != ""), "moved": F.count_if(moved > 0), "furthest": F.coalesce(F.max(moved), F.lit(0)),
    }
    row = rescored.agg(*(c.cast("double").alias(k) for k, c in counts.items()))
    flat = row.select(F.explode(F.create_map(*(x for k in counts for x in (F.lit(k), F.col(k))))).alias("name", "value"))
    policy = [("top_n", float(n)), ("disqualify_human_homologs", float(profile.disqualify_human_homologs)), *((f"weight:{k}", float(w)) for k, w in profile.weights.items())]
    return flat.unionByName(rescored.sparkSession.createDataFrame(policy, "name string, value double"))


def write_rescored(rescored: DataFrame, root: str, profile: Profile, n: int = 50) -> None:
    """The ranking and its manifest under ``rescored/<profile>``; the run's own files stay."""
    path = f"{root}/rescored/{profile.name}"
    rescored.write.mode("overwrite").csv(f"{path}/ranking", sep="\t", header=True, emptyValue="")
    manifest(rescored, profile, n).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
