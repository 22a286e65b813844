"""Recorded runs under other policies."""

import json

import pytest
from pyspark.sql import functions as F

from basalt.plans import rescoring as R
from basalt.plans import triage as T

DEFAULT, EVIDENCE = T.PROFILES["bacterial-target"], T.PROFILES["evidence-only"]


def run(spark):
    rows = [(f"p{i}", "x", *((i * 7 + k) % 5 / 4 for k in range(len(T.WEIGHTS))), float(i % 3), 55.0 if i % 4 == 0 else None) for i in range(30)]
    parts = spark.createDataFrame(rows, ", ".join(["feature_id string", "product string", *(f"{c} double" for c in T.WEIGHTS), "distinct_entries double", "human_identity_pct double"]))
    return T.triage(parts, 8)


def test_the_runs_own_policy_gives_its_own_ranking(spark):
    first = run(spark)
    got = {r["feature_id"]: (r["rank"], r["score"], r["selected"]) for r in R.rescore(first, DEFAULT, 8).collect()}
    assert got == {r["feature_id"]: (r["rank"], r["score"], r["selected"]) for r in first.collect()}
    told = {r["name"]: r["value"] for r in R.manifest(R.rescore(first, DEFAULT, 8), DEFAULT, 8).collect()}
    assert (told["overlap"], told["entered"], told["left"], told["moved"], told["weight:essential"]) == (8, 0, 0, 0, 0.15)


def test_evidence_only_bars_nobody(spark):
    first = run(spark)
    assert {r["disqualified"] for r in R.rescore(first, EVIDENCE, 8).collect()} == {""}
    assert {r["disqualified"] for r in R.rescore(first, DEFAULT, 8).collect()} == {"", "human homolog 55.0% identity"}


def test_text_is_read_and_gaps_count_zero(spark):
    text = run(spark).select(*(F.col(c).cast("string").alias(c) for c in ("feature_id", "product", "rank", "score", "selected", "human_identity_pct", "distinct_entries", *T.WEIGHTS)))
    odd = text.withColumn("essential", F.when(F.col("feature_id") == "p1", "n/a").otherwise(F.col("essential"))).withColumn("drug_target", F.when(F.col("feature_id") == "p2", " ").otherwise(F.col("drug_target")))
    got = {r["feature_id"]: r for r in R.rescore(odd, DEFAULT, 8).collect()}
    assert got["p1"]["essential"] == 0.0 and got["p2"]["drug_target"] == 0.0 and got["p1"]["original_rank"] is not None
    assert sum(r["original_selected"] for r in got.values()) == 8


def test_runs_without_components_are_refused(spark):
    with pytest.raises(ValueError, match="essential"):
        R.rescore(run(spark).drop("essential"), DEFAULT)


def test_the_runs_own_files_stay(spark, tmp_path):
    run(spark).select("feature_id", "rank").write.parquet(str(tmp_path / "proteins"))
    before = sorted((p.name, p.stat().st_size) for p in (tmp_path / "proteins").iterdir())
    R.write_rescored(R.rescore(run(spark), EVIDENCE, 8), str(tmp_path), EVIDENCE, 8)
    assert sorted((p.name, p.stat().st_size) for p in (tmp_path / "proteins").iterdir()) == before
    ranking = spark.read.csv(str(tmp_path / "rescored/evidence-only/ranking"), sep="\t", header=True)
    assert ranking.count() == 30 and [json.loads(v[0])["value"] for v in spark.read.text(str(tmp_path / "rescored/evidence-only/manifest")).collect() if '"top_n"' in v[0]] == [8.0]
