"""The graph of proteins, partners, homologs, targets and compounds."""

import json

import pytest

from basalt.plans import graph as G

PROTEIN = "feature_id string, locus_tag string, product string, human_identity double, pos long"
HOMOLOG = "feature_id string, accession string, identity double, coverage double, organism string, via string, name string, pos long"


def cache(spark, **replies):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in replies.items()], "cache_key string, payload_json string")


def built(spark, proteins, homologs=(), partners=None, targets=None, activities=None, caps=G.Caps()):
    tables = G.build(spark.createDataFrame(proteins, PROTEIN), spark.createDataFrame(list(homologs), HOMOLOG), cache(spark, **(partners or {})), cache(spark, **(targets or {})), cache(spark, **(activities or {})), caps)
    nodes, edges, failures = (t.collect() for t in tables)
    assert not G.dangling(*tables[:2]).count()
    return {r["id"]: r for r in nodes}, edges, sorted((r["source"], r["step"], r["key"], r["error"]) for r in failures)


def test_partners_are_capped_and_named(spark):
    reply = [{"stringId_B": f"1.b{i}", "preferredName_B": f"n{i}", "score": 0.9, "escore": 0.1} for i in range(5)]
    reply[1] = {"stringId_B": "1.b1", "score": 0.8}
    reply[2] = {"score": 0.7}
    nodes, edges, failures = built(spark, [("f1", "L1", "", None, 0), ("f2", "", "p", None, 1), (None, "L3", "p", None, 2)], partners={"L1": reply}, caps=G.Caps(partners=4))
    assert [(e["source_id"], e["target_id"]) for e in edges] == [("brc:f1", "string:1.b0"), ("brc:f1", "string:1.b1"), ("brc:f1", "string:1.b3")]
    assert nodes["string:1.b1"]["name"] == "1.b1" and nodes["brc:f1"]["name"] == "L1" and nodes["brc:f2"]["name"] == "p"
    assert json.loads(edges[0]["evidence"])["combined_score"] == 0.9 and "note" in json.loads(edges[0]["evidence"])
    assert failures == [] and set(nodes) == {"brc:f1", "brc:f2", "string:1.b0", "string:1.b1", "string:1.b3"}


def test_homologs_carry_identity_and_humans_no_accession(spark):
    nodes, edges, _ = built(spark, [("f1", None, "-DNA Gyrase, A-", 41.5, 0), ("f2", None, " ", 30.0, 1), ("f3", None, "x", 0.0, 2)], [("f1", "P1", 0.5, 0.9, "E. coli", "hits", "gyrA", 0), ("f1", "", 0.5, 0.9, "", "", "", 1), ("zz", "P9", 0.5, 0.9, "", "", "", 2)])
    assert sorted((e["source_id"], e["target_id"], json.loads(e["evidence"])["percent_identity"]) for e in edges) == [("brc:f1", "human:dna-gyrase-a", 41.5), ("brc:f1", "uniprot:P1", 0.5), ("brc:f2", "human:f2", 30.0)]
    assert (nodes["uniprot:P1"]["name"], nodes["uniprot:P1"]["organism"], nodes["human:dna-gyrase-a"]["organism"]) == ("gyrA", "E. coli", "Homo sapiens")


def test_compounds_hang_on_the_homolog(spark):
    target = lambda i, *components: {"target_chembl_id": i, "pref_name": f"name {i}", "organism": "E. coli", "target_components": [{"accession": c} for c in components]}
    targets = {"P1": {"targets": [target("T1", "P1", "P7"), target("T2", "P8"), target("T3"), target("")]}, "P2": {"_http_status": 503}}
    activities = {"T1": {"activities": [{"molecule_chembl_id": "M1", "pchembl_value": "7.1"}, {"molecule_chembl_id": None}, {"molecule_chembl_id": "M2"}]}}
    homologs = [("f1", "P1", 0.5, None, None, None, None, 0), ("f2", "P1", 0.4, None, None, None, "late", 0), ("f2", "P2", 0.4, None, None, None, None, 1)]
    nodes, edges, failures = built(spark, [("f1", None, "a", None, 0), ("f2", None, "b", None, 1)], homologs, targets=targets, activities=activities, caps=G.Caps(compounds=2))
    kinds = sorted((e["type"], e["source_id"], e["target_id"]) for e in edges)
    assert kinds == [("homolog_of", "brc:f1", "uniprot:P1"), ("homolog_of", "brc:f2", "uniprot:P1"), ("homolog_of", "brc:f2", "uniprot:P2"), ("represented_by", "uniprot:P1", "chembl:T1"), ("represented_by", "uniprot:P1", "chembl:T3"), ("target_of", "compound:M1", "chembl:T1")]
    assert failures == [("ChEMBL", "activity", "T3", "no reply is kept"), ("ChEMBL", "target", "P1", "T2 does not list P1 as a component; the filter did not apply"), ("ChEMBL", "target", "P2", "HTTP 503")]
    assert nodes["uniprot:P1"]["name"] == "late" and nodes["chembl:T1"]["type"] == "chembl_target"


@pytest.mark.parametrize("caps", [G.Caps(), G.Caps(1, 1, 1)])
def test_summary_counts_and_names_its_caps(spark, caps):
    nodes, edges, failures = G.build(spark.createDataFrame([("f1", "L1", "a", 50.0, 0)], PROTEIN), spark.createDataFrame([], HOMOLOG), cache(spark, L1={"_http_status": 404}), *[spark.createDataFrame([], "cache_key string, payload_json string")] * 2, caps)
    assert sorted(map(tuple, G.summary(nodes, edges, caps).collect())) == [("cap", "compounds", caps.compounds), ("cap", "partners", caps.partners), ("cap", "targets", caps.targets), ("edge", "homolog_of", 1), ("node", "protein", 2)]
    assert [(r["key"], r["error"]) for r in failures.collect()] == [("f1", "HTTP 404")]
