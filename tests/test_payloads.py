"""Cached replies and structure decisions."""

import json

import pytest
from pyspark.sql import functions as F

from basalt.plans import structures as X
from basalt.sources import payloads as P


def cache(spark, **replies):
    return spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in replies.items()], "cache_key string, payload_json string")


def test_structure_search_keeps_best_context(spark):
    context = lambda score, end: {"sequence_identity": 0.5, "evalue": 1e-9, "bitscore": score, "query_beg": 1, "query_end": end, "query_length": 100}
    reply = {"result_set": [{"identifier": "1ABC_1", "services": [{"nodes": [{"match_context": [context(10, 20), context(30, 80), context(30, 90)]}]}]}]}
    out = {r["cache_key"]: r for r in P.structure_search(cache(spark, a=reply, b={"result_set": []}, c="not json")).collect()}
    assert (out["a"]["entry_id"], out["a"]["bitscore"], out["a"]["query_coverage"]) == ("1ABC", 30.0, 0.8)
    assert (out["b"]["status"], out["c"]["status"]) == ("no-hit", "query-failed")


def test_models_and_their_gate(spark):
    model = {"entryId": "AF-1", "globalMetricValue": 88.5, "uniprotStart": 1, "uniprotEnd": 5, "uniprotSequence": "M" * 10}
    replies = cache(spark, a=[model | {"globalMetricValue": 40}, model], b={"_http_status": 404}, c={"_http_status": 400}, d={"_http_status": 503}, e=[])
    models = P.predicted_models(replies)
    out = {r["cache_key"]: r for r in models.collect()}
    assert [out[k]["status"] for k in "abcde"] == ["found", "no-model", "invalid", "failed", "no-model"]
    assert out["a"]["mean_plddt"] == 88.5 and out["a"]["coverage"] == 0.5
    strict = {r["cache_key"]: (r["usable"], r["reason"]) for r in X.usable(models).collect()}
    loose = {r["cache_key"]: r["usable"] for r in X.usable(models, 50.0, None).collect()}
    assert strict["a"] == (False, "covers too little") and loose["a"] and not loose["b"]


def test_fold_search_passes_unknown_coverage(spark):
    row = lambda t, e, **more: {"target": t, "eval": e} | more
    reply = {"results": [{"db": "pdb", "alignments": [[row("x", 1e-9, qLen=100, qStartPos=1, qEndPos=20), row("y", 1e-9), row("z", 1.0)]]}]}
    assert [r["target"] for r in P.fold_search(cache(spark, a=reply)).collect()] == ["y"]


def test_entries(spark):
    entry = {
        "primaryAccession": "P1", "genes": [{"geneName": {"value": "gyrA"}}], "organism": {"taxonId": 9},
        "proteinDescription": {"recommendedName": {"fullName": {"value": "Gyrase"}, "ecNumbers": [{"value": "5.6.2.2"}]}},
        "uniProtKBCrossReferences": [{"database": "PDB", "id": "1A"}, {"database": "PDB", "id": "1A"}, {"database": "GO", "id": "GO:1", "properties": [{"key": "GoTerm", "value": "F:x"}]}],
        "comments": [{"commentType": "SUBCELLULAR LOCATION", "subcellularLocations": [{"location": {"value": "Cytoplasm", "evidences": [{"evidenceCode": "ECO:0000269"}]}}, {"location": {"value": "Membrane"}}]}],
    }
    table = cache(spark, a=entry, b={"_http_status": 404})
    one = P.entries(table).collect()
    assert len(one) == 1 and (one[0]["accession"], one[0]["gene"], one[0]["taxon_id"], one[0]["pdb"], one[0]["refseq"]) == ("P1", "gyrA", 9, ["1A"], [])
    assert sorted((r["kind"], r["id"], r["name"]) for r in P.entry_terms(table).collect()) == [("ec", "5.6.2.2", None), ("go", "GO:1", "F:x")]
    assert {r["location"]: r["source"] for r in P.entry_locations(table).collect()} == {"Cytoplasm": "uniprot_experimental", "Membrane": "uniprot"}


def test_components_choice_and_gate(spark):
    ligands, metals = P.classify_components(F.col("c"))
    row = spark.createDataFrame([(["fad", "HOH", "ZN", "NAG", " g3p ", "ZN", None],)], "c array<string>").select(ligands, metals).first()
    assert tuple(row) == (["FAD", "G3P"], ["ZN"])
    proteins = [("a", "1A", "2B", None, None, None), ("b", "1A", "1A", None, None, None), ("c", None, None, "AF", None, None), ("d", None, None, None, ["9Z"], "AF"), ("e", None, "2B", None, None, None)]
    df = spark.createDataFrame(proteins, "feature_id string, best_entity string, holo_entity string, model_id string, pdb_refs array<string>, model_ref string")
    out = {r["feature_id"]: r for r in X.choose(df).collect()}
    assert out["a"]["choice"]["accession"] == "2B" and out["a"]["swapped"] and not out["b"]["swapped"]
    assert out["c"]["choice"]["source"] == "afdb" and out["d"]["choice"]["accession"] == "9Z" and out["e"]["status"] == "prediction_required"
    rows = [("pdb", "NMR", 0.3, 0.6, None, None), ("pdb", "X-RAY", 0.3, 0.6, 4.0, None), ("afdb", None, None, 0.9, None, 75.0), ("afdb", None, None, None, None, 75.0)]
    gated = X.gate(spark.createDataFrame(rows, "source string, method string, identity double, coverage double, resolution double, mean_plddt double")).collect()
    assert [r["passed"] for r in gated] == [True, False, True, False] and "resolution" in gated[1]["reasons"]


def test_pockets(spark):
    atoms = [("s", "ATOM", "ASP", "A", 10, 0.0, 0.0, 0.0, 80.0), ("s", "ATOM", "ASP", "A", 10, 1.0, 0.0, 0.0, 80.0), ("s", "ATOM", "HIS", "A", 11, 9.0, 0.0, 0.0, 80.0), ("s", "HETATM", "LIG", "B", 1, 3.0, 0.0, 0.0, 1.0), ("s", "HETATM", "HOH", "B", 2, 9.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(atoms, "structure string, group_PDB string, component string, chain string, seq_id int, x double, y double, z double, b double")
    (row,) = X.pockets(df).collect()
    assert row["ligand"] == "LIG" and row["n_residues"] == 1 and row["residues"][0]["distance"] == pytest.approx(2.0) and row["x"] == 1.0
