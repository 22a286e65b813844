"""Operators on small inputs with ties, nulls and failing gates."""

import pytest
from pyspark.sql import functions as F

from basalt.functions import scalar as S
from basalt.functions.sequence import membrane_spans, targeting
from basalt.operators import aggregates as A
from basalt.operators import best as B
from basalt.operators import keyed as K
from basalt.plans import triage as T


def test_best_modes_differ(spark):
    rows = spark.createDataFrame([("a", 9.0, False, 1), ("a", 5.0, True, 2), ("b", 1.0, True, 3), ("b", 1.0, True, 4)], "k string, v double, ok boolean, pos int")
    order = [F.desc("v"), F.col("pos")]
    gated = {r["k"]: r["pos"] for r in B.best_per_key(rows, ["k"], order, F.col("ok"), "gate_then_max").collect()}
    ranked = {r["k"]: (r["pos"], r["counted"]) for r in B.best_per_key(rows, ["k"], order, F.col("ok"), "max_then_gate").collect()}
    assert gated == {"a": 2, "b": 3}
    assert ranked == {"a": (1, False), "b": (3, True)}
    with pytest.raises(ValueError):
        B.best_per_key(rows, ["k"], order, F.col("ok"), "other")


def test_disqualified_keep_rank_and_pass_slot_on(spark):
    rows = spark.createDataFrame([(1, 9.0, True), (2, 8.0, False), (3, 8.0, None), (4, 1.0, False)], "id int, s double, dq boolean")
    out = {r["id"]: (r["rank"], r["selected"]) for r in B.rank_select(rows, [F.desc("s"), F.col("id")], 2, F.col("dq")).collect()}
    assert out == {1: (1, False), 2: (2, True), 3: (3, True), 4: (4, False)}


def test_keyed_merge_appends_replaces_and_refuses_unknown(spark):
    base = spark.createDataFrame([("a", "x", ["1"]), ("b", "y", None)], "k string, v string, notes array<string>")
    update = spark.createDataFrame([("a", None, ["2"]), ("b", "z", ["3"])], "k string, v string, notes array<string>")
    out = {r["k"]: (r["v"], r["notes"]) for r in K.keyed_merge(base, update, "k", ("notes",)).collect()}
    assert out == {"a": ("x", ["1", "2"]), "b": ("z", ["3"])}
    with pytest.raises(Exception, match="unknown key c"):
        K.keyed_merge(base, spark.createDataFrame([("c", "q", None)], update.schema), "k").collect()


def test_alias_join_takes_first_known_alias(spark):
    rows = spark.createDataFrame([(1, ["x", "y"]), (2, ["q"]), (3, None)], "id int, names array<string>")
    lookup = spark.createDataFrame([("y", 7), ("x", 8)], "name string, found int")
    out = {r["id"]: r["found"] for r in K.alias_join(rows, "names", lookup, "name", "id").collect()}
    assert out == {1: 8, 2: None, 3: None}


def test_dedup_apply_works_once_for_each_content(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, s string")
    done = K.dedup_apply(rows, F.sha2("s", 256), lambda d: d.select("content_key", F.length("s").alias("n")))
    assert sorted((r["id"], r["n"]) for r in done.collect()) == [(1, 1), (2, 1), (3, 1)]


def test_crc64_and_casts(spark):
    def plain(text):
        crc = 0
        for byte in text.strip().upper().encode():
            crc ^= byte
            for _ in range(8):
                crc = (crc >> 1) ^ (0xD800000000000000 if crc & 1 else 0)
        return f"{crc:016X}"

    words = ["MKV", "ARNDCQEGHILKMFPSTWYV" * 4, "", " acd "]
    rows = spark.createDataFrame([(w,) for w in words], "s string").select("s", S.crc64_hex(F.col("s")).alias("c")).collect()
    assert all(r["c"] == plain(r["s"]) for r in rows)
    casts = spark.sql("select '99' a, ' 3.5 ' b, 'x' c, '' d").select(S.as_int(F.col("a")), S.as_float(F.col("b")), S.as_int(F.col("c")), S.as_float(F.col("d"))).first()
    assert tuple(casts) == (99, 3.5, None, None)


def test_text_rules(spark):
    rows = spark.createDataFrame([("hypothetical protein",), ("DUF123 domain",), ("DNA gyrase",), ("",), (None,)], "p string")
    assert [r[0] for r in rows.select(S.matches(F.col("p"), S.UNCHARACTERISED)).collect()] == [True, True, False, False, False]
    places = spark.createDataFrame([("OuterMembrane",), ("Cytoplasmic Membrane",), ("Unknown",), (None,)], "p string")
    assert [r[0] for r in places.select(S.localisation(F.col("p"))).collect()] == ["outer membrane", "cytoplasmic membrane", "", ""]
    names = spark.createDataFrame([("mycoplasma", "mycoplasmoides", True), ("streptococcus", "streptomyces", False), ("", "a", False)], "a string, b string, same boolean")
    assert all(r["same"] == r["found"] for r in names.withColumn("found", S.same_genus(F.col("a"), F.col("b"))).collect())


def test_contacts_agree_with_all_pairs(spark):
    import random

    r = random.Random(3)
    points = [(i % 2, i, r.uniform(-5, 5), r.uniform(-5, 5), r.uniform(-5, 5)) for i in range(120)]
    df = spark.createDataFrame(points, "s int, id int, x double, y double, z double")
    found = {(x["id"], x["id_2"]) for x in A.contacts(df, df, "s", 1.7).where("id < id_2").collect()}
    want = {(a[1], b[1]) for a in points for b in points if a[0] == b[0] and a[1] < b[1] and sum((p - q) ** 2 for p, q in zip(a[2:], b[2:])) <= 1.7**2}
    assert found == want and want


def test_islands_and_upper_median(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, 1.0, 9.0, 1.0, 9.0, 9.0])], "k string, pos int, v double")
    runs = sorted((r["first"], r["last"], r["length"]) for r in A.islands(rows, ["k"], "pos", F.col("v") < 5, "v").collect())
    assert runs == [(0, 1, 2), (3, 3, 1)]
    assert A.upper_median(spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)], "k string, v double"), ["k"], "v").first()["median"] == 3.0


def test_specialty_flags_and_resistance_evidence(spark):
    rows = [
        ("p1", "Antibiotic Resistance", "antibiotic target in susceptible species", None), ("p2", "Antibiotic Resistance", "efflux pump conferring antibiotic resistance", None),
        ("p3", "Antibiotic Resistance", None, None), ("p4", "Virulance factor", None, None), ("p5", "Human Homolog", None, "52"), ("p5", "Human Homolog", None, "47"),
    ]
    out = {r["feature_id"]: r for r in T.specialty_flags(spark.createDataFrame(rows, "feature_id string, property string, classification string, identity string")).collect()}
    assert [out[f"p{i}"]["amr_value"] for i in (1, 2, 3)] == [0.0, 1.0, 0.5]
    assert out["p1"]["drug_target"] and not out["p2"]["drug_target"]
    assert out["p4"]["virulence"] and out["p5"]["human_identity_pct"] == 52.0


def test_triage_end_to_end(spark):
    proteins = spark.createDataFrame([("p1", "hypothetical protein"), ("p2", "kinase"), ("p3", "kinase")], "feature_id string, product string")
    specialty = spark.createDataFrame([("p2", "Essential Gene", None, None), ("p1", "Human Homolog", None, "60")], "feature_id string, property string, classification string, identity string")
    hits = spark.createDataFrame(
        [("p2", "1ABC", 0.9, 0.9, 1e-30, 200.0, "X-RAY DIFFRACTION", 2.0, True, False, True, ["LIG"], 1), ("p3", "2ABC", 1.0, 0.2, 1e-30, 300.0, "X-RAY DIFFRACTION", 2.0, True, False, True, ["LIG"], 2)],
        "feature_id string, entry_id string, identity double, query_coverage double, evalue double, bitscore double, method string, resolution double, has_ligand boolean, has_partner boolean, has_annotation boolean, ligands array<string>, pos int",
    )
    best = T.best_hits(T.scored_hits(hits))
    assert [r["feature_id"] for r in best.collect()] == ["p2"]
    parts = T.components(proteins, T.specialty_flags(specialty), best)
    out = {r["feature_id"]: r for r in T.triage(parts, 2).collect()}
    assert out["p2"]["rank"] == 1 and out["p2"]["selected"] and out["p2"]["score"] == pytest.approx(0.4 * round(0.96 / 1.2, 6) + 0.15 + 0.1, abs=1e-6)
    assert out["p1"]["disqualified"] and not out["p1"]["selected"] and out["p3"]["selected"]
    assert not out["p3"]["hits_measured"] and not out["p3"]["membrane_measured"]
    free = {r["feature_id"]: r["score"] for r in T.triage(parts, 2, T.PROFILES["evidence-only"]).collect()}
    assert free["p1"] == 0.0
    with pytest.raises(ValueError):
        T.Profile("odd", {"pdb_evidence": 1.0})


def test_calls_keep_unknown_apart_from_false(spark):
    calls = spark.createDataFrame(
        [("a", "membrane", True, "heuristic", 1), ("a", "membrane", False, "deeptmhmm", 2), ("a", "surface", None, "psortb", 3), ("b", "secreted", True, "psortb", 4)],
        "feature_id string, flag string, value boolean, source string, pos int",
    )
    out = {r["feature_id"]: r for r in T.merge_calls(calls).collect()}
    assert out["a"]["membrane_value"] is False and out["a"]["membrane_source"] == "deeptmhmm" and out["a"]["exposed"] is None
    assert out["b"]["exposed"] is True and out["b"]["membrane_value"] is None


def test_membrane_spans_and_signal(spark):
    kd = "DEKR" * 5 + "LIVFLIVFLIVALIVFLIVFLIVFLLIV" + "DEKR" * 5
    signal = "MKKLLLLLLLLLLLLAAASAQADEKRNQDEKRNQDEKRNQDEKRNQ"
    df = spark.createDataFrame([(kd,), (signal,), ("",), ("MDE",)], "sequence string")
    spans = [r["spans"] for r in membrane_spans(df).collect()]
    assert len(spans[0]) == 1 and 20 <= spans[0][0]["start"] < spans[0][0]["end"] <= 48 and spans[2] == [] and spans[3] == []
    calls = [r["t"] for r in df.select(targeting(F.col("sequence")).alias("t")).collect()]
    assert calls[1]["signal"] and 14 <= calls[1]["cleavage"] <= 45 and not calls[2]["signal"]
