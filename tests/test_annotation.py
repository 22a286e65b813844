"""Provider outputs, their merge and the graph that proteins, partners and compounds form."""

import json
import random

import pytest

from basalt.functions.sequence import hydrophobic_spans
from basalt.plans import annotation as A
from basalt.sources import providers as P

CALLS = "feature_id string, flag string, value string, source string, evidence string, pos int, first_span int"


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def said(calls):
    return {(r["feature_id"], r["flag"]): r["value"] for r in calls.collect()}


def merged(spark, rows, ids=("p",)):
    calls = spark.createDataFrame([(*r, *(None,) * (7 - len(r))) for r in rows], CALLS)
    out = A.merge(spark.createDataFrame([(i,) for i in ids], "feature_id string"), calls).collect()
    return {r["feature_id"]: r for r in out}


def test_eggnog_goes_by_each_files_header(spark, tmp_path):
    (tmp_path / "e").mkdir()
    write(tmp_path, "e/new.tsv", "## made\n#query\tGOs\tDescription\tPreferred_name\tCOG_category\teggNOG_OGs\tKEGG_ko\np1\tGO:1,GO:2\tgyrase\tgyrA\tLK\tCOG0188@1|root,1MUG@1\tko:K02469\np2\t-\t-\t-\t-\t-\t-\n")
    write(tmp_path, "e/old.tsv", "p3\ts.1\t1e-9\t50\tCOG1@1|x\t-\tS\tname\tabc\tGO:7" + "\t-" * 11 + "\n")
    calls, terms = P.eggnog(spark, str(tmp_path / "e"))
    assert said(calls) == {("p1", "description"): "gyrase", ("p3", "description"): "name"}
    assert {(r["feature_id"], r["kind"], r["id"]) for r in terms.collect()} == {
        ("p1", "go", "GO:1"), ("p1", "go", "GO:2"), ("p1", "gene_name", "gyrA"), ("p1", "cog_category", "L"), ("p1", "cog_category", "K"), ("p1", "cog", "COG0188"), ("p1", "ko", "K02469"),
        ("p3", "go", "GO:7"), ("p3", "cog_category", "S"), ("p3", "gene_name", "abc"), ("p3", "cog", "COG1"),
    }
    assert {r["evidence"] for r in calls.collect()} == {"eggNOG", "eggNOG seed ortholog s.1"}


def test_psortb_terse_and_long(spark, tmp_path):
    terse = P.psortb(spark, write(tmp_path, "t.txt", "SeqID\tLocalization\tScore\np1\tOuterMembrane\t9.5\np2\tUnknown\t2.0\np3\tCytoplasmic\n"))
    assert said(terse) == {("p1", "localization"): "outer membrane", ("p3", "localization"): "cytoplasm"}
    one = "SeqID: {} some words\n  Analysis Report:\n    CMSVM-  Unknown  [No details]\n  Final Prediction:\n    {}\n\n" + "-" * 79 + "\n\n"
    long = P.psortb(spark, write(tmp_path, "l.txt", one.format("p1", "Extracellular   9.72") + one.format("p2", "Unknown 2.0") + one.format("p3", "CytoplasmicMembrane     10.00")))
    assert said(long) == {("p1", "localization"): "extracellular", ("p3", "localization"): "cytoplasmic membrane"}
    assert {r["evidence"] for r in long.collect()} == {"PSORTb Extracellular (score 9.72)", "PSORTb CytoplasmicMembrane (score 10.00)"}


def test_signalp_tells_anchors_apart(spark, tmp_path):
    path = write(tmp_path, "s.txt", "# SignalP-6.0\np1\tSP\t0.1\tCS pos: 21-22. Pr: 0.9\np2\tOTHER\t1\np3 LIPO 0.9\n")
    assert said(P.signalp(spark, path)) == {
        ("p1", "signal_peptide"): "true", ("p1", "lipoprotein"): "false", ("p2", "signal_peptide"): "false", ("p2", "lipoprotein"): "false", ("p3", "signal_peptide"): "true", ("p3", "lipoprotein"): "true",
    }


def test_interpro_rows_are_absorbed(spark, tmp_path):
    row = lambda *f: "\t".join(("p1", "md5", "300", *f)) + "\n"
    text = (
        row("Phobius", "TRANSMEMBRANE", "Region of a membrane-bound protein", "5", "25", "-", "T", "d", "-", "-")
        + row("Phobius", "CYTOPLASMIC_DOMAIN", "inside", "26", "90", "-", "T", "d", "-", "-")
        + row("Phobius", "SIGNAL_PEPTIDE", "signal", "1", "20", "-", "T", "d", "-", "-")
        + row("TMHMM", "TMhelix", "helix", "5", "25", "-", "T", "d")
        + row("Pfam", "PF1", "dom", "1", "9", "1e-5", "T", "d", "IPR1", "Domain one", "GO:0001(InterPro)|GO:0002")
        + row("SMART", "SM1", "dom", "1", "9", "1e-5", "T", "d", "IPR2", "Domain two", "-")
    )
    calls, terms = P.interproscan(spark, write(tmp_path, "i.tsv", text))
    assert said(calls) == {("p1", "tm_helices"): "2", ("p1", "signal_peptide"): "true", ("p1", "description"): "Domain one"}
    assert {(r["kind"], r["id"]) for r in terms.collect()} == {("pfam", "PF1"), ("signature", "SM1"), ("interpro", "IPR1"), ("interpro", "IPR2"), ("go", "GO:0001"), ("go", "GO:0002")}


@pytest.mark.parametrize("wrapped", [True, False])
def test_interpro_json(spark, tmp_path, wrapped):
    match = lambda library, accession, entry=None, locations=1: {"signature": {"accession": accession, "description": "d", "signatureLibraryRelease": {"library": library}, "entry": entry}, "locations": [{"start": 1}] * locations}
    entries = [
        {"xref": [{"id": ""}, {"id": "p1"}], "matches": [match("TMHMM", "TMhelix", None, 3), match("PFAM", "PF1", {"accession": "IPR1", "description": "one", "goXRefs": [{"id": "GO:0005"}]}), {"signature": None}]},
        {"xref": [], "matches": [match("PFAM", "PF2")]},
    ]
    calls, terms = P.interproscan(spark, write(tmp_path, "i.json", json.dumps({"results": entries} if wrapped else entries)))
    assert said(calls) == {("p1", "tm_helices"): "3", ("p1", "description"): "one"}
    assert {(r["kind"], r["id"]) for r in terms.collect()} == {("pfam", "PF1"), ("interpro", "IPR1"), ("go", "GO:0005")}


def test_heuristic_gives_the_first_span_to_its_signal(spark):
    helix, loop = "LIVALLAVILGAVLLIALLVA", "DEKRSNDEKRSNDEKRSNDEKRSNQ"
    secreted = "MKKTLLLALALLLALLPASASA" + loop
    rows = [("two", "M" + loop + helix + loop * 2 + helix + loop), ("out", secreted + loop), ("none", ""), ("null", None)]
    calls = P.heuristic(spark.createDataFrame(rows, "feature_id string, sequence string"))
    got = said(calls)
    assert got["two", "tm_helices"] == str(len(hydrophobic_spans(rows[0][1]))) and got["two", "signal_peptide"] == "false"
    assert got["out", "signal_peptide"] == "true" and got["out", "tm_helices"] == "0"
    assert {k[0] for k in got} == {"two", "out"}


def test_merge_ranks_sources_and_keeps_silence_apart(spark):
    out = merged(spark, [("p", "tm_helices", "0", "heuristic", "h", 0), ("p", "tm_helices", "2", "deeptmhmm", "d", 1), ("p", "signal_peptide", None, "signalp", "s", 2), ("q", "localization", "outer membrane", "psortb", "o", 3)], "pqr")
    assert (out["p"]["membrane"], out["p"]["tm_helices"], out["p"]["membrane_source"], out["p"]["signal_peptide"], out["p"]["secreted"]) == (True, 2, "deeptmhmm", None, None)
    assert (out["p"]["membrane_confidence"], out["p"]["lipoprotein_confidence"], out["p"]["secreted_confidence"], out["p"]["confidence"]) == ("predicted", "uncovered", "predicted", "predicted")
    assert (out["q"]["membrane"], out["q"]["membrane_source"], out["q"]["surface_exposed"], out["q"]["secreted"]) == (True, "psortb", True, False)
    assert (out["r"]["membrane"], out["r"]["localization"], out["r"]["confidence"], out["r"]["surface_exposed_sources"]) == (None, "unknown", None, "none")


def test_merge_reassigns_the_n_terminal_segment(spark):
    tm = lambda span: ("p", "tm_helices", "1", "heuristic", "one span", 0, span)
    signal = lambda source, value="true": ("p", "signal_peptide", value, source, "cut", 1)
    out = merged(spark, [tm(8), signal("signalp")])["p"]
    assert (out["tm_helices"], out["membrane"], out["secreted"], out["membrane_evidence"]) == (0, False, True, "one span; N-terminal segment reassigned to the signal peptide called by signalp")
    assert (out["secreted_sources"], out["secreted_confidence"], out["signal_peptide_confidence"]) == ("heuristic+signalp", "heuristic", "predicted")
    for rows in ([tm(60), signal("signalp")], [tm(8), signal("heuristic")], [tm(8), signal("signalp", "false")], [tm(None), signal("signalp")]):
        assert merged(spark, rows)["p"]["tm_helices"] == 1
    anchored = merged(spark, [signal("signalp"), ("p", "lipoprotein", "true", "signalp", "cut", 2)])["p"]
    assert (anchored["secreted"], anchored["surface_exposed"]) == (False, True)


def test_names_have_ranks_of_their_own_and_ties_go_by_place(spark):
    out = merged(spark, [("p", "description", "domain", "interproscan", "i", 0), ("p", "description", "ortholog", "eggnog", "e", 1), ("q", "description", "b", "eggnog", "e", 5), ("q", "description", "a", "eggnog", "e", 6)], "pq")
    assert (out["p"]["description"], out["q"]["description"]) == ("ortholog", "b")


def test_merge_equals_a_plain_one(spark):
    rng = random.Random(5)
    sources, rows = list(A.CONFIDENCE), []
    for i in range(400):
        flag = rng.choice(A.ASKED[:4])
        value = {"tm_helices": str(rng.randrange(3)), "localization": rng.choice(["cytoplasm", "outer membrane", "extracellular"])}.get(flag, rng.choice(["true", "false"]))
        rows.append((f"p{rng.randrange(40)}", flag, rng.choice([value, value, None]), rng.choice(sources), "e", i, rng.choice([None, 5, 50])))
    ids = [f"p{i}" for i in range(41)]
    out = merged(spark, rows, ids)
    for i in ids:
        best = {}
        for r in sorted((r for r in rows if r[0] == i and r[2] is not None), key=lambda r: (-A.SOURCE_RANK[r[3]], r[5])):
            best.setdefault(r[1], r)
        tm, signal, place, anchor = (best.get(f) for f in ("tm_helices", "signal_peptide", "localization", "lipoprotein"))
        n, cut = int(tm[2]) if tm else 0, bool(signal) and signal[2] == "true"
        if tm and n and tm[3] == "heuristic" and (tm[6] or 99) <= 45 and cut and A.SOURCE_RANK[signal[3]] > 10:
            n -= 1
        where, tied = place[2] if place else "unknown", bool(anchor) and anchor[2] == "true"
        gone = where == "extracellular" or (cut and n == 0 and not tied)
        looked = signal or place
        assert out[i]["tm_helices"] == (n if out[i]["membrane_source"] else None)
        assert out[i]["secreted"] == (gone if looked else None)
        assert out[i]["surface_exposed"] == ((gone or tied or where in A.SURFACE_PLACES) if looked else None)
        assert out[i]["membrane_source"] == (place[3] if where == "outer membrane" and n == 0 else tm[3] if tm else None)


def test_aliases_terms_and_report(spark):
    calls = spark.createDataFrame([("LOCUS_1", "tm_helices", "1", "deeptmhmm", "a", 0, None), ("p", "tm_helices", "3", "psortb", "b", 0, None), ("LOCUS_1", "tm_helices", "2", "psortb", "c", 0, None), ("zz", "tm_helices", "9", "signalp", "d", 0, None)], CALLS)
    names = spark.createDataFrame([("p", "p", 0), ("p", "LOCUS_1", 1)], "feature_id string, name string, pos int")
    own, unmatched = A.by_alias(calls, names)
    assert sorted((r["feature_id"], r["source"], r["value"]) for r in own.collect()) == [("p", "deeptmhmm", "1"), ("p", "psortb", "3")]
    assert sorted(map(tuple, unmatched.collect())) == [("psortb", "LOCUS_1"), ("signalp", "zz")]
    terms = spark.createDataFrame([("p", "go", "GO:1", "", "eggnog", "", 1), ("p", "go", "GO:1", "named", "eggnog", "x", 0), ("p", "go", "GO:1", "", "uniprot", "", 2)], "feature_id string, kind string, id string, name string, source string, evidence string, pos int")
    assert sorted((r["source"], r["name"], r["confidence"]) for r in A.distinct_terms(terms).collect()) == [("eggnog", "named", "inferred"), ("uniprot", "", "inferred")]
    counts = {(r["measure"], r["value"]): r["n"] for r in A.report(A.merge(spark.createDataFrame([("p",), ("q",)], "feature_id string"), own)).collect()}
    assert counts["membrane", "true"] == 1 and counts["membrane_source", "none"] == 1 and counts["lipoprotein_confidence", "uncovered"] == 2


def test_providers_in_one_table(spark, tmp_path):
    calls, _ = P.interproscan(spark, write(tmp_path, "i.tsv", "p1\tm\t9\tTMHMM\tTMhelix\tx\t1\t2\t-\tT\td\n"))
    signals = P.signalp(spark, write(tmp_path, "s.txt", "p1\tSP\t0.9\n"))
    own = P.heuristic(spark.createDataFrame([("p1", "MKKTLLLALALLLALLPASASADEKRSNDEKRSNDEKRSN")], "feature_id string, sequence string"))
    both = P.renumbered(signals, calls, own.drop("first_span"))
    out = A.merge(spark.createDataFrame([("p1",)], "feature_id string"), both).first()
    assert (out["tm_helices"], out["membrane_source"], out["signal_peptide_source"], out["secreted"]) == (1, "interproscan", "signalp", False)
