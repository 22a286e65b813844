"""Binding sites: our entity's chains, ranks, cofactors, confidence and reasons."""

import pytest
from pyspark.sql import functions as F

from basalt.plans import sites as Y
from basalt.sources.structures import atoms as read_atoms
from basalt.sources.structures import entity_chains

ATOMS = "structure string, pos long, group_PDB string, component string, chain string, seq_id int, auth_seq_id string, auth_chain string, x double, y double, z double, b double"
CASE = [
    ("ATOM", "ASP", "A", 1, 0.0, 0.0, 0.0), ("ATOM", "HIS", "A", 2, 3.0, 0.0, 0.0), ("ATOM", "THR", "A", 3, 0.0, 3.0, 0.0), ("ATOM", "LEU", "A", 4, 40.0, 0.0, 0.0), ("ATOM", "GLU", "B", 1, 2.0, 2.0, 0.0),
    ("HETATM", "MG", "D", 101, 1.0, 1.0, 0.0),
]


def run(spark, rows, ligands=(), metals=("MG",), template="1ABC_1", accession="1abc_1", source="pdb", chains=(("1", "A"), ("2", "B")), b=90.0):
    made = [("s", k, g, c, ch, s if g == "ATOM" else None, str(s), None, x, y, z, b) for k, (g, c, ch, s, x, y, z) in enumerate(rows)]
    templates = spark.createDataFrame([("s", accession, source, template, list(ligands), list(metals))], Y.TEMPLATE)
    told = spark.createDataFrame([("s", e, c) for e, c in chains], "structure string, entity string, chain string")
    sites = Y.holo_sites(spark.createDataFrame(made, ATOMS), templates, told)
    return [r.asDict(True) for r in sites.orderBy("rank").collect()], Y.site_status(templates, sites).first().asDict()


def test_only_our_entity_lines_the_site_and_all_chains_where_nothing_is_told(spark):
    (site,), status = run(spark, CASE)
    assert [(r["place"], r["component"], r["distance"]) for r in site["residues"]] == [(1, "ASP", 1.41), (2, "HIS", 2.24), (3, "THR", 2.24)]
    assert (site["site"], site["kind"], site["cofactor_required"], site["metals_in_entry"], site["usable"], site["confidence"]) == ("MG_D101", "metal", True, ["MG"], True, None)
    assert tuple(site["center"].values()) == (1.0, 1.0, 0.0) and status["status"] == "ok" and status["reason"] == ""
    (every,), _ = run(spark, CASE, chains=())
    assert {r["chain"] for r in every["residues"]} == {"A", "B"} and every["n_residues"] == 4


@pytest.mark.parametrize(
    "how,reason",
    [
        ({"metals": ()}, "no residue of our entity lines the bound components"),
        ({"ligands": ("ATP",), "metals": ()}, "no residue of our entity lines ATP"),
        ({"rows": [CASE[0], CASE[3], CASE[5]]}, "no residue of our entity lines MG"),
        ({"template": None}, "no qualifying homolog"),
        ({"accession": "AF-P1-F1", "source": "afdb"}, "the binding site is in 1ABC_1"),
    ],
)
def test_no_site_says_why(spark, how, reason):
    found, status = run(spark, **{"rows": CASE} | how)
    assert found == [] and status["status"] == "no_pocket" and status["reason"].startswith(reason)


def test_low_confidence_speaks_of_models_only(spark):
    (site,), status = run(spark, CASE, source="afdb", b=35.0)
    assert not site["usable"] and "below 70" in site["reason"] and status["status"] == "all_rejected"
    (site,), status = run(spark, CASE, b=35.0)
    assert site["usable"] and status["status"] == "ok"


def test_a_ligand_outranks_a_metal_and_shares_its_cofactor(spark):
    rows = [*CASE, ("HETATM", "5RP", "E", 201, 1.0, 1.0, 2.0), ("HETATM", "HOH", "F", 1, 0.0, 1.0, 0.0)]
    found, _ = run(spark, rows, ligands=("5rp", ""), metals=("mg",))
    assert [(s["component"], s["rank"], s["cofactor_required"]) for s in found] == [("5RP", 1, True), ("MG", 2, True)]
    alone, _ = run(spark, rows, ligands=("5RP",), metals=())
    assert [(s["component"], s["cofactor_required"]) for s in alone] == [("5RP", False)]


def test_entity_chains_and_places_of_atoms(spark, tmp_path):
    (tmp_path / "1abc.cif").write_text(
        "data_1ABC\nloop_\n_struct_asym.id\n_struct_asym.entity_id\nA 1\nB 2\nC ?\n#\nloop_\n_atom_site.group_PDB\n_atom_site.label_asym_id\n_atom_site.auth_asym_id\n_atom_site.Cartn_x\nATOM A X 1.0\nATOM B . 2.0\n#\n"
    )
    (tmp_path / "2abc.cif").write_text("data_2ABC\n#\n")
    assert sorted(map(tuple, entity_chains(spark, f"{tmp_path}/*.cif").collect())) == [("1abc", "1", "A"), ("1abc", "2", "B")]
    assert [tuple(r) for r in read_atoms(spark, f"{tmp_path}/1abc.cif").select("pos", "chain", "auth_chain").orderBy("pos").collect()] == [(0, "A", "X"), (1, "B", None)]
    rows = spark.createDataFrame([("s", "A"), ("s", "B"), ("t", "A")], "structure string, chain string")
    wanted, told = rows.select("structure", F.lit("1").alias("entity")), spark.createDataFrame([("s", "1", "B")], "structure string, entity string, chain string")
    assert sorted(map(tuple, Y.chains_of(rows, wanted, told).collect())) == [("s", "B"), ("t", "A")]
