"""Feature joins, summaries and text rules on small inputs."""

from pyspark.sql import functions as F

from basalt.functions import rules as R
from basalt.operators import aggregates as A
from basalt.operators import features as X
from basalt.operators import keyed as K


def test_mechanisms_by_text_class_and_context(spark):
    rows = [("Type III secretion system effector", None, False), ("FimA", ["Adherence", "Nutritional/Metabolic factor"], False), ("two-component response regulator", None, True), ("two-component response regulator", None, False), (None, ["Exoenzyme", None], None)]
    df = spark.createDataFrame(rows, "product string, classes array<string>, virulence boolean")
    out = [r["m"] for r in df.select(R.mechanisms(F.col("product"), F.col("classes"), F.col("virulence")).alias("m")).collect()]
    assert out == [["secretion"], ["adhesion", "iron"], ["regulation"], [], ["degradation"]]


def test_small_rules(spark):
    row = spark.sql("select 'Escherichia coli K-12' a, 'ESCHERICHIA' b, ' ' c, 0.256D s, cast(null as double) n, 'hypothetical protein' h, 'gyrase' g").select(
        R.organism_of(F.col("a")), R.organism_of(F.col("b")), R.informative(F.col("c")), R.percent(F.col("s")), R.percent(F.col("n")), R.informative(F.col("h")), R.informative(F.col("g")),
        R.poor_genome(F.lit(" POOR"), F.lit(None).cast("array<string>")), R.poor_genome(F.lit(None).cast("string"), F.array(F.lit("x"))), R.poor_genome(F.lit("Good"), F.array().cast("array<string>")),
        R.atom_type(F.lit("CZ"), F.lit("TYR"), F.lit("C")), R.atom_type(F.lit("ND1"), F.lit("HIS"), F.lit("N")), R.atom_type(F.lit("X"), F.lit("LIG"), F.lit("ZN")),
    ).first()
    assert tuple(row) == ("Escherichia coli", None, False, "26%", "—", False, True, True, True, False, "A", "NA", "ZN")


def test_overwrite_choice_and_lookup(spark):
    rows = spark.createDataFrame([("1abc_1", "own", 1), ("2xyz_1", "own", 2)], "entity string, title string, n int")
    known = spark.createDataFrame([("1ABC_1", "new", 7)], "entity string, title string, year int")
    assert sorted(map(tuple, X.overwrite_known(rows, "entity", known).collect())) == [("1abc_1", "new", 1, 7), ("2xyz_1", "own", 2, None)]
    refs = spark.createDataFrame([("f", "UniProtKB/TrEMBL", True, "A", 2, 1, 1), ("f", "UniProtKB/Swiss-Prot", True, "B", 2, 1, 2), ("f", "UniProtKB/Swiss-Prot", False, "C", 1, 1, 3), ("g", "EMBL", True, "D", 1, 1, 1)], "k string, database string, active boolean, accession string, taxon int, wanted_taxon int, pos int")
    assert [tuple(r) for r in X.choose_accession(refs, "k").collect()] == [("f", "B", 2)]
    knowledge = spark.createDataFrame([("Vibrio cholerae", "s"), ("vibrio", "g")], "name string, note string")
    asked = spark.createDataFrame([("Vibrio cholerae",), ("Vibrio harveyi",), ("Other one",), (None,)], "organism string")
    assert {r["organism"]: (r["note"], r["hint"]) for r in X.lookup_by_hint(asked, "organism", knowledge, ["note"]).collect()} == {"Vibrio cholerae": ("s", "species"), "Vibrio harveyi": ("g", "genus"), "Other one": (None, None), None: (None, None)}


def test_receptor_keeps_first_model_chains_and_places(spark):
    atom = lambda n, alt, chain: f"ATOM  {n:5d}  CA {alt}ALA {chain}   1"
    lines = [("s", 1, atom(1, " ", "A")), ("s", 2, atom(2, "B", "A")), ("s", 3, atom(3, "A", "B")), ("s", 4, "HETATM"), ("s", 5, "ENDMDL"), ("s", 6, atom(4, " ", "A"))]
    df = spark.createDataFrame(lines, "structure string, pos int, line string")
    assert sorted(r["pos"] for r in X.receptor_atoms(df).collect()) == [1, 3]
    assert [r["pos"] for r in X.receptor_atoms(df, ("A",)).collect()] == [1]


def test_view_falls_back_and_growth_is_labelled(spark):
    ranked = spark.createDataFrame([(1, 1, False), (2, 2, False), (3, 3, False)], "id int, rank int, selected boolean")
    assert [r["id"] for r in X.view_top(ranked, 2).collect()] == [1, 2]
    assert [r["id"] for r in X.view_top(ranked.withColumn("selected", F.col("id") == 3), 2).collect()] == [3]
    rows = spark.createDataFrame([("anaerobic", "x", 3), ("not provided", "x", 3), (None, None, None)], "own string, typical string, n int")
    out = [r["g"] for r in rows.select(R.growth_row(F.col("own"), F.col("typical"), F.col("n")).alias("g")).collect()]
    assert [x and tuple(x) for x in out] == [("anaerobic", "this genome"), ("x", "species-typical (3 genomes)"), None]


def test_median_of_one_hot_key_and_repeated_updates(spark):
    rows = spark.createDataFrame([("a", v) for v in [5, 1, 1, 1, 9, 9]] + [("b", 4), ("b", None)], "k string, v int")
    assert {r["k"]: (r["median"], r["n"]) for r in A.upper_median(rows, ["k"], "v").collect()} == {"a": (5, 6), "b": (4, 1)}
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    try:
        K.keyed_merge(base, spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int"), "k").collect()
        raise SystemError("a repeated key went through")
    except Exception as error:
        assert "repeated key a" in str(error)
