"""Calls of taxa, resolution of references and organisms that are one."""

from pyspark.sql import functions as F

from basalt.operators.organisms import relatedness
from basalt.plans import taxonomy as Q


def test_calls_and_their_reasons(spark):
    taxa = spark.createDataFrame([("1", None, "superkingdom", "B"), ("2", "1", "genus", "G"), ("3", "2", "species", "G s"), ("4", "3", "strain", "G s x"), ("5", "1", "species", "lone")], "taxon string, parent string, rank string, name string")
    hits = [("a", "g1", "4", 0.01, 2), ("a", "g2", "5", 0.01, 3), ("b", "g", "4", 0.1, 1), ("c", "g", "4", 0.3, 1), ("d", "g", None, 0.01, 1), ("e", "g", "9", 0.01, 1), ("f", "g", "5", 0.2, 1), ("h", "g", "3", 0.05, 1), ("h", "x", "2", None, 0)]
    df = spark.createDataFrame(hits, "run string, genome string, taxon string, distance double, pos int")
    runs = spark.createDataFrame([(r,) for r in "abcdefgh"], "run string")
    got = {r["run"]: (r["called_rank"], r["taxon"], r["name"], r["reason"]) for r in Q.call_taxa(runs, df, taxa).collect()}
    none = (None, None, None)
    assert got == {
        "a": ("species", "3", "G s", ""), "b": ("genus", "2", "G", ""), "c": (*none, "the nearest genome is at 0.3000, beyond every cut-off"), "d": (*none, "the nearest genome has no taxon"),
        "e": (*none, "the taxon is not known"), "f": (*none, "the lineage has no genus"), "g": (*none, "no hits"), "h": ("species", "3", "G s", ""),
    }


def test_references_by_keyword_relatives_and_nearest_names(spark):
    schema = "query string, keyword string, relatives array<string>, lineage array<string>, scientific string"
    asked = [
        ("keyword", " Vibrio ", ["g1"], ["Vibrio"], "V c"), ("related", None, ["g1", "g2", "zz", ""], ["R"], "S"), ("walk", " ", [], ["Root", "Family", "Genus", "", "Species"], None),
        ("own name", None, None, ["Far", "A", "B", "C", "D"], "S"), ("named", None, None, ["S"], "S"), ("beyond", None, None, ["Root", "A", "B", "C", "D"], None), ("nothing", None, None, None, None),
    ]
    known = [("genome", "g1", 3), ("genome", "g2", 4), ("genome", "empty", 0), ("name", "Vibrio", 9), ("name", "Root", 5), ("name", "Family", 2), ("name", "S", 1), ("name", "R", 8)]
    got = {r["query"]: (r["kind"], r["matched"], r["rows"]) for r in Q.resolve_reference(spark.createDataFrame(asked, schema), spark.createDataFrame(known, "kind string, value string, rows long")).collect()}
    assert got == {
        "keyword": ("name", "Vibrio", 9), "related": ("genome", "2 related genomes", 7), "walk": ("name", "Family", 2), "own name": ("name", "S", 1), "named": ("name", "S", 1),
        "beyond": ("name", "D", 0), "nothing": ("name", "", 0),
    }


def test_organisms_by_taxon_lineage_and_name(spark):
    line = [("Bacteria", 2), ("Mycoplasmoides", 7), ("Mycoplasmoides genitalium", 8), ("Mycoplasmoides genitalium G37", 9)]
    rows = [
        (1, "Mycoplasma genitalium G37", 9, line, "whatever", 8), (2, "Mycoplasma genitalium", None, line, "Mycoplasmoides genitalium", None), (3, "Mycoplasma genitalium", None, [], "Mycoplasmoides genitalium X", 0),
        (4, "Mycoplasma genitalium", None, line, "Mycoplasmoides pneumoniae", 5), (5, " ", 4, [], "Escherichia coli", 4), (6, None, None, None, "Escherichia coli", None), (7, "Escherichia coli", 1, [], "Salmonella enterica", 2), (8, "Escherichia coli", 1, [], None, None),
    ]
    df = spark.createDataFrame(rows, "k int, name string, taxon long, lineage array<struct<name:string,taxon:long>>, hit string, hit_taxon long")
    x = Q.same_organism(*(F.col(c) for c in ("name", "taxon", "lineage", "hit", "hit_taxon")))
    got = {r["k"]: tuple(r["x"]) for r in df.select("k", x.alias("x")).collect()}
    assert got == {1: (True, True, True), 2: (True, True, True), 3: (True, True, True), 4: (True, False, True), 5: (False, True, True), 6: (False, False, False), 7: (True, False, False), 8: (True, False, False)}


def test_relatedness_counts_genomes_not_rows(spark):
    reference = spark.createDataFrame([("g1", "Mycoplasma genitalium", 1), ("g1", "Other name", 2), ("g2", "Mycoplasmoides pneumoniae", 3), (" ", "Vibrio cholerae", 4), (None, "Vibrio cholerae", 5), ("g3", None, 6)], "genome_id string, genome_name string, pos int")
    got = {r["query"]: tuple(r)[1:] for r in relatedness(reference, spark.createDataFrame([("Mycoplasmoides genitalium",), ("Escherichia coli",), ("",), (None,)], "query string")).collect()}
    assert got == {"Mycoplasmoides genitalium": (True, 3, 1, 2), "Escherichia coli": (True, 3, 0, 0), "": (False, None, None, None), None: (False, None, None, None)}


def test_lists_are_trimmed_of_spaces_alone(spark):
    from basalt.functions.scalar import split_list

    assert spark.sql("select '0a, 1b1 ,  2c2,-, 3' s").select(split_list(F.col("s")).alias("x")).first()["x"] == ["0a", "1b1", "2c2", "3"]
