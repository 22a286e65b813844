"""Readers and sinks on files written by the tests."""

from pyspark.sql import functions as F

from basalt import sinks
from basalt.sources import delimited, fasta, fasta_checked, fasta_stats, json_records, resolve, tolerant_text
from basalt.sources import structures as X
from basalt.sources import tabular as T
from basalt.sources.sequences import unique_ids, write_fasta


def test_fasta_first_and_last(spark, tmp_path):
    p = tmp_path / "a.faa"
    p.write_text(">fig|1.1.peg.1|L1| gyrase [Aus bus | 1.1]\nMKV\nacd\n>fig|1.1.peg.2  kinase\nMM\n>fig|1.1.peg.1 other\nTTT\n")
    first = {r["feature_id"]: r for r in fasta(spark, str(p)).collect()}
    assert first["fig|1.1.peg.1"]["sequence"] == "MKVACD" and first["fig|1.1.peg.1"]["organism"] == "Aus bus" and len(first) == 2
    assert {r["feature_id"]: r["sequence"] for r in fasta(spark, str(p), "last").collect()}["fig|1.1.peg.1"] == "TTT"
    stats = fasta_stats(spark, str(p)).first()
    assert (stats["n_sequences"], stats["n_letters"]) == (3, 11)


def test_fasta_checked_and_unique_ids(spark, tmp_path):
    p = tmp_path / "b.faa"
    p.write_text(">a x\nMKV*\n>a y\nACGTACGTACGTACGTACGTACGTACGTACGT\n>c\nM1\n>d\n\n")
    rows = {r["header"]: (r["sequence"], r["problem"]) for r in fasta_checked(spark, str(p)).collect()}
    assert rows["a x"] == ("MKV", None) and rows["a y"][1] == "nucleotides" and rows["c"][1] == "not amino acids" and rows["d"][1] == "empty sequence"
    ids = sorted(r["unique_id"] for r in unique_ids(fasta_checked(spark, str(p))).collect())
    assert ids == ["a", "a_2", "c", "d"]


def test_tables_json_and_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Patric ID;product\nfig|1;"a, b"\n;x\n')
    out = resolve(delimited(spark, str(tmp_path / "t.csv")), ("feature_id", "product", "gene")).collect()
    assert (out[0]["feature_id"], out[0]["product"], out[0]["gene"]) == ("fig|1", "a, b", None) and out[1]["feature_id"] is None
    (tmp_path / "t.json").write_text('{"items": [{"patric_id": "p", "identity": 52}, {"patric_id": "q"}]}')
    assert sorted(r["patric_id"] for r in json_records(spark, str(tmp_path / "t.json")).collect()) == ["p", "q"]
    (tmp_path / "w.txt").write_bytes("naïve".encode("cp1252"))
    assert tolerant_text(spark, str(tmp_path / "w.txt")).first()["text"] == "naïve"
    (tmp_path / "q.txt").write_bytes("“quoted” €5".encode("cp1252"))
    assert tolerant_text(spark, str(tmp_path / "q.txt")).first()["text"] == "“quoted” €5"


def test_provider_outputs(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("q\ts\t52.5\t10\t0\t0\t1\t10\t1\t10\t1e-9\t88.0\nq\tbad\n")
    assert [r["bitscore"] for r in T.hits(spark, str(tmp_path / "h.tsv")).collect()] == [88.0]
    (tmp_path / "t.gff3").write_text("# p1 Length: 9\n# p1 Number of predicted TMRs: 2\np1\tTMhelix\t1\t20\np1\tTMhelix\t30\t50\n//\n# p2 Number of predicted TMRs: 0\np2\tsignal\t1\t20\n//\n")
    assert {r["feature_id"]: (r["spans"], r["signal"]) for r in T.topology(spark, str(tmp_path / "t.gff3")).collect()} == {"p1": (2, False), "p2": (0, True)}
    (tmp_path / "s.txt").write_text("# x\np1 d\tSP\t0.9\tCS pos: 21-22. Pr: 0.9\np2\tOTHER\t0.1\t\n")
    assert [(r["feature_id"], r["cleavage"]) for r in T.signal_peptides(spark, str(tmp_path / "s.txt")).collect()] == [("p1", 21), ("p2", None)]
    (tmp_path / "l.txt").write_text("SeqID\tLocalization\tScore\np1\tOuterMembrane\t9.5\n")
    assert T.localisations(spark, str(tmp_path / "l.txt")).first()["location"] == "outer membrane"
    fields = ["-"] * len(T.EMAPPER_COLUMNS)
    fields[0], fields[T.EMAPPER_COLUMNS.index("GOs")] = "p1", "GO:1,GO:2"
    (tmp_path / "e.tsv").write_text("## c\n#query\n" + "\t".join(fields) + "\n")
    assert sorted(r["id"] for r in T.emapper(spark, str(tmp_path / "e.tsv")).collect()) == ["GO:1", "GO:2"]


def test_structures_and_trees(spark, tmp_path):
    head = "data_X\nloop_\n_atom_site.group_PDB\n_atom_site.label_atom_id\n_atom_site.label_seq_id\n_atom_site.Cartn_x\n_atom_site.Cartn_y\n_atom_site.Cartn_z\n_atom_site.pdbx_PDB_model_num\n"
    (tmp_path / "x.cif").write_text(head + "ATOM \"C1'\" 1 1.0 2.0 3.0 1\nHETATM O . 4.0 ? 6.0 1\nATOM N 2 1 1 1 2\n#\n")
    (tmp_path / "y.cif").write_text("data_Y\nloop_\n_atom_site.Cartn_x\n_atom_site.Cartn_y\n1 2 3\n")
    rows = {r["atom"]: (r["structure"], r["seq_id"], r["x"], r["y"]) for r in X.atoms(spark, f"{tmp_path}/*.cif").collect()}
    assert rows == {"C1'": ("x", 1, 1.0, 2.0), "O": ("x", None, 4.0, None)}
    (tmp_path / "t.nwk").write_text("((a:1,b:2)0.9:0.5,'c d':3);")
    nodes = {r["name"]: (r["parent_id"], r["length"]) for r in X.newick(spark, str(tmp_path / "t.nwk")).collect()}
    assert nodes["a"][1] == 1.0 and nodes["c d"][1] == 3.0 and nodes["0.9"] == (0, 0.5)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "M" * 130, ["x", "y"], True), ("b", "K", None, None)], "feature_id string, sequence string, tags array<string>, flag boolean")
    sinks.write_section(df, str(tmp_path / "s"), "proteins", "r1")
    sinks.write_section(df.limit(1), str(tmp_path / "s"), "proteins", "r2")
    sinks.write_section(df, str(tmp_path / "s"), "proteins", "r1")
    assert spark.read.parquet(str(tmp_path / "s/proteins")).count() == 3
    write_fasta(df, str(tmp_path / "f"))
    assert {r["feature_id"]: len(r["sequence"]) for r in fasta(spark, str(tmp_path / "f")).collect()} == {"a": 130, "b": 1}
    sinks.write_views(df, str(tmp_path / "v"), {"flagged": F.col("flag")}, ["feature_id", "tags", "flag"])
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "v/flagged"), sep="\t", header=True).collect()] == [("a", "x;y", "true")]
    assert [tuple(r) for r in sinks.violations(df, "feature_id", {"tagged": F.size("tags") > 0, "flagged": F.col("flag")}).collect()] == [("b", "tagged"), ("b", "flagged")]
