"""Structure files and trees: mmCIF atoms and Newick nodes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.functions.scalar import as_float, as_int

_WORD = re.compile(r"'(?:[^']|'(?!\s|$))*'(?=\s|$)|\"(?:[^\"]|\"(?!\s|$))*\"(?=\s|$)|\S+")


def loop_rows(text: str, required: str) -> tuple[list[str], list[list[str]]]:
    """Columns and rows of the first ``loop_`` that has ``required``; a loop whose values do not
    fill whole rows counts as empty."""
    for part in re.split(r"(?m)^loop_\s*$", text)[1:]:
        names, values = [], []
        for line in part.splitlines():
            if line.startswith("_") and not values:
                names.append(line.split()[0])
            elif line.startswith(("#", "loop_", "data_", "_")):
                break
            else:
                values += [w[1:-1] if len(w) > 1 and w[0] == w[-1] and w[0] in "'\"" else w for w in _WORD.findall(line)]
        if required in names:
            width = len(names)
            rows = [values[i : i + width] for i in range(0, len(values), width)] if len(values) % width == 0 else []
            return names, rows
    return [], []


def atoms(spark: SparkSession, path: str) -> DataFrame:
    """Atoms of the first model, one row each."""
    columns = "group_PDB label_atom_id label_comp_id label_asym_id label_seq_id auth_seq_id auth_asym_id label_alt_id Cartn_x Cartn_y Cartn_z B_iso_or_equiv pdbx_PDB_model_num".split()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                names, rows = loop_rows(content.decode("utf-8", errors="replace"), "_atom_site.Cartn_x")
                table = pd.DataFrame(rows, columns=[n.split(".")[-1] for n in names])
                yield pd.DataFrame({"path": file, "pos": table.index} | {c: table[c] if c in table else None for c in columns}, index=table.index)

    schema = "path string, pos long, " + ", ".join(f"{c} string" for c in columns)
    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)
    value = lambda c: F.when(~F.col(c).isin(".", "?"), F.col(c))
    return raw.where("pdbx_PDB_model_num is null or pdbx_PDB_model_num = '1'").select(
        F.regexp_extract("path", r"([^/]+)\.cif$", 1).alias("structure"), "pos", "group_PDB", value("label_atom_id").alias("atom"), value("label_comp_id").alias("component"),
        value("label_asym_id").alias("chain"), as_int(value("label_seq_id")).alias("seq_id"), value("auth_seq_id").alias("auth_seq_id"), value("auth_asym_id").alias("auth_chain"),
        as_float(F.col("Cartn_x")).alias("x"), as_float(F.col("Cartn_y")).alias("y"), as_float(F.col("Cartn_z")).alias("z"), as_float(F.col("B_iso_or_equiv")).alias("b"),
    )


def entity_chains(spark: SparkSession, path: str) -> DataFrame:
    """Rows (structure, entity, chain): which chains belong to an entity, where the file says so."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                names, rows = loop_rows(content.decode("utf-8", errors="replace"), "_struct_asym.entity_id")
                table = pd.DataFrame(rows, columns=[n.split(".")[-1] for n in names])
                known = {"path": file, "entity": table.get("entity_id"), "chain": table.get("id")}
                yield pd.DataFrame(known, index=table.index)

    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, entity string, chain string")
    told = raw.where(~F.col("entity").isin(".", "?") & ~F.col("chain").isin(".", "?"))
    return told.select(F.regexp_extract("path", r"([^/]+)\.cif$", 1).alias("structure"), "entity", "chain").distinct()


def newick_nodes(text: str) -> list[tuple[int, int | None, str, float | None]]:
    """Nodes (id, parent, name, length) of a Newick tree, parents before children."""
    nodes: list[list] = [[0, None, "", None]]
    at = 0
    for word in re.findall(r"[(),;]|:[^(),;]+|'[^']*'|[^(),:;]+", text.strip()):
        if word == "(" or word == ",":
            parent = at if word == "(" else nodes[at][1]
            nodes.append([len(nodes), parent, "", None])
            at = len(nodes) - 1
        elif word == ")":
            at = nodes[at][1]
        elif word == ";":
            break
        elif word.startswith(":"):
            nodes[at][3] = float(word[1:])
        elif word.strip():
            nodes[at][2] = word.strip().strip("'")
    return [tuple(n) for n in nodes]


def newick(spark: SparkSession, path: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, text in zip(frame["path"], frame["value"]):
                rows = newick_nodes(text)
                yield pd.DataFrame({"path": file, "node_id": [r[0] for r in rows], "parent_id": pd.array([r[1] for r in rows], "Int32"), "name": [r[2] for r in rows], "length": [r[3] for r in rows]})

    trees = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return trees.mapInPandas(run, "path string, node_id int, parent_id int, name string, length double")
