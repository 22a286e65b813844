"""Texts of numbers and lists that SQL orders and rounds in its own way."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from basalt.functions import rules as R
from basalt.functions import scalar as S
from basalt.plans import queries as core
from basalt.plans import evidence_queries, feature_queries  # noqa: F401  register their queries

SF = "/root/testdata/sf0.01"


def test_numbers_are_rounded_by_their_exact_value(spark):
    draw = random.Random(3)
    values = [0.0, -0.0, 0.05, 0.25, 0.35, 0.5, 1.5, 2.5, 0.95, 9.95, 9.999, -0.04, -137.45, 137.45, 43.25, 51.15, 277.15, 1.005, 0.005, 0.015, 2.0**52 + 0.5, 2.0**53, 1e22, 5e-324]
    values += [draw.randrange(10**6) / 10 ** draw.randrange(1, 6) for _ in range(400)] + [draw.random() * 10 ** draw.randrange(-3, 12) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for digits in (0, 1, 2, 4):
        got = [r["t"] for r in df.select(S.fixed(F.col("x"), digits).alias("t")).collect()]
        assert got == [f"{x:.{digits}f}" for x in values]
    assert spark.range(1).select(S.fixed(F.lit(None).cast("double"), 1).alias("t")).first()["t"] is None
    assert spark.range(1).select(R.percent(F.lit(0.125)).alias("t")).first()["t"] == "12%"


def test_bindings_are_ordered_as_texts(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(7, 100, "A"), (7, 1000, "A"), (7, 99, "R"), (7, 100, "R"), (7, 100, "A"), (8, 5, "N")]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    got = sorted(map(tuple, core.QUERIES["role_bindings"](spark, folder).collect()))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    assert got == sorted(duck.execute(core.ORACLE_SQL["role_bindings"]).fetchall())
    assert got[0] == (7, "099:R,1000:A,100:A,100:R")


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables are absent")
@pytest.mark.parametrize("name", ["full_scores"])
def test_larger_tables_agree_with_sql(spark, name):
    duck = duckdb.connect()
    for table in os.listdir(SF):
        duck.execute(f"CREATE VIEW {table[:-8]} AS SELECT * FROM '{SF}/{table}'")
    df = core.QUERIES[name](spark, SF)
    want = duck.execute(core.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_first_words_of_unique_keys_are_not_shuffled(spark, tmp_path):
    rows = [(1, "b a  b - a"), (2, ""), (3, None), (4, "Δ x Δ"), (5, "-")]
    folder = str(tmp_path)
    duck = duckdb.connect()

    def check(name: str) -> str:
        duck.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/{name}/documents.parquet/*.parquet'")
        df = core.QUERIES["terms_first_seen"](spark, f"{folder}/{name}").select("doc_id", "word", "pos")
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, duck.execute(f"SELECT doc_id, word, pos FROM ({core.ORACLE_SQL['terms_first_seen']})").fetchall()))
        return df._jdf.queryExecution().executedPlan().toString()

    schema = "doc_id long, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/unique/documents.parquet")
    assert "Exchange" not in check("unique")
    again = [(1, "c b"), (1, "a"), (None, "x y"), (None, "y z x"), (3, "late"), (3, None)]
    spark.createDataFrame(rows + again, schema).write.parquet(f"{folder}/repeated/documents.parquet")
    check("repeated")
