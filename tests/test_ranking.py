"""Ranks by ranges, and merges that refuse what they do not know."""

import random

import pytest
from pyspark.sql import functions as F

from basalt.operators import features as X
from basalt.operators import keyed as K
from basalt.operators.best import rank_select
from basalt.operators.ranking import in_order


def plan(df):
    return df._jdf.queryExecution().toString()


def fails(df, message):
    """Whatever is read of the table, the job fails."""
    for part in (df, df.select(df.columns[-1]), df.groupBy().count()):
        with pytest.raises(Exception, match=message):
            part.collect()
    with pytest.raises(Exception, match=message):
        df.count()


@pytest.mark.parametrize("n", [0, 1, 7, 400, 5000])
def test_rank_and_slots_pass_across_ranges(spark, n):
    rng = random.Random(n)
    rows = [(k, rng.choice([0.3, 0.3, 0.3, rng.random()]), None if rng.random() < 0.1 else rng.random() < 0.5) for k in range(3000)]
    df = spark.createDataFrame(rows, "id int, score double, out boolean").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_select(df, [F.desc("score"), F.col("id")], n, F.col("out"))
        assert "Window" not in plan(got)
        assert len({r[0] for r in got.select(F.input_file_name()).distinct().collect()}) > 1
        got = {r["id"]: (r["rank"], r["selected"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    taken, want = 0, {}
    for rank, (k, _, out) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        want[k] = (rank, not out and taken < n)
        taken += not out
    assert got == want


def test_one_value_everywhere_still_parts(spark):
    df = spark.range(4000).select("id", F.lit(1.0).alias("score"), F.lit(False).alias("out"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = in_order(df, [F.desc("score"), F.col("id")])
        assert got.select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.where("place <> id + 1").count() == 0
    assert in_order(df.limit(0), [F.col("id")]).count() == 0


def test_merge_refuses_whatever_is_read(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, v int")
    good = spark.createDataFrame([(2, 7)], "k int, v int")
    assert sorted(map(tuple, K.keyed_merge(base, good, "k").collect())) == [(1, "a", 1), (2, "b", 7)]
    fails(K.keyed_merge(base, spark.createDataFrame([(9, 7)], "k int, v int"), "k"), "unknown key 9")
    fails(K.keyed_merge(base, spark.createDataFrame([(None, 7)], "k int, v int"), "k"), "unknown key null")
    fails(K.keyed_merge(base, spark.createDataFrame([(1, 7), (1, 8)], "k int, v int"), "k"), "repeated key 1")
    assert K.keyed_merge(base, good.limit(0), "k").count() == 2


def test_lookups_refuse_names_that_differ_in_case_alone(spark):
    rows = spark.createDataFrame([("a_1", "own"), ("b_1", "own")], "entity string, title string")
    twice = spark.createDataFrame([("A_1", "x"), ("a_1", "y"), ("C_1", "z"), ("c_1", "z")], "entity string, title string")
    fails(X.overwrite_known(rows, "entity", twice), "repeated key A_1")
    unused = twice.where("title = 'z'").unionByName(spark.createDataFrame([("B_1", "new")], twice.schema))
    assert sorted(map(tuple, X.overwrite_known(rows, "entity", unused).collect())) == [("a_1", "own"), ("b_1", "new")]
    assert X.overwrite_known(rows, "entity", unused).count() == 2
    knowledge = spark.createDataFrame([("Vibrio", "x"), ("vibrio", "y"), ("Vibrio cholerae", "z")], "name string, note string")
    fails(X.lookup_by_hint(spark.createDataFrame([("Vibrio harveyi",)], "o string"), "o", knowledge, ["note"]), "repeated key vibrio")
    assert X.lookup_by_hint(spark.createDataFrame([("Vibrio cholerae",)], "o string"), "o", knowledge, ["note"]).first()["note"] == "z"
    routes = [("one", spark.createDataFrame([(1, "p"), (1, "q"), (2, "r")], "k int, t string"), "k", "t")]
    fails(K.crosswalk(spark.createDataFrame([(1,)], "k int"), "k", routes), "repeated key 1")
    assert K.crosswalk(spark.createDataFrame([(2,), (None,)], "k int"), "k", routes).count() == 2


def test_view_of_nothing_selected(spark):
    ranked = spark.createDataFrame([(r, r > 6 and r % 2 == 0) for r in range(1, 12)], "rank int, selected boolean")
    assert [r["rank"] for r in X.view_top(ranked, 2).collect()] == [8, 10]
    assert [r["rank"] for r in X.view_top(ranked.withColumn("selected", F.lit(None).cast("boolean")), 2).collect()] == [1, 2]
    assert X.view_top(ranked.limit(0), 3).count() == 0
