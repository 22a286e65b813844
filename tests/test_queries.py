"""Registered queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from basalt.plans import queries as core
from basalt.streaming import latest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables are absent")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(core.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = core.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    want = duck.execute(core.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in want.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_stream_agrees_with_batch(spark, tmp_path):
    folder = tmp_path / "sf"
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(folder / "events.parquet"))
    stream = latest.latest_best(latest.events_stream(spark, str(folder)), ["user_id"])
    got = sorted(map(tuple, latest.drain(stream, "latest_best_events").collect()))
    assert got == sorted(map(tuple, core.QUERIES["streaming_latest_best"](spark, SF).collect()))
