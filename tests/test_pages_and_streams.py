"""Paged replies that must not be cut short, and keyed state over late, repeated and resumed rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from basalt.sources.paged import Reply, fields, folder_fetch, keep_pages, pages, total_rows
from basalt.streaming import latest, stateful

ROWS = [{"patric_id": f"f{k}", "v": k} for k in range(9)]


def server(rows, total=True, star=False, ignores=False, most=None):
    def fetch(start, count):
        count = min(count, most or count)
        body = rows[:count] if ignores else rows[start : start + count]
        return Reply(body, f"items {start}-{start + len(body) - 1}/{'*' if star else len(rows)}" if total else None)

    return fetch


def ids(df):
    return sorted((r["pos"], json.loads(r["row"]).get("patric_id")) for r in df.collect())


def test_pages_until_the_total_one_partition_each(spark):
    df = pages(spark, server(ROWS), page=4)
    assert ids(df) == [(k, f"f{k}") for k in range(9)]
    assert spark.read.format("pages").load().rdd.getNumPartitions() == 3
    assert [tuple(r) for r in fields(df, "patric_id string, v int").orderBy("pos").collect()] == [(k, f"f{k}", k) for k in range(9)]


def test_cap_and_pages_that_the_server_cuts_short(spark):
    assert len(ids(pages(spark, server(ROWS), page=2, cap=5))) == 5
    assert len(ids(pages(spark, server(ROWS, most=2), page=4))) == 9


@pytest.mark.parametrize("how", [{"total": False}, {"star": True}])
def test_full_page_without_total_is_an_error(spark, how):
    with pytest.raises(Exception, match="no total is known"):
        pages(spark, server(ROWS, **how), page=4).collect()
    assert len(ids(pages(spark, server(ROWS, **how), page=50))) == 9


def test_a_server_that_serves_one_page_over_and_over_adds_nothing(spark):
    df = pages(spark, server(ROWS, ignores=True), page=4)
    assert ids(df) == [(k, f"f{k}") for k in range(4)]


def test_rows_lost_between_pages_are_an_error(spark):
    def fetch(start, count):
        return Reply(ROWS[start : start + count] if start != 4 else ROWS[4:6], f"items x/{len(ROWS)}")

    with pytest.raises(Exception, match="2 of 4 rows"):
        pages(spark, fetch, page=4).collect()

    def moved(start, count):
        return Reply(ROWS[start : start + count], f"items x/{9 if start == 0 else 11}")

    with pytest.raises(Exception, match="another total"):
        pages(spark, moved, page=4).collect()


def test_rows_without_identity_stay_and_empty_replies_are_empty(spark):
    assert pages(spark, server([{"v": 1}, {"v": 1}, {"md5": "a"}, {"md5": "a", "v": 2}]), page=2).count() == 3
    assert pages(spark, server([]), page=2).count() == 0
    assert total_rows("items 0-24/97") == 97 and total_rows("items 0-3/*") is None and total_rows(None) is None


def test_kept_pages_come_back(spark, tmp_path):
    df = spark.range(25).select(F.col("id").alias("taxon_id"), F.when(F.col("id") % 3 == 0, F.lit("é \"x\"")).alias("name"))
    keep_pages(df, F.col("taxon_id"), f"file://{tmp_path}/kept", 10)
    assert sorted(p.name for p in (tmp_path / "kept").iterdir()) == ["0.json", "10.json", "20.json"]
    back = fields(pages(spark, folder_fetch(f"file:{tmp_path}/kept"), 10), "taxon_id long, name string")
    assert sorted(map(tuple, back.drop("pos").collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "kept" / "10.json").unlink()
    with pytest.raises(Exception, match="0 of 10 rows"):
        pages(spark, folder_fetch(f"file:{tmp_path}/kept"), 10).collect()


BASE = dt.datetime(2024, 1, 1)


def test_sessions_over_late_repeated_and_resumed_rows(spark, tmp_path):
    schema = "event_id long, user string, ts timestamp, value double"
    put = lambda rows: spark.createDataFrame([(i, u, BASE + dt.timedelta(seconds=s), v) for i, u, s, v in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).withWatermark("ts", "10 seconds")
        out = stateful.run_through(stateful.sessions(stream, "user", 60), str(tmp_path / "run"))
        return sorted((r["key"], r["sessions"], r["n"], r["total"], (r["first_ts"] - BASE).total_seconds(), (r["last_ts"] - BASE).total_seconds()) for r in out.collect())

    put([(1, "u", 0, 1.0), (2, "u", 30, 2.0), (2, "u", 30, 2.0), (3, "v", 10, 5.0), (9, None, 5, 1.0), (8, "u", 5, None)])
    assert go() == []
    # The rows are split over two runs of one query: what was open is taken up from the checkpoint.
    put([(4, "u", 65, 3.0), (2, "u", 30, 2.0), (5, "w", 1000, 1.0)])
    first = [("u", 1, 3, 6.0, 0, 65), ("v", 1, 1, 5.0, 10, 10)]
    assert go() == first
    # A row behind the watermark is late and changes nothing; a later one opens the next session.
    put([(6, "u", 70, 9.0), (7, "u", 1200, 4.0), (10, "w", 1030, 1.0)])
    assert go() == sorted([*first, ("w", 1, 2, 2.0, 1000, 1030)])
    put([(11, "z", 9000, 1.0)])
    assert go() == sorted([*first, ("w", 1, 2, 2.0, 1000, 1030), ("u", 2, 1, 4.0, 1200, 1200)])


def test_windows_and_repeats_within_the_watermark(spark, tmp_path):
    schema = "event_id long, user string, ts timestamp_ntz, value double"
    rows = [(1, "u", BASE, 1.0), (1, "u", BASE, 1.0), (2, "u", BASE + dt.timedelta(hours=30), 2.0), (3, "v", BASE, 4.0)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    stream = latest.distinct_events(latest.events_stream(spark, str(tmp_path)))
    got = latest.drain(latest.windowed(stream, ["user"], "value"), "daily", "append").collect()
    # The last window is still open: only what the watermark has passed is final.
    assert sorted((r["user"], r["n"], r["total"]) for r in got) == [("u", 1, 1.0), ("v", 1, 4.0)]
