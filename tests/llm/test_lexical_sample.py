"""The sample that the lexical index is fitted on."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basalt.llm import lexical


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(lexical, "SAMPLE", 8)


def test_tasks_leave_out_what_the_sample_cannot_hold(spark):
    docs = spark.createDataFrame([(k, f"word{k} common") for k in range(400)], "doc_id long, text string")
    forward = lexical.forward_rows(docs)
    plain = forward.select(F.xxhash64("doc_id", "terms").alias("h"), "terms").orderBy("h").limit(8)
    chosen = lexical.sampled(forward, 400)
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, plain.collect()))
    assert "Filter" in chosen._jdf.queryExecution().optimizedPlan().toString()


def test_rows_that_repeat_one_document_have_a_tree(spark):
    for doc in range(4):
        docs = spark.createDataFrame([(doc, "one two two")] * 300, "doc_id long, text string")
        items = spark.createDataFrame([("q", "two")], "item_id string, text string")
        found = lexical.ranked_search(docs, items).collect()
        assert [r["doc_id"] for r in found] == [doc] * lexical.NEAREST


def test_few_shards_are_held_at_once(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARDS_HELD", 3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None)

    def sizes(batches):
        yield from ({"n": [b.num_rows]} for b in batches)

    def held(index, texts, nearest):
        batches = lambda it: (pa.RecordBatch.from_pydict(x) for x in sizes(it))
        return index.shards.coalesce(1).mapInArrow(batches, "n long")

    shards = spark.createDataFrame([(str(k),) for k in range(10)], "shard string")
    monkeypatch.setattr(lexical, "_found", held)
    found = lexical.search_index(lexical.Index(shards, 10, 10), [])
    assert sum(r["n"] for r in found.collect()) == 10 and max(r["n"] for r in found.collect()) <= 3
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) == before
