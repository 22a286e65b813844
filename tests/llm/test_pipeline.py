"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline
from basalt.llm import queries

WORDS = [f"{a}{b}" for a in "the an of re in to wh er".split() for b in "tion ing st ed es on at ly th ea".split()]


def test_stages_in_order(spark, tmp_path):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage = prose(60)
    rows = [(i, "\n".join([prose(30), prose(30), *([passage] if i in (10, 20) else [])]), "en", f"s{i % 3}") for i in range(120)]
    rows = [(i, (t + " loser" if i % 6 == 0 else t), lang, s) for i, t, lang, s in rows]
    copy = rows[31][1]
    rows += [(900, copy, "en", "s1"), (901, None, "en", None), (902, "", "en", "s1")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen = {}
    at = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        at = spark.read.parquet(str(tmp_path / f"stage{k}"))
        seen[name] = at
        if k < 4:
            assert at.columns == docs.columns and at.dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "byte_bpe"]
    clean = {r["doc_id"] for r in seen["toxicity"].collect()}
    assert clean == {r[0] for r in rows if r[0] >= 120 or r[0] % 6}
    texts = {r["doc_id"]: r["text"] for r in seen["line_dedup"].collect()}
    assert passage in texts[10] and passage not in texts[20] and 900 not in texts and texts[901] is None and texts[902] == ""
    kept = {r["doc_id"] for r in seen["simhash"].collect()}
    assert 901 in kept and 902 not in kept and 31 in kept
    mixed = seen["mixing"].groupBy("doc_id").count().collect()
    assert max(r["count"] for r in mixed) <= 2 and {r["doc_id"] for r in mixed} <= kept
    last = seen["byte_bpe"].collect()
    assert len(last) == sum(r["count"] for r in mixed)
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, last))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept_text string, lost_marks string, simhash_mark string"


def stage(spark, name, rows, folder):
    """Rows of one stage over documents (doc_id, text) with columns whose names clash."""
    full = [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in rows]
    out = dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame(full, DOCS), folder)
    if name != "byte_bpe":
        assert out.dtypes == spark.createDataFrame([], DOCS).dtypes
    return out.collect()


def test_stages_on_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    spark.createDataFrame([(i, 1, i % 2) for i in range(4)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    a, b = prose(80), prose(80)
    rows = [(5, a), (5, b), (6, b), (7, b), (7, b), (None, b), (None, prose(50)), (8, ""), (9, None), (10, prose(60)), (10, prose(60))]
    for name in ("toxicity", "line_dedup", "simhash", "mixing", "byte_bpe"):
        assert stage(spark, name, [], str(tmp_path)) == []
    kept = sorted((str(r["doc_id"]), r["text"]) for r in stage(spark, "simhash", rows, str(tmp_path)))
    # Each row by its own text: both texts of id 5 are first of their groups, nulls and blanks are one group.
    want = [(5, a), (5, b), rows[6], rows[7], rows[9], rows[10]]
    assert kept == sorted((str(i), t) for i, t in want)
    lines = stage(spark, "line_dedup", rows, str(tmp_path))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in lines if r["doc_id"] is None) == sorted((str(i), t) for i, t in rows if i is None)
    assert {(r["doc_id"], r["text"]) for r in lines} >= {(5, a), (5, b), (8, ""), (9, None)} and not [r for r in lines if r["doc_id"] in (6, 7)]
    assert all(r["n_chars"] == len(r["text"] or "") and r["kept_text"] == "x" and r["simhash_mark"] == "z" for r in lines)
    assert len(stage(spark, "toxicity", rows, str(tmp_path))) in (0, len(rows))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
