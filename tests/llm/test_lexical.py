"""Ranked search against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basalt.llm import lexical
from basalt.llm.lexical import Queries, Shard, Tree, bisect, build_index, numbered, ranked_search, shard_rows, visit

DOCS = "doc_id long, text string, n long, terms string, shard string, leaf string"
ITEMS = "item_id string, text string, query int"


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, nearest=20):
    held = [(d, Counter(w), len(w)) for d, t in docs if (w := terms(t))]
    n, total = len(held), sum(size for *_, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, counts, size in held:
            m = 75 + 25 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in terms(text) if counts[t])
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:nearest], 1)]
    return sorted(out, key=str)


def made(seed, n=700):
    rng = random.Random(seed)
    topics = [[f"t{k}w{j}" for j in range(40)] for k in range(6)]
    common = ["The", "of", "é", "7", "zu"]
    draw = lambda k, size: " ".join(rng.choice(topics[k] if rng.random() < 0.6 else common) for _ in range(size))
    docs = [(k, draw(k % 6, rng.randrange(1, 60))) for k in range(n)]
    docs += [(2000 + k, docs[7][1]) for k in range(300)]
    docs += [(None, docs[7][1]), (5, docs[9][1]), (5, docs[9][1]), (3000, None), (3001, ""), (3002, " -- "), (3003, docs[3][1] + " of" * 3000)]
    items = [(f"i{k}", draw(k % 6, rng.randrange(1, 30))) for k in range(25)]
    items += [("i3", docs[7][1]), (None, "of the of"), ("none", None), ("odd", "!!"), ("unknown", "nowhere"), ("t", "T0W3 t0w3")]
    return docs, items


def tables(spark, docs, items):
    return spark.createDataFrame([(*d, *[None] * 4) for d in docs], DOCS), spark.createDataFrame([(*i, 0) for i in items], ITEMS)


@pytest.mark.parametrize("seed", [1, 2])
def test_search_equals_plain_scores(spark, seed):
    docs, items = made(seed)
    frame, asked = tables(spark, docs, items)
    got = ranked_search(frame.repartition(7), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_few_documents_blocks_and_empty_tables(spark, monkeypatch):
    docs, items = made(3, 12)
    docs = docs[:9]
    frame, asked = tables(spark, docs, items)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, ranked_search(frame, asked).collect()), key=str) == plain(docs, items)
    assert ranked_search(frame.limit(0), asked).count() == 0
    assert ranked_search(frame, asked.limit(0)).count() == 0
    assert ranked_search(frame.where("doc_id < 0"), asked).count() == 0


def test_bisection_brings_like_documents_together():
    rng = random.Random(4)
    n, topics = 512, 8
    kind = [rng.randrange(topics) for _ in range(n)]
    doc, term = zip(*[(d, kind[d] * 30 + rng.randrange(30)) for d in range(n) for _ in range(20)])
    doc, term = np.array(doc), np.array(term)
    order, borders, _ = bisect(doc, term, n, topics * 30, None, 64)
    assert sorted(order.tolist()) == list(range(n)) and np.diff(borders).max() <= 64
    kinds = lambda order: np.mean([len({kind[d] for d in order[a:b].tolist()}) for a, b in zip(borders, borders[1:])])
    assert kinds(order) < 0.5 * kinds(np.arange(n))


def test_tree_leads_like_documents_to_one_leaf():
    rng = random.Random(5)
    rows = [[f"{k % 4}.{rng.randrange(30)}".encode() for _ in range(25)] for k in range(800)]
    tree = Tree.unpack(Tree.fit([list(dict.fromkeys(r)) for r in rows], 2).pack())
    leaves = tree.leaves(rows)
    assert np.mean([Counter(leaves[k::4].tolist()).most_common(1)[0][1] / 200 for k in range(4)]) > 0.9
    assert abs(tree.shares.sum() - 1) < 1e-9
    assert Tree.fit([[b"x"]], 3).leaves([[b"y"], []]).tolist() == [0, 0]


def test_shards_out_of_reach_are_not_visited_and_none_is_missed():
    docs, items = made(6)
    held = [(d, t) for d, t in docs if terms(t) and d is not None]
    counted = [Counter(terms(t)) for _, t in held]
    n, total = len(held), sum(sum(c.values()) for c in counted)
    numbers = {}
    group = [(d, sum(c.values()), numbered([t.encode() for t in c], numbers), np.array(list(c.values()), np.int32)) for (d, _), c in zip(held, counted)]
    lexical_docs, lexical.SHARD_DOCS = lexical.SHARD_DOCS, 16
    try:
        rows = list(shard_rows(group, numbers, "g", n, total))
    finally:
        lexical.SHARD_DOCS = lexical_docs
    texts = [(name, t) for name, t in items if t]
    queries = Queries([t.encode() for _, t in texts])
    df = Counter(t for c in counted for t in c)
    queries.weigh(np.array([df[t.decode()] for t in queries.vocabulary]), n)
    shards = [Shard({**r, "terms": pa.array(r["terms"], pa.binary())}, queries) for r in rows]
    for s in shards:
        s.bounds = queries.bounds(s.places, s.best)
    results, least = [None] * queries.size, np.zeros(queries.size, np.int64)
    made_visits = visit(shards, queries, least, results, 20)
    assert made_visits < 0.6 * len(shards) * queries.size
    got = [(texts[q][0], rank, int(d), int(s)) for q, r in enumerate(results) if r is not None for rank, (d, s) in enumerate(zip(*r), 1)]
    assert sorted(got, key=str) == plain([h for h in held], texts)


def test_every_document_is_in_one_shard(spark):
    docs, _ = made(8)
    index = build_index(tables(spark, docs, [])[0].repartition(5))
    ids = [int(x) for r in index.shards.select("ids").collect() for x, named in zip(*np.frombuffer(r["ids"], np.int64).reshape(2, -1)) if named]
    assert sorted(ids) == sorted(d for d, t in docs if d is not None and terms(t))
