"""Suffix arrays and decontamination against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from basalt.llm import suffixes
from basalt.llm.suffixes import Items, SuffixArray, contamination_report, decontaminate, hits, longest_matches, with_matches

DOCS = "doc_id long, text string, leak string, items string, n_words string"
ITEMS = "item_id long, text string, spans string"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    windows = {}
    for name, text in items:
        w = words(text)
        k = min(len(w), window)
        for i in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if name is None else str(name))
    out = []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i : i + k])):
                    hit |= {*range(i, i + k)}
                    named |= found
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


def tables(spark, docs, items):
    return spark.createDataFrame([(*d, *["x"] * 3) for d in docs], DOCS), spark.createDataFrame([(*i, "x") for i in items], ITEMS)


def made(seed, n_docs=60, n_items=12):
    rng = random.Random(seed)
    vocabulary = [f"W{k}é" if k % 3 else f"w{k}" for k in range(9)]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 3, 5, 10, 11, 14, 30]))) for k in range(n_items)]
    items += [(3, text(12)), (None, text(15)), (90, None), (91, " .. "), (92, items[5][1])]
    docs = [(k, text(rng.randrange(0, 80))) for k in range(n_docs)]
    for k in range(0, n_docs, 4):
        source = items[rng.randrange(len(items))][1] or ""
        docs[k] = (k, text(rng.randrange(20)) + source + (docs[k][1] if k % 8 else ""))
    return docs + [(1, None), (None, docs[0][1]), (2, ""), docs[4], docs[4]], items


def test_suffix_array_is_sorted():
    rng = random.Random(3)
    parts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 40))] for _ in range(30)]
    parts += [parts[3]] * 5 + [[b"a"] * 50]
    array = SuffixArray(parts, 16)
    text = array.text[: array.size].tolist()
    got = [tuple(text[i : i + 16]) for i in array.order]
    assert got == sorted(tuple(text[i : i + 16]) for i in range(array.size)) and sorted(array.order) == list(range(array.size))


def test_longest_match_of_every_suffix_in_a_shard():
    rng = random.Random(4)
    draw = lambda n: [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(n)]
    parts = [draw(rng.randrange(1, 30)) for _ in range(20)]
    items = Items([("x", b" ".join(draw(25))), ("y", b"z a b"), ("w", b" ".join(parts[2] + parts[3]))])
    found = SuffixArray(parts, items.longest).search(items)
    for at in range(len(items.words)):
        suffix = items.words[at : items.stop[at]]
        best = max((k for part in parts for i in range(len(part)) for k in range(1, len(suffix) + 1) if part[i : i + k] == suffix[:k]), default=0)
        assert found.length[at] == best


@pytest.mark.parametrize("seed", range(4))
def test_report_equals_plain_search(spark, seed):
    docs, items = made(seed)
    got = sorted(map(tuple, contamination_report(*tables(spark, docs, items)).collect()), key=str)
    assert got == plain(docs, items)


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 150)
    docs, items = made(7)
    got = sorted(map(tuple, contamination_report(*tables(spark, docs, items)).collect()), key=str)
    assert got == plain(docs, items)


@pytest.mark.parametrize("size", [40, 64, 1000])
def test_very_long_texts_in_stretches(size, monkeypatch):
    """Windows across the borders of stretches and shards, spans without gaps or overlaps."""
    monkeypatch.setattr(suffixes, "STRETCH_BYTES", size)
    monkeypatch.setattr(suffixes, "SHARD_WORDS", 30)
    docs, items = made(9)
    docs += [(100, " ".join(t or "" for _, t in docs)), (101, "q" * 300 + " w3 " + (items[0][1] * 30))]
    sought = Items([("" if n is None else str(n), t.encode() if t else None) for n, t in items])
    got = []
    for (doc, _), (count, spans, named) in zip(docs, hits([t.encode() if t else None for _, t in docs], sought)):
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        got.append((doc, count, sum(b - a for a, b in spans), len(named), digest, bool(spans)))
    assert sorted(got, key=str) == plain(docs, items)


def test_affected_documents_go_and_columns_stay(spark):
    docs, items = made(2)
    frame, sought = tables(spark, docs, items)
    clean = [d for d in docs if not plain([d], items)[0][5]]
    left = decontaminate(frame, sought)
    assert left.columns == frame.columns
    assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=str) == sorted(clean, key=str)
    with pytest.raises(ValueError, match="leak"):
        with_matches(frame, sought)
    assert contamination_report(frame, sought.limit(0)).where("contaminated or n_items > 0").count() == 0
    assert contamination_report(frame.limit(0), sought).count() == 0


def test_longest_matches_and_their_places(spark):
    docs, items = made(5)
    docs = [d for d in docs if d[0] is not None]
    items = [(k, t) for k, (_, t) in enumerate(items)]
    got = {(r["item_id"], r["word"]): (r["n_matched"], r["doc_id"], r["doc_word"]) for r in longest_matches(*(t.repartition(5) for t in tables(spark, docs, items))).collect()}
    split = [(d, words(t)) for d, t in docs]
    want = {}
    for name, text in items:
        w = words(text)
        for at in range(len(w)):
            best = None
            for d, t in split:
                for i in range(len(t)):
                    k = 0
                    while at + k < len(w) and i + k < len(t) and w[at + k] == t[i + k]:
                        k += 1
                    if k and (best is None or (-k, d, i) < best):
                        best = (-k, d, i)
            if best:
                want[str(name), at] = (-best[0], best[1], best[2])
    assert got == want
    assert np.mean([x[0] for x in got.values()]) > 2
