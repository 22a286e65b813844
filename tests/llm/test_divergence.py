"""The divergence audit against plain sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from basalt.llm import divergence
from basalt.llm.divergence import divergence_audit

DOCS = "doc_id long, text string, lang string, source string, n long, g long, h long, value string, term string, base string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, *[None] * 6) for i, (lang, s, t) in enumerate(rows)], DOCS)


def plain(rows):
    docs = [(lang or "", s or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for lang, s, t in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        df, total, own = Counter(), Counter(), defaultdict(Counter)
        for other, source, terms in docs:
            if other == lang:
                df.update(set(terms))
                total.update(terms)
                own[source].update(terms)
        kept = [t for t in df if df[t] >= 3]

        def p(counts):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // size for t in kept}

        q, probs = p(total), {s: p(c) for s, c in own.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = [(sum(f(probs[s][t], probs[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(probs[s][t], q[t]), t) for t in kept if own[s][t] and probs[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found if part == "pair" else found[:200], 1):
                    out[lang, s, part, item] = (value, rank)
    return out


def audit(spark, rows):
    got = divergence_audit(table(spark, rows)).collect()
    assert len({(r["lang"], r["source"], r["part"], r["item"]) for r in got}) == len(got)
    return {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in got}


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_plain_sums(spark, seed, monkeypatch):
    """Small tiles, so that several meet; heavy and light terms, many sources, hot ones, ties."""
    monkeypatch.setattr(divergence, "TILE_GROUPS", 3)
    monkeypatch.setattr(divergence, "TILE_TERMS", 5)
    rng = random.Random(seed)
    common = ["the", "und", "Née", "LA", "x"]
    words = [f"{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    rows = []
    for k in range(260):
        source = "hot" if k % 3 == 0 else f"s{k % 13}"
        lang = rng.choice(["en", "de", None])
        mine = words[(hash(source) % 7) * 5 :][:12]
        rows.append((lang, source, " ".join(rng.choice(common + mine + words[:3]) for _ in range(rng.randrange(0, 60)))))
    rows += [("en", "silent", None), ("en", None, "the 12 the"), ("fr", "alone", "a a a"), ("fr", "alone", "a"), ("es", "a", "q"), ("es", "b", "r")]
    rows += [rows[5]] * 3
    assert audit(spark, rows) == plain(rows)


def test_counts_of_long_texts_and_flushes(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(divergence, "PIECE", 1000)
    words = ["w" + "abcdefghij"[k % 10] + "abcdefghij"[k // 10 % 10] for k in range(100)]
    texts = [" ".join(words[j % (60 + k)] for j in range(5000)) for k in range(8)] + ["é" * 5000] * 3 + [""]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 12, "source": [f"s{k % 2}" for k in range(12)], "text": pa.array([t.encode() for t in texts], pa.binary())})
    n, docs, parts = Counter(), Counter(), 0
    for part in divergence._count_terms(iter([batch, batch])):
        parts += 1
        for r in part.to_pylist():
            n[r["source"], r["term"]] += r["n"]
            docs[r["source"], r["term"]] += r["docs"]
    assert parts > 4
    want_n, want_docs = Counter(), Counter()
    for k, text in enumerate(texts * 2):
        terms = text.encode().split()
        want_n.update((f"s{k % 2}", t) for t in terms)
        want_docs.update((f"s{k % 2}", t) for t in {*terms})
    assert +n == want_n and +docs == want_docs and ("s1", b"") in n


def test_empty_table(spark):
    assert audit(spark, []) == {}


def test_pieces_keep_words_whole(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = b"aa bbb cccccccccccccccc d e ff " * 20
    assert [w for part in divergence.pieces(text, divergence._LETTERS) for w in part] == text.split()
