"""Ranked lexical search over a clustered index.

Recursive graph bisection puts documents of like terms next to each other: a tree fitted on a
bounded sample leads every document to a group of a few thousand, and each group is bisected in full
down to shards of ``SHARD_DOCS`` documents. A shard is one row: its inverted lists and, for each
term, the most that any of its documents scores by it. A query is asked of the shards with the
highest bounds first; every other shard is visited only while its bound reaches the worst result
kept, so that what is left out cannot be among the results.
"""

from __future__ import annotations

import io
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import cut, settings
from basalt.llm.divergence import pieces

#: Results of a query.
NEAREST = 20
#: Documents that the tree is fitted on at most, terms of each (those of the least hashes), documents
#: of the sample that a term is in at least, and levels of the tree.
SAMPLE, SAMPLE_TERMS, SAMPLE_DOCS, LEVELS = 8192, 64, 4, 5
#: Documents of a group that is bisected in full, about; its postings at most but for one document.
GROUP_DOCS, GROUP_POSTINGS = 2048, 1 << 19
#: Rows that a task turns into Python objects at once.
STRIP = 1024
#: Documents of a shard at most, and rounds of exchanges at each level of a bisection.
SHARD_DOCS, ROUNDS = 256, 4
#: Shards that every query is asked of first, to learn how good a result must be.
FIRST_SHARDS = 2
#: Bytes of queries that are sent to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Shards that a task holds at once while it reads the index (each has some hundred KB), and bytes of
#: the index's row groups.
SHARDS_HELD, ROW_GROUP = 32, 16 << 20

_TERMS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 0x20 if chr(b).isupper() else 0x20 for b in range(256))

INDEX = "shard string, ids binary, terms array<binary>, df binary, best binary, docs binary, impact binary"


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a whole text."""
    found: Counter = Counter()
    for words in pieces(text, _TERMS):
        found.update(words)
    return found


def forward_rows(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, terms, tf) of the documents with terms: their number with repeats, the
    different terms joined by spaces, and how often each occurs as 32-bit integers (a text has fewer
    than 2**31 bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, STRIP) for whole in batches for k in range(0, whole.num_rows, STRIP)):
            ids, sizes, terms, counts = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if found := term_counts(text.as_py()):
                    ids.append(doc)
                    tf = np.fromiter(found.values(), np.int32, len(found))
                    sizes.append(found.total())
                    terms.append(b" ".join(found))
                    counts.append(tf.tobytes())
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()), "terms": pa.array(terms, pa.binary()), "tf": pa.array(counts, pa.binary())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    return texts.mapInArrow(run, "doc_id long, n long, terms binary, tf binary")


# -- Bisection -------------------------------------------------------------------------------


def bisect(doc: np.ndarray, term: np.ndarray, n_docs: int, n_terms: int, levels: int | None, least: int, rounds: int = ROUNDS):
    """Recursive graph bisection of the edges (doc, term): the documents in their new order, the
    borders of the last parts, and for each level what a term speaks for the right half of each
    part, log2((right + 1) / (left + 1)).

    At each level every part is halved; documents of both halves are then exchanged in pairs, the
    most gainful first, as long as the logarithmic cost of the term degrees falls. With ``levels``
    there are so many; without, parts are halved while one has more than ``least`` documents."""
    order, borders, voices = np.arange(n_docs), np.array([0, n_docs]), []
    while len(voices) < levels if levels is not None else np.diff(borders).max() > least:
        start, stop = borders[:-1], borders[1:]
        middle, parts = (start + stop) // 2, len(start)
        part = np.repeat(np.arange(parts), stop - start)
        side = np.arange(n_docs) >= middle[part]
        pairs = middle - start
        one = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs) + np.repeat(start, pairs)
        two = one + np.repeat(pairs, pairs)
        log_left, log_right = np.log2(np.maximum(pairs, 1)), np.log2(np.maximum(stop - middle, 1))
        at, right = np.empty(n_docs, np.int64), np.empty(n_docs, bool)
        at[order] = part
        # Documents stay in their part for all rounds of a level: so do the degrees' places. A term
        # that one document of the part has costs as much on either side.
        keys, cell, whole = np.unique(at[doc] * n_terms + term, return_inverse=True, return_counts=True)
        shared = whole > 1
        live = shared[cell]
        seats = (np.cumsum(shared) - 1).astype(np.int32)
        own, cell, keys, whole = doc[live], seats[cell[live]], keys[shared], whole[shared]
        del live, seats, shared
        log_left, log_right = log_left[keys // n_terms], log_right[keys // n_terms]
        cost = lambda d, log_n: d * (log_n - np.log2(d + 1.0))
        for turn in range(rounds + 1):
            right[order] = side
            on_right = right[own]
            r = np.bincount(cell[on_right], minlength=len(keys))
            left = whole - r
            if turn == rounds:
                break
            now = cost(left, log_left) + cost(r, log_right)
            to_right = now - cost(np.maximum(left - 1, 0), log_left) - cost(r + 1, log_right)
            to_left = now - cost(left + 1, log_left) - cost(np.maximum(r - 1, 0), log_right)
            gain = np.bincount(own, np.where(on_right, to_left[cell], to_right[cell]), n_docs)
            order = order[np.lexsort((-gain[order], side, part))]
            swap = gain[order[one]] + gain[order[two]] > 1e-9
            a, b = one[swap], two[swap]
            order[a], order[b] = order[b], order[a]
            if not len(a):
                break
        if levels is None:
            voices.append(None)
            borders = np.unique(np.concatenate([start, middle, [n_docs]]))
        else:
            voice = np.zeros(parts * n_terms, np.float32)
            voice[keys] = np.log2((r + 1.0) / (left + 1.0))
            voices.append(voice.reshape(parts, n_terms))
            borders = np.append(np.stack([start, middle], 1).reshape(-1), n_docs)
    return order, borders, voices


def _edges(rows: list[list[bytes]], numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of all terms that have a number."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    known = np.fromiter((x for row in rows for x in map(numbers.get, row, repeat(-1))), np.int64, int(sizes.sum()))
    of = np.repeat(np.arange(len(rows)), sizes)
    return of[known >= 0], known[known >= 0]


class Tree:
    """The upper levels of the bisection, fitted on a sample."""

    def __init__(self, terms: list[bytes], voices: list[np.ndarray], shares: np.ndarray) -> None:
        self.numbers = {t: k for k, t in enumerate(terms)}
        self.voices, self.shares = voices, shares

    @classmethod
    def fit(cls, rows: list[list[bytes]], levels: int = LEVELS) -> Tree:
        from xxhash import xxh64_intdigest

        some = [sorted(row, key=lambda t: (xxh64_intdigest(t), t))[:SAMPLE_TERMS] for row in rows]
        held = Counter(t for row in some for t in row)
        terms = sorted(t for t, n in held.items() if n >= SAMPLE_DOCS)
        tree = cls(terms, [], np.zeros(0))
        # Rows of like least terms start out together.
        some.sort()
        doc, term = _edges(some, tree.numbers)
        if terms:
            tree.voices = bisect(doc, term, len(some), len(terms), levels, 0)[2]
        tree.shares = np.bincount(tree.leaves(rows), minlength=1 << len(tree.voices)) / max(1, len(rows))
        return tree

    def leaves(self, rows: list[list[bytes]]) -> np.ndarray:
        """The leaf that each row's terms lead to."""
        leaves = [np.zeros(0, np.int64)]
        for k in range(0, len(rows), STRIP):
            doc, term = _edges(rows[k : k + STRIP], self.numbers)
            at = np.zeros(len(rows[k : k + STRIP]), np.int64)
            for voice in self.voices:
                at = 2 * at + (np.bincount(doc, voice[at[doc], term], len(at)) >= 0)
            leaves.append(at)
        return np.concatenate(leaves)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, terms=np.frombuffer(b" ".join(self.numbers), np.uint8), shares=self.shares, **{f"v{k}": v for k, v in enumerate(self.voices)})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        held = np.load(io.BytesIO(data))
        return cls(held["terms"].tobytes().split(), [held[f"v{k}"] for k in range(len(held.files) - 2)], held["shares"])


def sampled(forward: DataFrame, n_docs: int) -> DataFrame:
    """Rows (h, terms) of at most ``SAMPLE`` of the ``n_docs`` documents, those of the least hashes.

    Hashes are spread evenly: all but those under a bound that twice the sample stays below are left
    out where they are read. A task would otherwise send as many rows as the whole sample has."""
    hashed = forward.select(F.xxhash64("doc_id", "terms").alias("h"), "terms")
    if n_docs > 2 * SAMPLE:
        hashed = hashed.where(F.col("h") < -(2**63) + 2**64 // n_docs * 2 * SAMPLE)
    return hashed.orderBy("h").limit(SAMPLE)


def fit_tree(forward: DataFrame, n_docs: int) -> Tree:
    """The tree of a sample of the ``n_docs`` documents (one at least), made in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A term that many documents share is one object.
        known: dict[bytes, bytes] = {}
        rows = [[known.setdefault(t, t) for t in text.as_py().split()] for batch in batches for text in batch.column(1)]
        known.clear()
        yield pa.RecordBatch.from_pydict({"tree": pa.array([Tree.fit(rows).pack()] if rows else [], pa.binary())})

    fit = lambda n: sampled(forward, n).coalesce(1).mapInArrow(run, "tree binary").first()
    # Rows that repeat a few documents may all have hashes above the bound.
    return Tree.unpack((fit(n_docs) or fit(0))["tree"])


# -- Index -----------------------------------------------------------------------------------


def numbered(terms: list[bytes], numbers: dict[bytes, int]) -> np.ndarray:
    """The numbers of ``terms``, new ones given to those that have none yet."""
    return np.fromiter((numbers.setdefault(t, len(numbers)) for t in terms), np.int32, len(terms))


def shard_rows(rows: list[tuple[int | None, int, np.ndarray, np.ndarray]], numbers: dict[bytes, int], name: str, n_docs: int, n_words: int) -> Iterator[dict]:
    """The shards of one group of documents (id, n, numbers of the terms, tf)."""
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
    term, tf = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows]).astype(np.int64)
    m = np.array([75 + 25 * n * n_docs // n_words for _, n, _, _ in rows], np.int64)
    impact = (1_000_000_000 * tf // (1000 * tf + 12 * m[doc])).astype(np.int32)
    del tf
    order, borders, _ = bisect(doc, term, len(rows), len(numbers), None, SHARD_DOCS)
    place = np.empty(len(rows), np.int64)
    place[order] = np.arange(len(rows))
    shard = np.searchsorted(borders, place[doc], "right") - 1
    by = np.lexsort((place[doc], term, shard))
    doc, term, impact, shard = doc[by], term[by], impact[by], shard[by]
    names = list(numbers)
    # Ids, and below them whether they are there at all.
    ids = np.array([(0 if r[0] is None else r[0], r[0] is not None) for r in rows], np.int64)[order]
    for k, (low, high) in enumerate(zip(np.searchsorted(shard, np.arange(len(borders) - 1)), np.searchsorted(shard, np.arange(len(borders) - 1), "right"))):
        t = term[low:high]
        new = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        yield {
            "shard": f"{name}-{k}",
            "ids": ids[borders[k] : borders[k + 1]].T.tobytes(),
            "terms": [names[x] for x in t[new]],
            "df": np.diff(np.append(new, len(t))).astype(np.int32).tobytes(),
            "best": np.maximum.reduceat(impact[low:high], new).tobytes(),
            "docs": (place[doc[low:high]] - borders[k]).astype(np.uint16).tobytes(),
            "impact": impact[low:high].tobytes(),
        }


class Index(NamedTuple):
    """A table of shards and the totals its scores rest on."""

    shards: DataFrame
    n_docs: int
    n_words: int


def build_index(docs: DataFrame) -> Index:
    """The clustered index of all of ``docs`` (doc_id, text)."""
    forward = cut(forward_rows(docs))
    totals = forward.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_words = totals["n"], totals["l"] or 0
    spark = docs.sparkSession
    if not n_docs:
        return Index(spark.createDataFrame([], INDEX), 0, 0)
    tree = fit_tree(forward, n_docs)
    packed = spark.sparkContext.broadcast(tree.pack())
    salts = [max(1, math.ceil(n_docs * s / GROUP_DOCS)) for s in tree.shares.tolist()]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tree.unpack(packed.value)
        for batch in batches:
            for k in range(0, batch.num_rows, STRIP):
                part = batch.slice(k, STRIP)
                leaves = held.leaves([t.split() for t in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaves, pa.int32())], names=[*part.schema.names, "leaf"])

    routed = forward.mapInArrow(route, "doc_id long, n long, terms binary, tf binary, leaf int")
    salt = F.pmod(F.xxhash64("doc_id", "n", F.lit(7)), F.element_at(F.array(*map(F.lit, salts)), F.col("leaf") + 1))
    dealt = routed.withColumn("salt", salt.cast("int")).repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", "doc_id")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, numbers, size, group, part = [], {}, 0, None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal part
            for row in shard_rows(held, numbers, f"{group[0]}-{group[1]}-{part}", n_docs, n_words) if held else ():
                yield pa.RecordBatch.from_pylist([row], _ARROW_INDEX)
            part += 1
            held.clear()
            numbers.clear()

        for batch in (whole.slice(k, STRIP) for whole in batches for k in range(0, whole.num_rows, STRIP)):
            for doc, n, terms, tf, leaf, salted in zip(*(c.to_pylist() for c in batch.columns)):
                if (leaf, salted) != group or len(held) >= 2 * GROUP_DOCS or size >= GROUP_POSTINGS:
                    yield from flush()
                    part, group, size = (part if group == (leaf, salted) else 0), (leaf, salted), 0
                held.append((doc, n, numbered(terms.split(), numbers), np.frombuffer(tf, np.int32)))
                size += len(tf) // 4
        yield from flush()

    return Index(cut(dealt.mapInArrow(build, INDEX), group_bytes=ROW_GROUP), n_docs, n_words)


_ARROW_INDEX = pa.schema([("shard", pa.string()), ("ids", pa.binary()), ("terms", pa.list_(pa.binary())), ("df", pa.binary()), ("best", pa.binary()), ("docs", pa.binary()), ("impact", pa.binary())])


# -- Search ----------------------------------------------------------------------------------


class Queries:
    """The terms of a block of queries as numbers, each as often as its query has it."""

    def __init__(self, texts: list[bytes]) -> None:
        counted = [term_counts(t) for t in texts]
        self.size = len(texts)
        self.vocabulary = sorted({t for c in counted for t in c})
        numbers = {t: k for k, t in enumerate(self.vocabulary)}
        self.query = np.array([q for q, c in enumerate(counted) for _ in c], np.int64)
        self.term = np.array([numbers[t] for c in counted for t in c], np.int64)
        self.repeats = np.array([n for c in counted for n in c.values()], np.int64)
        self.starts = np.searchsorted(self.query, np.arange(self.size + 1))
        self.weight = np.zeros(len(self.term), np.int64)

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Give every term its weight from its document frequency."""
        w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
        self.weight = np.array(w, np.int64)[self.term] * self.repeats if len(w) else self.weight

    def places(self, terms: pa.Array) -> np.ndarray:
        """Where a shard's list has each term of the vocabulary; -1 where it has not."""
        found = pc.index_in(pa.array(self.vocabulary, pa.binary()), terms)
        return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def bounds(self, places: np.ndarray, best: np.ndarray) -> np.ndarray:
        """The most that a document of a shard can score, for every query. All sums are whole
        numbers under 2**53, so doubles hold them exactly."""
        top = np.where(places >= 0, best[places], 0)
        return np.bincount(self.query, self.weight * top[self.term], self.size).astype(np.int64)


class Shard:
    """One row of the index, opened."""

    def __init__(self, row: dict, queries: Queries) -> None:
        self.terms = row["terms"].values if isinstance(row["terms"], pa.ListScalar) else row["terms"]
        self.places = queries.places(self.terms)
        self.best = np.frombuffer(row["best"], np.int32)
        self.row = row

    def open(self) -> None:
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(self.row["df"], np.int32))])
        self.docs, self.impact = np.frombuffer(self.row["docs"], np.uint16), np.frombuffer(self.row["impact"], np.int32)
        self.ids, self.named = np.frombuffer(self.row["ids"], np.int64).reshape(2, -1)

    def top(self, queries: Queries, query: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the shard's best documents for one query."""
        at = slice(queries.starts[query], queries.starts[query + 1])
        places, weights = self.places[queries.term[at]], queries.weight[at]
        weights, places = weights[places >= 0], places[places >= 0]
        low, high = self.starts[places], self.starts[places + 1]
        which = np.concatenate([np.arange(a, b) for a, b in zip(low.tolist(), high.tolist())]) if len(low) else np.zeros(0, np.int64)
        scores = np.bincount(self.docs[which], self.impact[which] * np.repeat(weights, high - low), len(self.ids)).astype(np.int64)
        good = np.flatnonzero((scores > 0) & (self.named > 0))
        best = good[np.lexsort((self.ids[good], -scores[good]))[:nearest]]
        return self.ids[best], scores[best]


def _opened(batch: pa.RecordBatch, queries: Queries) -> list[Shard]:
    columns = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
    return [Shard({c: (v[row] if c == "terms" else v[row].as_py()) for c, v in columns.items()}, queries) for row in range(batch.num_rows)]


def visit(shards: list[Shard], queries: Queries, least: np.ndarray, results: list, nearest: int) -> int:
    """Ask ``shards``, highest bound first, and stop at the first that cannot reach the worst result
    kept. ``least`` holds each query's score to reach and rises; returns the visits made."""
    bounds = np.stack([s.bounds for s in shards], 1)
    made = 0
    for query in np.flatnonzero((bounds.max(1) >= least) & (bounds.max(1) > 0)).tolist():
        for k in np.argsort(-bounds[query], kind="stable").tolist():
            if bounds[query, k] < least[query] or bounds[query, k] <= 0:
                break
            if not hasattr(shards[k], "docs"):
                shards[k].open()
            ids, scores = shards[k].top(queries, query, nearest)
            made += 1
            if results[query] is not None:
                ids, scores = np.concatenate([results[query][0], ids]), np.concatenate([results[query][1], scores])
            best = np.lexsort((ids, -scores))[:nearest]
            results[query] = ids[best], scores[best]
            if len(best) == nearest:
                least[query] = max(least[query], int(scores[best[-1]]))
    return made


_HITS = "query int, doc_id long, score long"


def _hits(results: list) -> pa.RecordBatch:
    parts = [(q, *r) for q, r in enumerate(results) if r is not None and len(r[0])]
    column = lambda k: np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)])
    query = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]) if parts else np.zeros(0, np.int64)
    return pa.RecordBatch.from_pydict({"query": pa.array(query.astype(np.int32)), "doc_id": pa.array(column(1), pa.int64()), "score": pa.array(column(2), pa.int64())})


def search_index(index: Index, texts: list[bytes], nearest: int = NEAREST) -> DataFrame:
    """Rows (query, rank, doc_id, score): the best documents of each of a bounded block of query
    texts, numbered from 0, with exact scores.

    Readers and Arrow count rows, and these are large: a task would hold all shards of its part of
    the index. So few rows make a batch while the search runs, and its result is written."""
    few = str(SHARDS_HELD)
    with settings(index.shards.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=few, spark__sql__parquet__columnarReaderBatchSize=few):
        return cut(_found(index, texts, nearest))


def _found(index: Index, texts: list[bytes], nearest: int) -> DataFrame:
    spark = index.shards.sparkSession
    queries = Queries(texts)
    asked = spark.sparkContext.broadcast(queries)

    def degrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = asked.value
        df = np.zeros(len(q.vocabulary), np.int64)
        for batch in batches:
            for terms, own in zip(batch.column(0), batch.column(1)):
                places = q.places(terms.values)
                df += np.where(places >= 0, np.frombuffer(own.as_py(), np.int32)[places], 0)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.arange(len(df)), pa.int32()), "df": pa.array(df, pa.int64())})

    df = np.zeros(len(queries.vocabulary), np.int64)
    for r in index.shards.select("terms", "df").mapInArrow(degrees, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    queries.weigh(df, index.n_docs)
    weighed = spark.sparkContext.broadcast(queries)

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, names, kept = weighed.value, [], []
        for batch in batches:
            for row in range(batch.num_rows):
                names.append(batch.column(0)[row].as_py())
                kept.append(q.bounds(q.places(batch.column(1)[row].values), np.frombuffer(batch.column(2)[row].as_py(), np.int32)))
            bounds = np.stack(kept, 1)
            best = np.unique(np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST_SHARDS])
            names, kept = [names[k] for k in best], [kept[k] for k in best]
        if names:
            bounds = np.stack(kept, 1)
            query, k = np.nonzero(bounds)
            yield pa.RecordBatch.from_pydict({"query": pa.array(query, pa.int32()), "shard": pa.array([names[x] for x in k], pa.string()), "bound": pa.array(bounds[query, k], pa.int64())})

    found = index.shards.select("shard", "terms", "best").mapInArrow(promising, "query int, shard string, bound long")
    order = W.partitionBy("query").orderBy(F.desc("bound"), "shard")
    first = [r["shard"] for r in found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= FIRST_SHARDS).select("shard").distinct().collect()]

    def ask(least: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, reach, results = weighed.value, least.copy(), [None] * len(least)
            for batch in batches:
                shards = _opened(batch, q)
                for s in shards:
                    s.bounds = q.bounds(s.places, s.best)
                if shards:
                    visit(shards, q, reach, results, nearest)
            yield _hits(results)

        return run

    best = W.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = lambda hits: hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
    least = np.zeros(queries.size, np.int64)
    tried = ranked(index.shards.where(F.col("shard").isin(first)).mapInArrow(ask(least), _HITS)).where(F.col("rank") == nearest)
    for r in tried.collect():
        least[r["query"]] = r["score"]
    return ranked(index.shards.mapInArrow(ask(least), _HITS)).select("query", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) the documents
    with the highest scores above 0, at most ``nearest``, ties to the smaller doc_id.

    A null or empty text has no terms: such a document counts nowhere, such an item has no rows.
    Documents with a null doc_id count in all statistics but are not returned. A repeated document
    is one more; each row of items is ranked for itself, so rows that repeat an id repeat it in the
    result. Other columns play no part; an empty table on either side gives no rows. Items go to the
    tasks in blocks of about ``BLOCK_BYTES``, through the driver."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    rows = items.select("item_id", F.col("text").cast("binary").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    out = spark.createDataFrame([], schema)
    index = build_index(docs) if blocks else None
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        asked = part.orderBy("item_id", "text").collect()
        if not asked or not index.n_docs:
            continue
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(asked)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", kind)]))
        found = search_index(index, [bytes(r["text"]) for r in asked], nearest)
        out = out.unionByName(found.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, {_SQL_TERMS} AS w FROM benchmark),
n AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
words AS (SELECT DISTINCT unnest(w) AS t FROM i),
tf AS (SELECT r, doc_id, t, m, count(*) AS tf FROM (SELECT r, doc_id, unnest(w) AS t, 75 + (25 * len(w) * n) // l AS m FROM d, n WHERE len(w) > 0)
       SEMI JOIN words USING (t) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, n GROUP BY t, n),
s AS (
  SELECT q, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM (SELECT q, item_id, unnest(w) AS t FROM i) JOIN w USING (t) JOIN tf USING (t) WHERE doc_id IS NOT NULL GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) <= {NEAREST}
"""
