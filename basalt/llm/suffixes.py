"""Benchmark decontamination: suffix arrays over the training words, searched by every test suffix.

Each task cuts its documents into shards of about a million words and sorts their suffixes. Every
suffix of every test item is searched in every shard: its neighbours there give the longest verbatim
match, the ranges of its windows all places where they occur. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Consecutive words of an item that make a window; a shorter item is one window.
WINDOW = 10
#: Words of a shard, and bytes of one text that go into a shard at once: with both, a shard has
#: fewer than two million different words, so that three of their numbers fit into 64 bits.
SHARD_WORDS, STRETCH_BYTES = 1 << 20, 1 << 21
#: Bytes of items that are sent to the tasks at once; more items are sought in further passes.
BLOCK_BYTES = 8 << 20

_WORDS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 0x20 if chr(b).isupper() else 0x20 for b in range(256))

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string()))])


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and anything beyond ASCII."""
    return (text or b"").translate(_WORDS).split()


class Items:
    """The words of test items in one row, with the windows that start at each place."""

    def __init__(self, rows: list[tuple[str, bytes | None]], window: int = WINDOW) -> None:
        parts = [(name, found) for name, text in rows if (found := words_of(text))]
        self.names = [name for name, _ in parts]
        self.words = [w for _, found in parts for w in found]
        sizes = np.array([len(found) for _, found in parts], np.int64)
        stops = np.cumsum(sizes)
        self.item = np.repeat(np.arange(len(parts)), sizes)
        self.stop = np.repeat(stops, sizes)
        self.offset = np.arange(len(self.words)) - np.repeat(stops - sizes, sizes)
        left = self.stop - np.arange(len(self.words))
        whole = np.repeat(sizes, sizes)
        #: Words of the window at each place; 0 where none starts.
        self.window = np.where(left >= window, window, np.where((whole < window) & (self.offset == 0), whole, 0))
        self.longest = int(sizes.max(initial=0))
        self.widest = int(self.window.max(initial=0))


class Matches(NamedTuple):
    """Of each test suffix: words of its longest match, a place of it, and the range of the suffix
    array that holds its window."""

    length: np.ndarray
    place: np.ndarray
    low: np.ndarray
    high: np.ndarray


class SuffixArray:
    """The suffixes of a row of words, in order up to ``depth`` words. Stretches are set apart by
    the number 0, which no word has."""

    def __init__(self, stretches: list[list[bytes]], depth: int) -> None:
        numbers: dict[bytes, int] = {}
        for words in stretches:
            numbers.update(dict.fromkeys(words, 0))
        for at, word in enumerate(numbers, 1):
            numbers[word] = at
        self.numbers = numbers
        total = sum(map(len, stretches)) + len(stretches)
        text = np.zeros(total + 3, np.int64)
        at = 0
        for words in stretches:
            text[at : at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            at += len(words) + 1
        self.text, self.size = text, total
        #: A word that the shard lacks comes after all others.
        self.unknown = len(numbers) + 1
        base = self.unknown + 1
        if base > 2_000_000:
            raise ValueError("a shard holds too many different words for keys of three")
        self.base = base
        keys = (text[:total] * base + text[1 : total + 1]) * base + text[2 : total + 2]
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self._sort(depth)

    def _sort(self, depth: int) -> None:
        """Prefix doubling from three words on, over tied suffixes only."""
        new = np.concatenate([[True], self.keys[1:] != self.keys[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(self.size), 0))
        rank = np.empty(self.size + 1, np.int64)
        rank[self.order] = first
        rank[self.size] = -1
        alone = new & np.concatenate([new[1:], [True]])
        tied, known = np.flatnonzero(~alone), 3
        while known < depth and len(tied):
            some = self.order[tied]
            key = rank[some] * (self.size + 1) + rank[np.minimum(some + known, self.size)] + 1
            turn = np.argsort(key, kind="stable")
            key, some = key[turn], some[turn]
            self.order[tied] = some
            new = np.concatenate([[True], key[1:] != key[:-1]])
            rank[some] = np.maximum.accumulate(np.where(new, tied, 0))
            tied = tied[~(new & np.concatenate([new[1:], [True]]))]
            known *= 2

    def _common(self, query: np.ndarray, starts: np.ndarray, stops: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Words that each query from start to stop has in common with the text at its place."""
        same = np.zeros(len(starts), np.int64)
        live = np.flatnonzero((starts < stops) & (places < self.size))
        while len(live):
            q, t = starts[live] + same[live], places[live] + same[live]
            live = live[query[q] == self.text[t]]
            same[live] += 1
            live = live[starts[live] + same[live] < stops[live]]
        return same

    def _bound(self, query: np.ndarray, starts: np.ndarray, stops: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
        """Binary search: the first suffix not before the query or, ``after``, beyond all that begin with it."""
        low, high = low.copy(), high.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) // 2
            places, s, e = self.order[mid], starts[live], stops[live]
            same = self._common(query, s, e, places)
            ended = s + same == e
            less = np.where(ended, after, self.text[places + same] < query[np.minimum(s + same, len(query) - 1)])
            low[live] = np.where(less, mid + 1, low[live])
            high[live] = np.where(less, high[live], mid)
            live = live[low[live] < high[live]]
        return low

    def _query(self, items: Items) -> np.ndarray:
        """The items' words as this shard's numbers."""
        count = len(items.words)
        query = np.zeros(count + 3, np.int64)
        query[:count] = np.fromiter((self.numbers.get(w, self.unknown) for w in items.words), np.int64, count)
        return query

    def ranges(self, items: Items, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in order the suffixes stand that begin with so many words of the items from each start."""
        query, zero = self._query(items), np.zeros(len(starts), np.int64)
        low = self._bound(query, starts, starts + lengths, zero, zero + self.size, False)
        return low, self._bound(query, starts, starts + lengths, low, zero + self.size, True)

    def search(self, items: Items) -> Matches:
        """Every suffix of every item."""
        count, query = len(items.words), self._query(items)
        starts = np.arange(count)
        one, two, three = (np.where(starts + k < items.stop, query[np.minimum(starts + k, count)], 0) for k in range(3))
        key = (one * self.base + two) * self.base + three
        low = np.searchsorted(self.keys, key, "left")
        inside = items.stop - starts >= 3
        high = np.where(inside, np.searchsorted(self.keys, key, "right"), low)
        at = self._bound(query, starts, items.stop, low, high, False)
        length, place = np.zeros(count, np.int64), np.full(count, -1)
        for beside in (at - 1, at):
            there = self.order[np.clip(beside, 0, self.size - 1)]
            same = np.where((beside >= 0) & (beside < self.size), self._common(query, starts, items.stop, there), 0)
            place = np.where(same > length, there, place)
            length = np.maximum(length, same)
        window_low, window_high = np.zeros(count, np.int64), np.zeros(count, np.int64)
        full = np.flatnonzero((items.window > 0) & (length >= items.window))
        if len(full):
            k = items.window[full]
            key = np.where(k >= 3, key[full], np.where(k == 2, (one[full] * self.base + two[full]) * self.base, one[full] * self.base * self.base))
            above = np.where(k >= 3, key, key + np.where(k == 2, self.base, self.base * self.base) - 1)
            lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, above, "right")
            window_low[full] = self._bound(query, full, full + k, lo, hi, False)
            window_high[full] = self._bound(query, full, full + k, lo, hi, True)
        return Matches(length, place, window_low, window_high)


class Stretch(NamedTuple):
    """Words of one text that share a shard; those from ``own`` to ``stop`` count here, the others
    are only their surroundings. ``at`` is the number of the first word within the text."""

    row: int
    at: int
    own: int
    stop: int
    words: list[bytes]


def stretches(row: int, text: bytes | None, before: int, behind: int) -> Iterator[Stretch]:
    """A text in one stretch, or a very long one in several with the words around them."""
    clean = (text or b"").translate(_WORDS)
    if len(clean) <= STRETCH_BYTES:
        words = clean.split()
        yield Stretch(row, 0, 0, len(words), words)
        return
    tail = re.compile(rb"(?: *[^ ]+){0,%d}" % behind)
    start, done, left = 0, 0, []
    while start < len(clean):
        stop = clean.find(b" ", start + STRETCH_BYTES)
        stop = len(clean) if stop < 0 else stop
        own = clean[start:stop].split()
        right = clean[stop : tail.match(clean, stop).end()].split()
        yield Stretch(row, done - len(left), len(left), len(left) + len(own), [*left, *own, *right])
        done += len(own)
        left = [*left, *own][-before:] if before else []
        start = stop


def shards(texts: list[bytes | None], items: Items, behind: int) -> Iterator[list[Stretch]]:
    """Stretches of all texts in shards of about ``SHARD_WORDS`` words."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for part in stretches(row, text, max(0, items.widest - 1), behind):
            held.append(part)
            size += len(part.words)
            if size >= SHARD_WORDS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after the other, and which range each is of."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which], which


def united(one: list[tuple[int, int]], two: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two lists of spans in order, laid over each other."""
    out: list[list[int]] = []
    for start, stop in sorted([*one, *two]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def hits(texts: list[bytes | None], items: Items) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """(words, spans of hit words, items with occurring windows) of every text."""
    counts = [0] * len(texts)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    named: list[set[str]] = [set() for _ in texts]
    for shard in shards(texts, items, max(0, items.widest - 1)):
        for part in shard:
            counts[part.row] += part.stop - part.own
        if not items.words or not any(part.words for part in shard):
            continue
        array = SuffixArray([part.words for part in shard], items.widest)
        found = array.search(items)
        full = np.flatnonzero(found.high > found.low)
        if not len(full):
            continue
        # Windows of the same words have the same range: their places are taken once.
        keys, which = np.unique(np.stack([found.low[full], found.high[full], items.window[full]], 1), axis=0, return_inverse=True)
        which = which.reshape(-1)
        at, of = _ranges(keys[:, 0], keys[:, 1])
        places = array.order[at]
        marks = np.bincount(places, minlength=array.size + 1) - np.bincount(places + keys[of, 2], minlength=array.size + 1)
        starts = np.cumsum([0, *(len(part.words) + 1 for part in shard)])
        stretch = np.searchsorted(starts, places, "right") - 1
        seen = np.unique(stretch * len(keys) + of)
        holders: list[set[str]] = [set() for _ in keys]
        for window, item in zip(which.tolist(), items.item[full].tolist()):
            holders[window].add(items.names[item])
        for key in seen.tolist():
            named[shard[key // len(keys)].row] |= holders[key % len(keys)]
        hit = np.cumsum(marks[: array.size]) > 0
        for k in np.unique(stretch).tolist():
            part = shard[k]
            own = hit[starts[k] + part.own : starts[k] + part.stop]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).reshape(-1, 2) + part.at + part.own
            if len(edges):
                spans[part.row] = united(spans[part.row], [(int(a), int(b)) for a, b in edges])
    return list(zip(counts, spans, named))


def item_blocks(items: DataFrame) -> Iterator[list[tuple[str, bytes | None]]]:
    """(id as text, text) of the items, at most about ``BLOCK_BYTES`` at a time on the driver."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"], bytes(r["text"])) for r in part.orderBy("item", "text").collect()]


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def with_matches(docs: DataFrame, items: DataFrame, column: str = "leak", text: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with one more: struct (n_words, spans, items) of the words
    that occurrences of the items' windows cover, as spans of word numbers, and of those items' ids
    as texts.

    A null or empty text has no words; an item without words has no windows; a null item_id reads
    as the empty string; items that repeat an id count once. Texts of any length are searched whole;
    repeated rows are searched like any others; an empty table of items finds nothing. ``column``
    must not be one of the columns of ``docs``. Items are sent to the tasks in blocks of at most
    ``BLOCK_BYTES``, each searched by a further pass over the rows within the same tasks."""
    place, context = docs.columns.index(text), docs.sparkSession.sparkContext
    if column.lower() in map(str.lower, docs.columns):
        raise ValueError(f"there is a column {column} already")
    empty = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast(FOUND["spans"].dataType).alias("spans"), F.array().cast("array<string>").alias("items"))
    done = docs.withColumn(column, empty)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, FOUND)])
    for block in [*item_blocks(items)] or [[]]:
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sought = Items(sent.value, window)
            for batch in batches:
                texts = batch.column(place).cast(pa.binary()).to_pylist()
                before = batch.column(batch.num_columns - 1)
                spans, names = before.field(1), before.field(2)
                out = []
                for row, (count, own, named) in enumerate(hits(texts, sought)):
                    if len(spans[row]):
                        own = united([(x["start"], x["stop"]) for x in spans[row].as_py()], own)
                    out.append({"n_words": count, "spans": [{"start": a, "stop": b} for a, b in own], "items": sorted(named | {*names[row].as_py()})})
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, _ARROW_FOUND)], names=batch.schema.names)

        done = done.mapInArrow(run, schema)
    return done


def longest_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows (item_id, word, n_matched, doc_id, doc_word): of every test suffix, named by its item and
    its first word's number, the longest verbatim match in any document and where one is, the
    smallest doc_id and word first. Suffixes whose first word occurs nowhere have no row, nor do
    documents with a null doc_id; items have at most half a million words."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).where("doc_id is not null")
    out = None
    for block in [*item_blocks(items)] or [[]]:
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sought = Items(sent.value)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for shard in shards(batch.column(1).to_pylist(), sought, sought.longest) if sought.words else ():
                    array = SuffixArray([part.words for part in shard], sought.longest)
                    length = array.search(sought).length
                    some = np.flatnonzero(length)
                    if not len(some):
                        continue
                    starts = np.cumsum([0, *(len(part.words) + 1 for part in shard)])
                    sizes = np.diff(starts)
                    doc = np.repeat([ids[part.row] for part in shard], sizes)
                    word = np.arange(array.size) - np.repeat(starts[:-1] - [part.at for part in shard], sizes)
                    # The first of all places of a match, in order of document and word.
                    by = np.lexsort((word, doc))
                    rank = np.empty(array.size, np.int64)
                    rank[by] = np.arange(array.size)
                    low, high = array.ranges(sought, some, length[some])
                    low_high = np.stack([low, high], 1).reshape(-1)
                    ranked = np.append(rank[array.order], array.size)
                    first = by[np.minimum.reduceat(ranked, low_high)[::2]]
                    yield pa.RecordBatch.from_pydict({
                        "item_id": pa.array([sought.names[k] for k in sought.item[some]], pa.string()),
                        "word": pa.array(sought.offset[some], pa.int64()),
                        "n_matched": pa.array(length[some], pa.int64()),
                        "doc_id": pa.array(doc[first], pa.int64()),
                        "doc_word": pa.array(word[first], pa.int64()),
                    })

        found = texts.mapInArrow(run, "item_id string, word long, n_matched long, doc_id long, doc_word long")
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("item_id", "word").agg(F.max_by(F.struct("n_matched", "doc_id", "doc_word"), F.struct("n_matched", -F.col("doc_id"), -F.col("doc_word"))).alias("x"))
    return best.select("item_id", "word", "x.*")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no window of ``items`` occurs in, columns as they were."""
    leak = _free(docs, "leak")
    return with_matches(docs, items, leak).where(F.size(F.col(leak)["spans"]) == 0).drop(leak)


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one for each row of
    ``docs``, a null doc_id included; other columns play no part. See :func:`with_matches`."""
    found = with_matches(docs.select("doc_id", "text"), items).select("doc_id", "leak.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["stop"] - x["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

REPORT_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS k, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
occ AS (SELECT r, k, i, item FROM grams JOIN win USING (k, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, k, i FROM occ)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
