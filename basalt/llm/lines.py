"""Fuzzy line deduplication by MinHash.

The lines are told apart, joined, counted and grouped by DataFrame operations; numpy in Arrow
batches hashes shingles and compares sets. A form with SQL functions alone took 1,094 CPU seconds
for each GB where this one is held to 400 (README)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import cut, discard, parallelism, release
from basalt.llm.components import connected_components

#: Jaccard similarity of character shingles from which two lines are one.
THRESHOLD = 0.8
#: Characters in a shingle.
SHINGLE = 5
#: Bands of a signature, and the least hashes that make up a band.
BANDS, ROWS = 16, 5
#: Different shingles that tiny and short lines have at most, and their least hashes in a band.
#: Both have a hash function for each band; longer lines take bands from places of one order.
TINY, TINY_BANDS, TINY_ROWS, SHORT, SHORT_ROWS = 12, 8, 2, 64, 4
#: Values kept of a signature, by two bits each, and those of them that lines so alike have in
#: common but for once in 500 times.
KEPT, AGREEING = 30, 19
#: Bits of a shingle's hash, and characters hashed at once.
BITS, CHUNK = 40, 500_000
#: Lines of a bucket that are compared all with all, and lines from which a bucket counts as hot.
SMALL, HOT = 8, 10_000
#: Lines in a block of a bucket that is closed in full.
BLOCK = 512

_ODD = np.random.default_rng(5).integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_LOW = np.uint64(2**BITS - 1)


def split_lines(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, pos, line, k) for the lines of all texts that are not blank."""
    parted = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return parted.where(F.col("line").rlike(r"\S")).withColumn("k", F.xxhash64("line"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[17]
    return (x ^ (x >> np.uint64(29))) * _ODD[23]


def _distinct(x: np.ndarray) -> np.ndarray:
    """The different values in order; sorting is far faster here than ``np.unique``."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash): the 64-bit hashes of all lines' shingles, repeats included, line by line.
    A line shorter than a shingle is its own only one."""
    pad = "\0" * (SHINGLE - 1)
    codes = np.frombuffer((pad.join(lines) + pad).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    counts = np.maximum(1, sizes - (SHINGLE - 1))
    begins = np.cumsum(sizes + SHINGLE - 1) - (sizes + SHINGLE - 1)
    owner = np.repeat(np.arange(len(lines)), counts)
    at = np.arange(len(owner)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    rolled = np.zeros(max(0, len(codes) - SHINGLE + 1), np.uint64)
    for i in range(SHINGLE):
        rolled += (codes[i : len(rolled) + i] + np.uint64(1)) * _ODD[i]
    return owner, _mix(rolled[at])


def _shorter(lines: list[str]) -> Iterator[list[str]]:
    """Runs of lines of a bounded number of characters, one line at least."""
    held, size = [], 0
    for line in lines:
        if held and size + len(line) > CHUNK:
            yield held
            held, size = [], 0
        held.append(line)
        size += len(line)
    if held:
        yield held


def _successors(keys: np.ndarray, start: np.ndarray, size: np.ndarray, lines: np.ndarray, point: int, rows: int) -> np.ndarray:
    """For each of ``lines`` the ``rows`` hashes of its ordered ones that follow ``point``, from
    the least again after the greatest."""
    first = np.searchsorted(keys, (lines.astype(np.uint64) << np.uint64(BITS)) | np.uint64(point)) - start[lines]
    at = (first[:, None] + np.arange(rows)) % size[lines][:, None] + start[lines][:, None]
    return keys[at] & _LOW


def _band(values: np.ndarray, number: int) -> np.ndarray:
    """The key of a band from its values, one row a line."""
    key = np.full(len(values), number, np.uint64) * _ODD[40]
    for column in values.T:
        key = _mix(key ^ column) + column
    return key


def _bits(values: np.ndarray) -> np.ndarray:
    """Two bits of each of ``KEPT`` values, one row a line, as a long."""
    shift = np.arange(KEPT, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(((values >> np.uint64(7)) & np.uint64(3)) << shift, axis=1)


def signatures_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(band keys by row of a line, their lines, sketches of short lines, of long lines).

    A sketch is 0 where the line is not of that kind. Lines up to a quarter above the size that
    parts two kinds are of both, so any two alike lines share a kind.
    """
    owner, hashes = shingle_hashes(lines)
    keys = _distinct((owner.astype(np.uint64) << np.uint64(BITS)) | (hashes >> np.uint64(64 - BITS)))
    size = np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=len(lines))
    start = np.cumsum(size) - size
    found: list[tuple[np.ndarray, np.ndarray]] = []
    sketches = np.zeros((2, len(lines)), np.uint64)
    over = 1 / THRESHOLD

    def only(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the chosen lines, and where each line's begin."""
        mine = np.zeros(len(lines), bool)
        mine[chosen] = True
        low = np.zeros(len(lines), np.int64)
        low[chosen] = np.cumsum(size[chosen]) - size[chosen]
        return keys[np.repeat(mine, size)], low

    def turned(some: np.ndarray, number: int) -> np.ndarray:
        """Hashes of lines in order under a further hash function."""
        return np.sort((some & ~_LOW) | (_mix((some & _LOW) * _ODD[number + 30]) >> np.uint64(64 - BITS)))

    tiny = np.flatnonzero(size <= TINY * over)
    if len(tiny):
        some, low = only(tiny)
        for number in range(TINY_BANDS):
            found.append((_band(_successors(turned(some, number), low, size, tiny, 0, TINY_ROWS), 100 + number), tiny))
    short = np.flatnonzero((size > TINY) & (size <= SHORT * over))
    if len(short):
        kept = []
        some, low = only(short)
        for number in range(BANDS):
            order = turned(some, number)
            values = _successors(order, low, size, short, 0, SHORT_ROWS)
            found.append((_band(values, 200 + number), short))
            kept += [values[:, 0], *(_successors(order, low, size, short, x, 1)[:, 0] for x in (2**BITS // 3, 2 * 2**BITS // 3))]
        sketches[0, short] = _bits(np.stack(kept[:KEPT], 1))
    long = np.flatnonzero(size > SHORT)
    if len(long):
        for number in range(BANDS):
            found.append((_band(_successors(keys, start, size, long, number * 2**BITS // BANDS, ROWS), 300 + number), long))
        points = [(2 * i + 1) * 2**BITS // (2 * KEPT) for i in range(KEPT)]
        sketches[1, long] = _bits(np.concatenate([_successors(keys, start, size, long, x, 1) for x in points], 1))
    rows = np.concatenate([x for _, x in found])
    return np.concatenate([x for x, _ in found]), rows, sketches[0], sketches[1]


def signatures(lines: DataFrame) -> DataFrame:
    """Rows (k, short, long, bands): MinHash signatures of the lines (k, line).

    The 5-character shingles of a line are hashed and ordered. Lines of up to 64 different ones
    take the least hashes under a function of its own for each band; longer lines take each
    band from the hashes that follow another point of one order. ``short`` and ``long`` hold
    two bits of thirty such values, 0 where the line is not of that kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            done = 0
            for part in _shorter(batch.column(1).to_pylist()):
                bands, owner, short, long = signatures_of(part)
                order = np.argsort(owner, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(part)))]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(part)), pa.array(short.view(np.int64)), pa.array(long.view(np.int64)), listed], names=["k", "short", "long", "bands"]
                )
                done += len(part)

    return lines.select("k", "line").mapInArrow(run, "k long, short long, long long, bands array<long>")


def agreeing(one: str, two: str) -> Column:
    """Whether two signatures may be of alike lines: tiny lines have none and may always be."""
    same = lambda x: F.expr(f"{KEPT} - bit_count(({one}.{x} ^ {two}.{x} | shiftrightunsigned({one}.{x} ^ {two}.{x}, 1)) & {0x5555555555555555 >> (64 - 2 * KEPT)}L)")
    both = lambda x: F.expr(f"{one}.{x} <> 0 and {two}.{x} <> 0")
    return F.when(both("long"), same("long") >= AGREEING).when(both("short"), same("short") >= AGREEING).otherwise(F.lit(True))


def placed_in_buckets(rows: DataFrame) -> DataFrame:
    """Rows (k, band, n, lo) of buckets with several lines: their number and least key.

    Bands that a 64th of all lines, chosen by hash, shows to be hot are counted with partial
    sums and joined back, so that no task gathers their rows; all others are counted where
    their rows meet."""
    some = rows.where("pmod(xxhash64(k, 1), 64) = 0").groupBy("band").agg(F.count("*").alias("seen")).where(F.col("seen") >= HOT // 64)
    hot = cut(some.select("band"))
    bucket = W.partitionBy("band")
    any_hot = not hot.isEmpty()
    cold = rows.join(hot, "band", "left_anti") if any_hot else rows
    cold = cold.select("k", "band", F.count("*").over(bucket).alias("n"), F.min("k").over(bucket).alias("lo")).where("n > 1")
    if not any_hot:
        return cut(cold)
    counted = rows.join(hot, "band", "left_semi").groupBy("band").agg(F.count("*").alias("n"), F.min("k").alias("lo"))
    warm = rows.join(counted, "band").select("k", "band", "n", "lo")
    return cut(cold.unionByName(warm))


def jaccard(one: list[str], two: list[str]) -> np.ndarray:
    """The similarity of the shingle sets of each two lines. At most 4,096 pairs."""
    place = np.uint64(52)

    def sets(lines: list[str]) -> np.ndarray:
        parts = []
        done = 0
        for part in _shorter(lines):
            owner, hashes = shingle_hashes(part)
            parts.append(((owner + done).astype(np.uint64) << place) | (hashes >> np.uint64(12)))
            done += len(part)
        return _distinct(np.concatenate(parts))

    a, b = sets(one), sets(two)
    both = np.sort(np.concatenate([a, b]))
    count = lambda x: np.bincount((x >> place).astype(np.int64), minlength=len(one))
    shared = count(both[1:][both[1:] == both[:-1]])
    return shared / (count(a) + count(b) - shared)


def similar(pairs: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose lines (k, line) have the exact similarity."""
    side = lambda x: lines.select(F.col("k").alias(x), F.col("line").alias(f"line_{x}"))
    texts = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                near = jaccard(part.column(2).to_pylist(), part.column(3).to_pylist()) >= threshold
                yield part.select(["a", "b"]).filter(pa.array(near))

    return texts.select("a", "b", "line_a", "line_b").mapInArrow(run, "a long, b long")


def _candidates(asking: list[tuple], others: list[tuple]) -> np.ndarray:
    """How many kept values the sketches of each two lines do not share; 255 within a component."""
    mask = np.uint64(0x5555555555555555 >> (64 - 2 * KEPT))
    column = lambda some, i: np.array([x[i] for x in some], np.int64)
    unlike = np.zeros((len(asking), len(others)), np.uint8)
    for i in (3, 4):
        x, y = column(asking, i).view(np.uint64)[:, None], column(others, i).view(np.uint64)[None]
        apart = x ^ y
        unlike = np.maximum(unlike, np.where((x == 0) | (y == 0), 0, np.bitwise_count((apart | apart >> np.uint64(1)) & mask)))
    unlike[column(asking, 2)[:, None] == column(others, 2)[None]] = 255
    return unlike


def _likeliest(asking: list[tuple], others: list[tuple], band: int, threshold: float) -> list[tuple[int, int]]:
    """Each asking line with the one that its sketch is nearest to."""
    unlike = _candidates(asking, others)
    first = unlike.argmin(1)
    return [(asking[i][1], others[j][1]) for i, j in enumerate(first.tolist()) if unlike[i, j] <= KEPT - AGREEING]


def _alike(asking: list[tuple], others: list[tuple], band: int, threshold: float) -> list[tuple[int, int]]:
    """Links between all lines whose sketches allow it, enough of them to join their components.
    A pair is compared in the first bucket that both lines share."""
    i, j = np.nonzero(_candidates(asking, others) <= KEPT - AGREEING)
    width = max(len(x[5]) for x in (*asking, *others))
    one, two = (np.array([x[5] + [0] * (width - len(x[5])) for x in some], np.int64) for some in (asking, others))
    sets: dict[int, np.ndarray] = {}
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for start in range(0, len(i), 4096):
        x, y = i[start : start + 4096], j[start : start + 4096]
        shared = (one[x][:, :, None] == two[y][:, None, :]).any(2) & (one[x] != 0)
        mine = one[x, shared.argmax(1)] == band
        for a, b in zip(x[mine].tolist(), y[mine].tolist()):
            a, b = asking[a], others[b]
            if top(a[2]) == top(b[2]):
                continue
            for row in (a, b):
                if row[1] not in sets:
                    sets[row[1]] = _distinct(shingle_hashes([row[6]])[1])
            p, q = sets[a[1]], sets[b[1]]
            if min(len(p), len(q)) < threshold * max(len(p), len(q)):
                continue
            both = np.sort(np.concatenate([p, q]))
            n = int((both[1:] == both[:-1]).sum())
            if n >= threshold * (len(p) + len(q) - n):
                links.append((a[1], b[1]))
                parent[top(a[2])] = top(b[2])
    return links


def met_in_blocks(rows: DataFrame, meet, threshold: float) -> DataFrame:
    """Rows (a, b): what ``meet`` finds between the lines of a block that ask and the others.

    ``rows`` holds (band, block, asks, k, root, short, long, bands, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = (None, None), []
        pairs: list[tuple[int, int]] = []

        def close() -> None:
            asking, others = [x for x in held if x[0]], [x for x in held if not x[0]]
            if asking and others:
                pairs.extend(meet(asking, others, at[0], threshold))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f(x) for x in pairs], pa.int64()) for f in (min, max)], names=["a", "b"])

        for batch in batches:
            for band, block, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, block) != at:
                    close()
                    at, held = (band, block), []
                held.append(tuple(row))
            if len(pairs) > 10_000:
                yield out()
                pairs.clear()
        close()
        yield out()

    group = ["band", "block"]
    placed = rows.select(*group, "asks", "k", "root", "short", "long", "bands", "line").repartition(parallelism(rows), *group).sortWithinPartitions(*group)
    return placed.mapInArrow(run, "a long, b long").distinct()


def line_links(lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (node, root): the components of alike lines among different lines (k, line).

    Lines of a bucket are compared with its least key, those of a small bucket all with all;
    pairs whose signatures have too few values in common are not. Large buckets that this leaves
    in several components are closed: every line outside a bucket's largest component meets
    the one that its signature is nearest to, and if it is still outside, all others, block by
    block.
    """
    signed = cut(signatures(lines), "k")
    members = placed_in_buckets(signed.select("k", F.explode("bands").alias("band")))
    sketches = signed.select("k", F.struct("short", "long").alias("sketch"))
    small = members.where(f"n between 3 and {SMALL} and k <> lo").select("band", "k")
    both = small.join(small.withColumnRenamed("k", "other"), "band").where("k < other").select(F.col("k").alias("a"), F.col("other").alias("b"))
    star = members.where("k <> lo").select(F.col("lo").alias("a"), F.col("k").alias("b"))
    pairs = star.unionByName(both).distinct()
    left, right = (sketches.select(F.col("k").alias(x), F.col("sketch").alias(f"of_{x}")) for x in "ab")
    near = pairs.join(left, "a").join(right, "b").where(agreeing("of_a", "of_b"))
    links = cut(similar(near, lines, threshold))
    roots = connected_components(links)

    large = cut(members.where(f"n > {SMALL}").select("k", "band", "n"))
    discard(members)
    for meet in (_likeliest, _alike):
        rooted = large.join(roots, large["k"] == roots["node"], "left").select("k", "band", "n", F.coalesce("root", "k").alias("root"))
        sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("size"), F.max("n").alias("n"))
        parted = sizes.groupBy("band").agg(F.max(F.struct("size", "root"))["root"].alias("main"), F.count("*").alias("parts"), (F.floor(F.max("n") / BLOCK) + 1).cast("int").alias("blocks"))
        dealt = rooted.join(parted.where("parts > 1"), "band")
        # The likeliest partners are few and compared later; the rest is compared where it meets.
        if meet is _likeliest:
            unused = {"bands": F.lit(None).cast("array<long>"), "line": F.lit(None).cast("string")}
            dealt = dealt.join(signed.select("k", "short", "long"), "k").withColumns(unused)
        else:
            dealt = dealt.join(signed, "k").join(lines, "k")
        own = dealt.withColumn("block", F.pmod(F.xxhash64("k", F.lit(7)), F.col("blocks")).cast("int")).withColumn("asks", F.lit(False))
        asking = dealt.where("root <> main").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("asks", F.lit(True))
        met = met_in_blocks(own.unionByName(asking), meet, threshold)
        links = cut(links.unionByName(similar(met, lines, threshold) if meet is _likeliest else met))
        roots = connected_components(links)
    discard(signed, large)
    return roots


def _place(docs: DataFrame) -> Column:
    """(doc_id, pos) as one value that orders alike: a number where ids are whole numbers, which
    are grouped by hash, without sorting the lines."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return F.struct("doc_id", "pos")
    return F.col("doc_id").cast("decimal(19,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")


def lost_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, lost): for documents that lose lines, a mark for each line lost.

    A mark holds the line's position in its upper half and part of its key in the lower. Of
    every component of alike lines, the line first in (doc_id, position) stays.
    """
    rows = split_lines(docs).withColumn("place", _place(docs))
    # Grouped by the key alone, so that a task holds whole buckets and writes a file for each of its
    # own: grouped by the lines too, every task writes a file for every bucket.
    other = F.xxhash64("line", F.lit(1))
    grouped = rows.groupBy("k").agg(F.min("line").alias("line"), F.min("place").alias("first"), F.count("*").alias("n"), (F.min(other) < F.max(other)).alias("clash"))
    # Unlike lines that share a key by chance all stay.
    single = cut(grouped.where("not clash").drop("clash"), "k", codec="zstd")
    roots = line_links(single.select("k", "line"), threshold)
    places = single.select("k", "first", "n")
    named = places.join(roots, places["k"] == roots["node"], "left").select("k", "first", "n", "root")
    joined = cut(named.where("root is not null or n > 1"))
    heads = joined.where("root is not null").groupBy("root").agg(F.min("first").alias("head"))
    alike = joined.where("root is not null").join(heads, "root").select("k", "head")
    heads = alike.unionByName(joined.where("root is null").select("k", F.col("first").alias("head")))
    kept = cut(heads.groupBy("k").agg(F.min("head").alias("head")))  # lines may share a key by chance
    discard(single, joined)
    lost = rows.select("doc_id", "pos", "k", "place").join(kept, "k").where("place <> head")
    return lost.groupBy("doc_id").agg(F.collect_set(_mark(F.col("pos"), F.col("k"))).alias("lost"))


def _mark(pos: Column, k: Column) -> Column:
    return F.shiftleft(pos.cast("long"), 32).bitwiseOR(k.bitwiseAND(F.lit(0xFFFFFFFF)))


def kept_texts(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with three columns more, in place of columns of these names:
    ``kept_text``, the text without its lost lines, and ``n_lines`` and ``n_kept``."""
    lost = lost_lines(docs, threshold).select(F.col("doc_id").alias("lost_id"), F.col("lost").alias("lost_marks"))
    columns = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_kept", "lost_marks")]
    joined = docs.join(lost, docs["doc_id"] == lost["lost_id"], "left").select(*(docs[c] for c in columns), lost["lost_marks"])
    parts = F.split("text", "\n")
    left = F.when(F.col("lost_marks").isNotNull(), _without("lost_marks", parts))
    done = joined.withColumn("lost_marks", left).withColumns(
        {
            "kept_text": F.when(F.col("lost_marks").isNull(), F.col("text")).otherwise(F.array_join("lost_marks", "\n")),
            "n_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long"),
        }
    )
    n_kept = F.when(F.col("lost_marks").isNull(), F.col("n_lines")).otherwise(F.size("lost_marks").cast("long"))
    return done.withColumn("n_kept", n_kept).drop("lost_marks")


def _without(marks: str, parts: Column) -> Column:
    """The ``parts`` whose marks are not among ``marks``. The parts are a variable of the outer
    function, so that they are not split again for each line."""
    kept = lambda x: F.array_except(F.transform(x, lambda line, i: _mark(i, F.xxhash64(line))), F.col(marks))
    return F.transform(F.array(parts), lambda x: F.transform(kept(x), lambda mark: F.get(x, F.shiftright(mark, 32).cast("int"))))[0]


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with two columns more, ``lines`` and ``kept``, both arrays of lines,
    in place of columns of these names.

    Lines are parted by line feeds. Of all lines of all texts whose 5-character shingle sets
    have a Jaccard similarity of 0.8 or more, directly or through others, one stays: the first
    by doc_id and position. Blank lines say nothing and stay. A null text has null arrays; rows
    with a null doc_id keep all their lines; rows that repeat a doc_id and its lines are one
    document, so they keep the same lines; further columns pass through; an empty table gives
    an empty result. Lines are told apart by a 64-bit hash, shingles by one of 52 bits.

    Lines that are alike but share no band, or whose signatures differ by chance, are not found.
    At a similarity of just 0.8 that is less than 1 pair in 100, at 0.85 less than 1 in 500; a
    line stays wrongly only if it misses all lines that it is like.
    """
    done = kept_texts(docs, threshold).withColumns({"lines": F.split("text", "\n"), "kept": F.when(F.col("n_lines") > 0, F.when(F.col("n_kept") > 0, F.split("kept_text", "\n")).otherwise(F.array()))})
    return done.select(*(c for c in docs.columns if c not in ("lines", "kept")), "lines", "kept")


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_kept, kept_sha256 of the text that remains."""
    done = kept_texts(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_kept", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
