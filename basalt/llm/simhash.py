"""SimHash near-duplicates: 64-bit fingerprints linked through BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import cut, discard, parallelism
from basalt.llm.components import connected_components

#: Differing bits at which two fingerprints still link.
RADIUS = 3
#: Parts that a fingerprint is cut into; RADIUS differing bits leave BLOCKS - RADIUS parts alike.
BLOCKS = 5
#: Fingerprints in one tree; a larger shard gets several trees, all asked by all its rows.
TREE_SIZE = 512


def fingerprint(text: bytes | None, size: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of ``text``; 0 where it has no word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[size - 1 :].tolist()
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[i:j], seed) for i, j in zip(starts, stops)), np.uint64, len(stops))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str, size: int = 3) -> DataFrame:
    """The rows of ``docs`` with the fingerprint's bits of their text in one long column more."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (None if (t := x.as_py()) is None else t.encode() for x in batch.column(place))
            found = np.fromiter((fingerprint(t, size) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, fp): one for each document, ``fp`` the fingerprint's bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("binary").alias("text")).mapInArrow(run, f"{key} {kind}, fp long")


class BKTree:
    """Burkhard-Keller tree over integers: a child hangs at its Hamming distance to its parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        if len(self.values) == 1:
            return
        at, new = 0, len(self.values) - 1
        while True:
            gap = (value ^ self.values[at]).bit_count()
            below = self.children[at].get(gap)
            if below is None:
                self.children[at][gap] = new
                return
            at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Positions, in order of insertion, of the stored values within ``radius``."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            gap = (value ^ self.values[at]).bit_count()
            if gap <= radius:
                found.append(at)
            children = self.children[at]
            if len(children) <= 2 * radius + 1:
                open_nodes += [c for edge, c in children.items() if gap - radius <= edge <= gap + radius]
            else:
                open_nodes += [children[edge] for edge in range(gap - radius, gap + radius + 1) if edge in children]
        return found


def link_shard(tree_rows: list[tuple[int, int]], asking: list[tuple[int, int]], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows (fingerprint, id) of one shard."""
    tree = BKTree()
    for value, _ in tree_rows:
        tree.add(value)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    edges = []
    for value, who in asking:
        for at in tree.within(value, radius):
            p, q = root(who), root(tree_rows[at][1])
            if p != q:
                parent[max(p, q)] = min(p, q)
                edges.append((p, q))
    return edges


def _shard_keys(fp, blocks: int, radius: int):
    """Array of shard keys: each choice of ``blocks - radius`` parts, with its number."""
    from itertools import combinations

    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [F.expr(f"shiftrightunsigned(fp, {lo}) & {(1 << (hi - lo)) - 1}L") for lo, hi in zip(cuts, cuts[1:])]
    return F.array(*(F.xxhash64(F.lit(i), *(parts[p] for p in chosen)) for i, chosen in enumerate(combinations(range(blocks), blocks - radius))))


def fingerprint_links(reps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Rows (a, b) of ids that connect all (fp, id) rows at ``radius`` or fewer differing bits.

    Two such fingerprints agree in at least ``blocks - radius`` of their parts, so they share a
    shard of that choice of parts. Every shard's BK-tree goes to the task that holds the rows
    which ask it, in place of a broadcast of all trees, whose size would grow with the corpus.
    A shard of more than ``tree_size`` fingerprints becomes several trees in several tasks; all
    rows of the shard ask each of them. The result is a spanning forest for each tree.
    """
    rows = cut(reps.select("fp", "id", F.explode(_shard_keys(F.col("fp"), blocks, radius)).alias("shard")))
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(sizes, "shard").select("shard", "fp", "id", F.ceil(F.col("n") / tree_size).cast("int").alias("trees"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("trees")).cast("int")
    dealt = shared.withColumn("own", own).withColumn("tree", F.explode(F.expr("sequence(0, trees - 1)")))
    dealt = dealt.select("shard", "tree", "fp", "id", (F.col("own") == F.col("tree")).alias("stored"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        stored: list[tuple[int, int]] = []
        at = None

        def out(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])

        edges: list[tuple[int, int]] = []
        for batch in batches:
            for shard, tree, fp, who, mine in zip(*(c.to_pylist() for c in batch.columns)):
                if (shard, tree) != at:
                    edges += link_shard(stored, held, radius)
                    held, stored, at = [], [], (shard, tree)
                pair = (fp & 0xFFFFFFFFFFFFFFFF, who)
                held.append(pair)
                if mine:
                    stored.append(pair)
            if len(edges) > 10_000:
                yield out(edges)
                edges = []
        yield out(edges + link_shard(stored, held, radius))

    placed = dealt.repartition(parallelism(reps), "shard", "tree").sortWithinPartitions("shard", "tree", "fp")
    return placed.mapInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Texts count whole. A null, empty or blank text has fingerprint zero and links like any
    other; repeated doc_ids keep a row each; further columns of ``docs`` play no part; an empty
    table gives an empty result. ``component_id`` is the smallest doc_id reachable by links of
    ``radius`` or fewer differing bits. doc_id must be an integer; rows with a null doc_id are
    returned with a null component.
    """
    prints = cut(fingerprints(docs))
    reps = cut(prints.where("doc_id is not null").groupBy("fp").agg(F.min(F.col("doc_id").cast("long")).alias("id")))
    roots = connected_components(fingerprint_links(reps, radius))
    named = cut(reps.join(roots, reps["id"] == roots["node"], "left").select(F.col("fp").alias("fp_of"), F.coalesce("root", "id").alias("component_id")))
    joined = prints.join(named, prints["fp"] == named["fp_of"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), own.alias("component_id"))


def first_of_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that come first in their group of near copies.

    Groups are of fingerprints linked by ``radius`` or fewer differing bits, directly or through
    others; first is the least doc_id (null last), then the least hash of all plain columns, and
    one of rows that are alike in all of these. Every row is judged by its own text, so rows
    that share a doc_id may differ in what becomes of them. Null, empty and blank texts have
    fingerprint zero and are copies of each other. No column is added, whatever names there are;
    an empty table gives an empty result.
    """
    mark = "simhash_mark"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    prints = cut(with_fingerprint(docs, mark))
    reps = cut(prints.groupBy(F.col(mark).alias("fp")).agg(F.count("*").alias("n")).select("fp", F.col("fp").alias("id")))
    roots = connected_components(fingerprint_links(reps, radius))
    named = cut(reps.join(roots, reps["id"] == roots["node"], "left").select(F.col("fp").alias(f"{mark}_fp"), F.coalesce("root", "id").alias(f"{mark}_group")))
    discard(reps)
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64(*plain).alias("h"))
    placed = prints.join(named, prints[mark] == named[f"{mark}_fp"]).withColumn(f"{mark}_order", order)
    first = placed.groupBy(F.col(f"{mark}_group").alias(f"{mark}_of")).agg(F.min(f"{mark}_order").alias(f"{mark}_first"))
    stays = placed.join(first, placed[f"{mark}_group"] == first[f"{mark}_of"]).where(F.col(f"{mark}_order").eqNullSafe(F.col(f"{mark}_first")))
    return stays.dropDuplicates([f"{mark}_group"]).select(*(F.col(f"`{c}`") for c in docs.columns))
