"""Source divergence audit: how far the sources of a language stand apart, term by term.

The sum over all kept terms t of f(p_g(t), p_h(t)) starts from all terms at f00 = f(p0_g, p0_h), p0
being the probability of a term that a group lacks. Terms of many groups are heavy: dense numpy
tiles (groups by terms) add f(p_g, p_h) - f00. Light terms add

      sum over terms of g of     f(p_g, p0_h) - f00
    + sum over terms of h of     f(p0_g, p_h) - f00
    + sum over terms of both of  f(p_g, p_h) - f(p_g, p0_h) - f(p0_g, p_h) + f00

where the first two need no pairs, only how often each count occurs in a group, and the last one
only the postings of one light term at a time. All parts are whole numbers and add up exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.llm.common import cut

#: Documents of a language that a kept term is in, at least.
MIN_DOCS = 3
#: Ranks of the part ``term``.
TOP_TERMS = 200
#: A term of more groups than this, or of more than half of its language's groups, is heavy.
LIGHT_GROUPS = 8
#: Groups and terms on the sides of a dense tile.
TILE_GROUPS, TILE_TERMS = 64, 2048
#: Different terms that a task counts before it hands them on, and bytes cut into words at once.
HELD_TERMS, PIECE = 300_000, 1 << 22
SCALE = 1_000_000_000

_LETTERS = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def pieces(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of ``text`` after ``table`` has made everything else spaces, a stretch at a time."""
    clean, start = text.translate(table), 0
    while len(clean) - start > PIECE:
        stop = clean.find(b" ", start + PIECE)
        if stop < 0:
            break
        yield clean[start:stop].split()
        start = stop
    yield clean[start:].split()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task; an empty term says that the group is there."""
    from collections import Counter

    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            size = len(terms) + 1
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * size, pa.string()),
                "source": pa.array([source] * size, pa.string()),
                "term": pa.array([b"", *terms], pa.binary()),
                "n": pa.array([0, *n.values()], pa.int64()),
                "docs": pa.array([0, *map(docs.__getitem__, terms)], pa.int64()),
            })
        counts.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for words in pieces(text.as_py(), _LETTERS):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            held += len(n) - before
            if held >= HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def postings(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, total, groups, first): the kept terms of every group, ``total``
    their count in the language, ``groups`` the groups that hold them, ``first`` true once a term;
    and one row with an empty term for each group."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    counted = texts.mapInArrow(_count_terms, "lang string, source string, term binary, n long, docs long")
    # Dealt once by (lang, term): both the sums and the windows below find their rows together.
    summed = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    wide = summed.select(
        "lang", "source", "term", "n",
        F.sum("n").over(term).alias("total"),
        F.count("*").over(term).alias("groups"),
        F.sum("docs").over(term).alias("docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    )
    return wide.where((F.col("docs") >= MIN_DOCS) | (F.col("term") == F.lit(b""))).drop("docs")


def probability(count: Column, size: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / size) without overflow."""
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), size.cast("decimal(20,0)"))


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


def _pair_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over light terms of what two groups that both hold a term add to their own parts."""
    for batch in batches:
        langs, lang_of = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        held = batch.column(1)
        sizes = np.asarray(held.value_lengths())
        flat = held.flatten()
        group, p, base = (np.asarray(flat.field(k)) for k in range(3))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        keys, values = [], []
        for size in np.unique(sizes).tolist():
            chosen = np.flatnonzero(sizes == size)
            at = starts[chosen][:, None] + np.arange(size)
            for i in range(size):
                for j in range(size):
                    if i != j:
                        a, b = at[:, i], at[:, j]
                        keys.append(np.stack([lang_of[chosen], group[a], group[b]], 1))
                        values.append(_excess(p[a], p[b]) - _excess(p[a], base[b]) - _excess(base[a], p[b]) + _excess(base[a], base[b]))
        if not keys:
            continue
        pairs, where = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, where.reshape(-1), np.concatenate(values))
        yield pa.RecordBatch.from_pydict({"lang": pa.array(langs[pairs[:, 0]].tolist(), pa.string()), "g": pa.array(pairs[:, 1], pa.int64()), "h": pa.array(pairs[:, 2], pa.int64()), "value": pa.array(sums, pa.int64())})


def _tile(rows: pa.Table, width: int) -> pa.Table:
    """Dense sums over one tile's terms, less f00 for each, for all pairs of its two blocks of groups."""
    lang, a, b = (rows.column(c)[0].as_py() for c in ("lang", "a", "b"))
    group, p = rows.column("g").to_numpy(), rows.column("p").to_numpy()
    terms = rows.column("term").combine_chunks().dictionary_encode()
    marks = np.asarray(terms.is_null())
    ids = np.sort(group[marks])
    base = np.empty(len(ids), np.int64)
    base[np.searchsorted(ids, group[marks])] = p[marks]
    tile = np.repeat(base[:, None], len(terms.dictionary), 1)
    tile[np.searchsorted(ids, group[~marks]), np.asarray(terms.indices.drop_null())] = p[~marks]
    left, right = np.flatnonzero(ids // width == a), np.flatnonzero(ids // width == b)
    g, h, value = [], [], []
    for some, others in [(left, right), (right, left)][: 1 if a == b else 2]:
        for i in some.tolist():
            g.append(np.full(len(others), ids[i]))
            h.append(ids[others])
            value.append((_excess(tile[i], tile[others]) - _excess(base[i], base[others])[:, None]).sum(1))
    g, h, value = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (g, h, value))
    apart = g != h
    return pa.table({"lang": pa.array([lang] * int(apart.sum()), pa.string()), "g": pa.array(g[apart], pa.int64()), "h": pa.array(h[apart], pa.int64()), "value": pa.array(value[apart], pa.int64())})


def divergence_audit(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of the audit of ``docs``.

    Part ``pair`` compares each group (lang, source) with every other source of its language, part
    ``term`` lists the terms that a group has more of than its language, the ``TOP_TERMS`` greatest.
    Null text, lang and source count as empty strings; a group without terms takes part with equal
    probabilities, and a language without kept terms has values of 0. Ranks go by value, then by
    the item's bytes. Repeated rows are documents of their own; other columns, the id among them,
    play no part; an empty table gives no rows.
    """
    found = cut(postings(docs))
    marker = F.col("term") == F.lit(b"")
    heavy = (F.col("groups") > LIGHT_GROUPS) | (2 * F.col("groups") > F.col("sources"))
    # A language's empty term is held by all its groups: it tells their number.
    kinds = found.where("first").groupBy("lang", "groups").agg(
        F.sum(F.when(~marker, 1).otherwise(0)).alias("k"), F.sum("total").alias("n"), F.max(F.when(marker, F.col("groups"))).alias("all")
    )
    langs = (
        kinds.withColumn("sources", F.max("all").over(W.partitionBy("lang")))
        .groupBy("lang", "sources")
        .agg(F.sum("n").alias("lang_n"), F.sum("k").alias("v"), F.sum(F.when(heavy, F.col("k")).otherwise(0)).alias("n_heavy"))
    )
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    # Written, so that its size is known before it is joined: a row for each group.
    groups = cut(
        sums.join(langs, "lang").select(
            "lang", "source", "lang_n", "v", "sources", "n_heavy",
            (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("g"),
            (F.col("own_n") + F.col("v")).alias("size"),
            F.when(F.col("v") > 0, probability(F.lit(0), F.col("own_n") + F.col("v"))).otherwise(1).cast("long").alias("base"),
        )
    )
    terms = (
        found.where(~marker)
        .join(groups, ["lang", "source"])
        .withColumn("p", probability(F.col("n"), F.col("size")).cast("long"))
        .withColumn("heavy", heavy)
    )

    q = probability(F.col("total"), F.col("lang_n") + F.col("v")).cast("long")
    above = terms.withColumn("q", q).where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
    ranked = above.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= TOP_TERMS)
    part_term = ranked.select("lang", "source", F.lit("term").alias("part"), F.col("item").cast("string").alias("item"), "value", "rank")

    value = group_sums(terms, groups)
    names = groups.select("lang", "g", "source")
    pairs = value.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    part_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    return part_pair.unionByName(part_term)


def group_sums(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, g, h, value): the whole sums, light parts and dense tiles together."""
    heavy, light = terms.where("heavy"), terms.where("not heavy")
    other = groups.select("lang", F.col("g").alias("h"), F.col("base").alias("other"))
    exact = lambda x: x.cast("decimal(38,0)")

    bare = excess(F.col("base"), F.col("other"))
    plain = groups.join(other, "lang").where("g != h").select("lang", "g", "h", (exact(F.col("v")) * exact(bare)).alias("value"))

    # How often each count occurs among a group's light terms stands for the terms themselves.
    counts = light.groupBy("lang", "g", "base", "p").agg(F.count("*").alias("k")).join(other, "lang").where("g != h")
    singles = counts.select(
        "lang",
        F.explode(
            F.array(
                F.struct("g", "h", (exact(F.col("k")) * exact(excess(F.col("p"), F.col("other")) - bare)).alias("value")),
                F.struct(F.col("h").alias("g"), F.col("g").alias("h"), (exact(F.col("k")) * exact(excess(F.col("other"), F.col("p")) - excess(F.col("other"), F.col("base")))).alias("value")),
            )
        ).alias("x"),
    ).select("lang", "x.*")

    lists = light.where("groups > 1").groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "base")).alias("held"))
    corrections = lists.select("lang", "held").mapInArrow(_pair_corrections, "lang string, g long, h long, value long")

    width = TILE_GROUPS
    block = lambda x: F.floor(x / width).cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), block(F.col("sources") - 1))
    chunks = F.ceil(F.col("n_heavy") / TILE_TERMS).cast("long")
    own = block(F.col("g"))
    cells = heavy.select("lang", "g", "term", "p", own.alias("own"), F.pmod(F.xxhash64("term"), chunks).alias("chunk"), F.explode(blocks).alias("other"))
    edges = (
        groups.where("n_heavy > 0")
        .select("lang", "g", F.lit(None).cast("binary").alias("term"), F.col("base").alias("p"), own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), blocks.alias("others"))
        .select("lang", "g", "term", "p", "own", "chunk", F.explode("others").alias("other"))
    )
    dealt = cells.unionByName(edges).select("lang", "g", "term", "p", "chunk", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    tiles = dealt.groupBy("lang", "a", "b", "chunk").applyInArrow(lambda rows: _tile(rows, width), "lang string, g long, h long, value long")

    whole = [x.select("lang", "g", "h", exact(F.col("value")).alias("value")) for x in (plain, singles, corrections, tiles)]
    every = whole[0].unionByName(whole[1]).unionByName(whole[2]).unionByName(whole[3])
    return every.groupBy("lang", "g", "h").agg(F.sum("value").cast("long").alias("value"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

AUDIT_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occ AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM occ GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM occ o JOIN kept USING (lang, term) GROUP BY ALL),
own AS (SELECT lang, source, sum(n) AS own_n FROM cnt GROUP BY ALL),
prob AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, v.v, v.lang_n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(o.own_n, 0) + v.v)::HUGEINT AS p
  FROM grp g JOIN kept k USING (lang) JOIN v USING (lang)
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM prob a JOIN prob b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
lang_q AS (
  SELECT *, 1 + (1000000000::HUGEINT * (total + 1)) // (lang_n + v)::HUGEINT AS q FROM prob WHERE n > 0),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM lang_q WHERE p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""
