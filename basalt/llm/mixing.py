"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import WORD_PATTERN, cut

#: Weights dealt to the sources in order, the share of all words that the mix takes, and the
#: most that it takes of a source or document, in multiples of its words.
WEIGHTS, SHARE, CAP = (3.0, 1.0, 2.0), 1.5, 2.0
#: Relative gap to the target at which Newton's iteration stops, and its most rounds.
TOLERANCE, ROUNDS = 1e-9, 60


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Rows (skey, source, source_size, target): the water level over the sources.

    Sources stand by code point, null last, and their weights repeat. With a source full at
    ``cap`` times its words, the level is where all take their weight's part or are full.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))).withColumn("full", cap * F.col("source_size"))
    fill = W.orderBy(F.col("full") / F.col("weight"), "skey")
    everything = W.partitionBy()
    laid = (
        weighted.withColumn("total", share * F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("full").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("open"))
    )
    holds = F.when(F.col("full") / F.col("weight") >= F.col("level"), F.col("level"))
    level = laid.withColumn("at", F.max(holds).over(everything))
    return level.select("skey", "source", "source_size", F.least("full", F.coalesce(F.col("weight") * F.col("at"), F.col("full"))).alias("target"))


def _rate(multiplier: Column, size: Column, mean: Column, cap: float) -> Column:
    """Tilted rate: rate / (cap - rate) grows exponentially with the document's words."""
    tilt = F.least(F.lit(500.0), F.greatest(F.lit(-500.0), multiplier * size / mean))
    return cap / (1 + F.exp(-tilt))


def solve(groups: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Rows (skey, multiplier, mean, full): the dual solution of every source.

    Minimising the bounded relative entropy of document rates to one copy each, subject to a
    source's words, has a convex dual in one multiplier a source; all are solved together by
    Newton steps, each one distributed aggregation over (source, size) counts, with the
    bracket halved where a step leaves it. Sources at their cap have no finite multiplier.
    """
    mean = groups.where("size > 0").groupBy("skey").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).cast("double").alias("mean"))
    state = targets.join(mean, "skey").select(
        "skey", "target", "mean", (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("multiplier"), F.lit(-500.0).alias("lo"), F.lit(500.0).alias("hi"), F.lit(False).alias("done"),
    )
    state = cut(state.withColumn("done", F.col("full") | (F.col("target") <= 0)))
    for _ in range(ROUNDS):
        if state.where("not done").isEmpty():
            break
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        words = F.col("n") * F.col("size")
        found = groups.where("size > 0").join(state.where("not done"), "skey").groupBy("skey").agg(
            F.sum(words * rate).alias("value"), F.sum(words * F.col("size") / F.col("mean") * rate * (1 - rate / cap)).alias("slope")
        )
        gap = F.col("value") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("lo"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("hi"))
        step = F.col("multiplier") - gap / F.greatest("slope", F.lit(1e-300))
        inside = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        near = F.abs(gap) <= TOLERANCE * F.col("target")
        told = state.join(found, "skey", "left")
        state = cut(
            told.select(
                "skey", "target", "mean", "full",
                F.when(F.col("done") | near, F.col("multiplier")).otherwise(inside).alias("multiplier"),
                F.when(F.col("done"), F.col("lo")).otherwise(low).alias("lo"),
                F.when(F.col("done"), F.col("hi")).otherwise(high).alias("hi"),
                (F.col("done") | near).alias("done"),
            )
        )
    return state.select("skey", "target", "multiplier", "mean", "full")


def whole_copies(groups: DataFrame, solved: DataFrame, cap: float = CAP, corrections: int = 3) -> DataFrame:
    """Rows (skey, size, copies, more): each document of a (source, size) group gets ``copies``
    copies, and the first ``more`` of them in hash order one copy more.

    Groups stand by falling size, and the running sum of their fractional copies is rounded at
    every group: the rounding is off by less than one document of the source at any point. What
    is left of the target then goes, group by group, to the sizes that fit it best.
    """
    rate = F.when(F.col("full"), F.lit(cap)).when(F.col("target") <= 0, F.lit(0.0)).otherwise(_rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap))
    rated = groups.where("size > 0").join(solved, "skey").select("skey", "size", "n", "target", rate.alias("rate"))
    run = W.partitionBy("skey").orderBy(F.desc("size")).rowsBetween(W.unboundedPreceding, 0)
    wished = F.col("n") * F.col("rate")
    upto = rated.withColumn("after", F.sum(wished).over(run))
    total = F.floor(F.col("after") + 0.5) - F.floor(F.greatest(F.lit(0.0), F.col("after") - wished) + 0.5)
    most = F.floor(F.col("n") * cap).cast("long")
    given = cut(upto.select("skey", "size", "n", "target", F.least(most, F.greatest(F.lit(0), total)).cast("long").alias("total")))
    for _ in range(corrections):
        left = given.groupBy("skey").agg((F.first("target") - F.sum(F.col("total") * F.col("size"))).alias("left"))
        choice = given.join(left, "skey")
        room = F.when(F.col("left") > 0, most - F.col("total")).otherwise(F.col("total"))
        moved = F.least(room, F.floor(F.abs("left") / F.col("size") + 0.5).cast("long"))
        best = (
            choice.withColumn("moved", moved)
            .groupBy("skey")
            .agg(F.min(F.struct(F.abs(F.abs("left") - F.col("moved") * F.col("size")), F.col("size"), (F.signum("left") * F.col("moved")).cast("long").alias("change"))).alias("best"))
            .select(F.col("skey").alias("at"), F.col("best.size").alias("at_size"), F.col("best.change").alias("change"))
        )
        joined = given.join(best, (F.col("skey") == F.col("at")) & (F.col("size") == F.col("at_size")), "left")
        given = cut(joined.select("skey", "size", "n", "target", (F.col("total") + F.coalesce("change", F.lit(0))).alias("total")))
    return given.select("skey", "size", F.floor(F.col("total") / F.col("n")).cast("long").alias("copies"), (F.col("total") % F.col("n")).alias("more"))


def _skey() -> Column:
    """A source's key, never null."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken.

    ``taken`` is the document's words times its copies. A null text, an empty one and one of
    white space have no words and are never taken; a null source is a source of its own;
    repeated rows and null doc_ids count row by row, in the order of a hash of id and text, so
    reruns agree; further columns play no part; an empty table gives an empty result. A source's
    taken words miss its target by about its smallest documents at most, unless it has too few
    documents to come closer.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = cut(docs.select("doc_id", _skey().alias("skey"), "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("h")))
    groups = cut(sized.groupBy("skey", "source", "size").agg(F.count("*").alias("n")))
    sources = groups.groupBy("skey", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = cut(source_targets(sources, weights, share, cap))
    groups = groups.select("skey", "size", "n")
    plan = whole_copies(groups, solve(groups, targets, cap), cap)
    plan = cut(
        groups.join(plan, ["skey", "size"], "left")
        .join(targets.select("skey", "source_size", "target"), "skey")
        .select("skey", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("more", F.lit(0)).alias("more"))
    )
    # Ranks within a group, in hash order: counts by the hash's first byte, then rows within it.
    placed = sized.join(plan, ["skey", "size"]).withColumn("part", F.expr("shiftrightunsigned(h, 56)"))
    contested = placed.where("more > 0")
    counts = contested.groupBy("skey", "size", "part").agg(F.count("*").alias("here"))
    ahead = W.partitionBy("skey", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut(counts.select("skey", "size", "part", F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("offset")))
    within = W.partitionBy("skey", "size", "part").orderBy("h", "doc_id")
    ranked = contested.withColumn("row", F.row_number().over(within)).join(offsets, ["skey", "size", "part"])
    more = (F.col("row") + F.col("offset") <= F.col("more")).cast("long")
    settled = ranked.withColumn("copies", F.col("copies") + more).select("doc_id", "size", "source_size", "target", "copies", "h", "skey")
    sure = placed.where("more = 0").select("doc_id", "size", "source_size", "target", "copies", "h", "skey")
    both = settled.unionByName(sure)
    return both.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), F.col("copies").cast("long").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"), "h", "skey")


def mix_report(docs: DataFrame) -> DataFrame:
    """The mix without the columns that tell rows apart."""
    return mix(docs).drop("h", "skey")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Words decide, so documents without any are in no mix; all columns pass through. Rows with a
    null doc_id are taken like others. Rows that repeat doc_id, text and source share the copies
    which the mix gave to all of them; they differ by one copy at most.
    """
    dealt = mix(docs).groupBy(F.struct("doc_id", "skey", "h").alias("mix_key")).agg(F.sum("copies").alias("mix_total"), F.count("*").alias("mix_rows")).where("mix_total > 0")
    # A struct is equal to another where their fields are, nulls included. The row itself is kept in
    # one, so that no name of its columns can meet a name of ours.
    plain = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    keyed = docs.select(F.struct("doc_id", _skey().alias("skey"), F.xxhash64("doc_id", "text").alias("h")).alias("mix_own"), F.xxhash64(*(F.col(f"`{c}`") for c in plain)).alias("mix_hash"), F.struct("*").alias("mix_row"))
    keyed = keyed.withColumn("mix_number", F.row_number().over(W.partitionBy("mix_own").orderBy("mix_hash")))
    joined = keyed.join(dealt, keyed["mix_own"] == dealt["mix_key"])
    copies = F.floor(F.col("mix_total") / F.col("mix_rows")) + (F.col("mix_number") <= F.col("mix_total") % F.col("mix_rows")).cast("long")
    given = joined.withColumn("mix_copies", copies).where("mix_copies > 0")
    return given.withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select("mix_row.*")
