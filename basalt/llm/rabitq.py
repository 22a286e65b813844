"""Approximate nearest neighbours by randomly rotated one-bit codes with error bounds."""

from __future__ import annotations



import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.llm.common import cut
from basalt.llm.vectors import by_dimension, clean

#: Neighbours of a query, and bits to which a turned query is rounded.
NEAREST, QUERY_BITS = 20, 6
#: Width of the error bound, in standard errors of the estimate.
CONFIDENCE = 3.0
#: Queries and candidates that meet in one task.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 8192
#: Queries estimated at once within a task.
STRIP = 64


def rotation(dimension: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix over the dimension padded to whole bytes."""
    size = -(-dimension // 8) * 8
    turned, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return turned[:dimension]


def one_bit_codes(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the turned vectors, their norms, and the scalar that corrects for the
    angle between a vector and its code."""
    size = turn.shape[1]
    norms = np.linalg.norm(x, axis=1)
    turned = (x / norms[:, None]) @ turn
    return np.packbits(turned >= 0, axis=1), norms, np.abs(turned).sum(1) / np.sqrt(size)


class CodedBlock:
    """Candidates as packed bits, correction scalars and original vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, turn: np.ndarray) -> None:
        self.ids, self.x, self.turn = ids, x, turn
        bits, self.norms, self.align = one_bit_codes(x, turn)
        size = turn.shape[1]
        width = -(-bits.shape[1] // 8) * 8
        self.words = np.pad(bits, ((0, 0), (0, width - bits.shape[1]))).view(np.uint64)
        self.ones = np.bitwise_count(self.words).sum(1).astype(float)
        spread = np.sqrt(np.maximum(0.0, 1 - self.align**2)) / self.align
        self.bound = CONFIDENCE * spread / np.sqrt(max(1, size - 1))

    def estimates(self, queries: np.ndarray) -> np.ndarray:
        """Estimated cosines of unit ``queries`` with all candidates, from bits alone.

        A turned query is rounded to ``QUERY_BITS`` bits a component; its product with a code is
        a weighted sum of population counts over its bit planes."""
        turned = queries @ self.turn
        size = turned.shape[1]
        low, high = turned.min(1, keepdims=True), turned.max(1, keepdims=True)
        step = np.maximum(high - low, 1e-12) / (2**QUERY_BITS - 1)
        levels = np.rint((turned - low) / step).astype(np.uint8)
        dot = np.zeros((len(queries), len(self.ids)))
        for plane in range(QUERY_BITS):
            bits = np.packbits((levels >> plane) & 1, axis=1)
            words = np.pad(bits, ((0, 0), (0, self.words.shape[1] * 8 - bits.shape[1]))).view(np.uint64)
            for k in range(self.words.shape[1]):
                dot += np.bitwise_count(words[:, k : k + 1] & self.words[:, k][None]) * float(1 << plane)
        # Code entries are +-1/sqrt(size): twice the ones' sum less the whole sum.
        ones = step * dot + low * self.ones
        whole = (levels * step + low).sum(1, keepdims=True)
        return (2 * ones - whole) / np.sqrt(size) / self.align

    def search(self, ids: np.ndarray, queries: np.ndarray, nearest: int) -> list[tuple[int, int, float]]:
        """(query, candidate, inner product): each query's nearest of this block.

        The best estimates are ranked exactly first; every candidate whose upper bound still
        reaches the last of them is ranked exactly too."""
        out = []
        for start in range(0, len(ids), STRIP):
            some = queries[start : start + STRIP]
            lengths = np.linalg.norm(some, axis=1)
            scale = lengths[:, None] * self.norms[None]
            guess = self.estimates(some / lengths[:, None])
            upper = (guess + self.bound[None]) * scale
            guess *= scale
            for row, query in enumerate(ids[start : start + STRIP].tolist()):
                usable = self.ids != query
                count = min(nearest, int(usable.sum()))
                if not count:
                    continue
                first = np.argpartition(np.where(usable, -guess[row], np.inf), count - 1)[:count]
                reached = (self.x[first] * some[row]).sum(1).min()
                chosen = np.flatnonzero(usable & (upper[row] >= reached))
                chosen = np.union1d(chosen, first)
                exact = (self.x[chosen] * some[row]).sum(1)
                best = np.lexsort((self.ids[chosen], -exact))[:count]
                out += [(query, int(self.ids[chosen[b]]), float(exact[b])) for b in best]
        return out


def search(vectors: DataFrame, every: int = 20, nearest: int = NEAREST) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the nearest neighbours of every ``every``-th vector.

    Queries are the vectors whose vec_id is divisible by ``every``; candidates are all others,
    nearness the inner product in double precision, ties to the smaller vec_id. All vectors are
    coded and all queries meet all codes, in blocks dealt by a hash of the id, so that copies of
    one vector spread evenly. A query's candidates are the vectors of its dimension. Vectors that are
    null, empty, zero, or hold null or non-finite components take no part, nor do rows with a null
    vec_id. A repeated row is one more candidate; a vec_id is no neighbour of itself. With fewer than
    ``nearest`` candidates all are returned; further columns play no part; an empty table gives
    an empty result.
    """
    rows = cut(clean(vectors))
    parts = [_met(part, every, nearest) for part in by_dimension(rows) or [rows]]
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _met(rows: DataFrame, every: int, nearest: int) -> DataFrame:
    """Rows (query_id, vec_id, score): each query's nearest of every block, for vectors of one
    dimension."""
    total = rows.count()
    asking = rows.where(F.col("id") % every == 0).distinct()
    query_blocks, blocks = max(1, -(-asking.count() // QUERY_BLOCK)), max(1, -(-total // CANDIDATE_BLOCK))
    one = rows.limit(1).collect()
    turn = rotation(len(one[0]["v"])) if one else rotation(8)
    spread = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    sides = asking.select(
        F.lit(True).alias("asks"), "id", "v", spread(query_blocks, 1).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb")
    ).unionByName(
        rows.select(F.lit(False).alias("asks"), "id", "v", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), spread(blocks, 2).alias("cb"))
    )

    def meet(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        ids = group.column("id").to_numpy()
        flat = group.column("v").combine_chunks()
        x = np.asarray(flat.flatten()).reshape(len(ids), -1)
        found: list[tuple[int, int, float]] = []
        if asks.any() and not asks.all():
            found = CodedBlock(ids[~asks], x[~asks], turn).search(ids[asks], x[asks], nearest)
        columns = zip(*found) if found else ([], [], [])
        q, c, s = (list(x) for x in columns)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())})

    return sides.groupBy("qb", "cb").applyInArrow(meet, "query_id long, vec_id long, score double")
