"""Approximate nearest neighbours by a forest of sorted hash strings.

Rows are dealt to blocks; each block keeps, per tree, the sorted array of its rows' hash
strings of ``BITS`` bits. A bit tells on which side of a random hyperplane a vector lies. A query finds
its longest matching prefix in every tree by binary search and ascends in all trees together, one
bit at a time; rows that share a tree's prefix with the query meet it there. A row at an angle
of a has the same bit with the chance 1 - a / pi, so its meetings are binomial. The ascent ends
when a row as near as the k-th found so far meets the query in ``MEETINGS`` trees on average.
Then distances are computed in falling order of meetings, down to the number that such a row
reaches with a chance of 1 - ``MISS``; the k-th nearest found, which decides it, gets nearer
meanwhile. There is no cap on candidates: where all rows are about as far away, more of them are compared.

Equal vectors are searched once: a block keeps their k + 1 least ids, which is enough for any
query, and equal queries share one search. So a vector that holds a third of all rows costs
as much as any other. Vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of another length are not compared. A repeated (id, vector) row
counts once. Vectors of unequal length are lifted to a sphere by one more component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.llm.common import ship, table

TREES, BITS = 256, 32
#: Meetings expected of a row as near as the k-th, the chance that it has too few, and distances computed at once.
MEETINGS, MISS, GROUP = 40.0, 0.12, 64
BLOCK_ROWS, BLOCK_QUERIES = 1 << 14, 1 << 14
K, EVERY = 10, 100


@cache
def planes(dims: int) -> np.ndarray:
    """Normal vectors of the hyperplanes of all trees, orthogonal in groups of ``dims``."""
    rng = np.random.default_rng(dims)
    groups = [np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(-(-TREES * BITS // dims))]
    return np.concatenate(groups)[: TREES * BITS].astype(np.float32)


def same_bit(distance: float) -> float:
    """Chance that two points of the unit sphere lie on the same side of a random hyperplane."""
    return 1.0 - float(np.arccos(np.clip(1.0 - distance * distance / 2.0, -1.0, 1.0))) / np.pi


@cache
def least_meetings(trees: int, chance: float) -> int:
    """The number of meetings that is reached with a chance of 1 - ``MISS``, of ``trees`` with this ``chance`` each."""
    if chance >= 1.0:
        return trees
    below, term, n = 0.0, (1.0 - chance) ** trees, 0
    while n < trees and below + term <= MISS:
        below += term
        term *= (trees - n) / (n + 1) * chance / (1.0 - chance)
        n += 1
    return n


def lifted(vectors: np.ndarray, radius: float) -> np.ndarray:
    """Vectors divided by ``radius`` with one more component that puts them on the unit sphere."""
    unit = vectors / radius
    rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(1, keepdims=True)))
    return np.concatenate([unit, rest], 1).astype(np.float32)


def strings(points: np.ndarray, tree: int) -> np.ndarray:
    """Hash strings of one tree as whole numbers."""
    sides = points @ planes(points.shape[1])[tree * BITS : (tree + 1) * BITS].T > 0
    return np.packbits(sides, axis=1).view(">u4")[:, 0].astype(np.int64)


class Forest:
    """Sorted hash strings over the vectors of one block."""

    def __init__(self, vectors: np.ndarray, radius: float, trees: int = TREES):
        self.vectors, self.radius, self.compared = vectors, radius, 0
        points = lifted(vectors, radius)
        self.order, self.sorted = [], []
        for tree in range(trees):
            found = strings(points, tree)
            order = np.argsort(found, kind="stable").astype(np.int32)
            self.order.append(order)
            self.sorted.append(found[order])

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, distances) of each query's k nearest found, nearest first, ties included."""
        for at in range(0, len(queries), 256):
            yield from self._search(queries[at : at + 256], k)

    def _search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        points, trees, n = lifted(queries, self.radius), len(self.order), len(self.vectors)
        levels = np.arange(BITS + 1)
        low, high = (np.empty((len(queries), trees, BITS + 1), np.int32) for _ in range(2))
        for tree in range(trees):
            own = strings(points, tree)[:, None] >> (BITS - levels)
            low[:, tree] = np.searchsorted(self.sorted[tree], own << (BITS - levels))
            high[:, tree] = np.searchsorted(self.sorted[tree], (own + 1) << (BITS - levels))
        met = (high - low).astype(np.int64).sum(1)
        for at, query in enumerate(queries):
            far = np.full(n, np.inf)

            def compare(rows: np.ndarray) -> float:
                rows = rows[np.isinf(far[rows])]
                far[rows] = np.sqrt(((self.vectors[rows] - query) ** 2).sum(1))
                self.compared += len(rows)
                return float(np.partition(far, k - 1)[k - 1]) if k <= n else np.inf

            # Ascend to the level where enough rows are met for a first k-th distance, ...
            level = int(np.flatnonzero(met[at] >= min(4 * k, n))[-1])
            while len(rows := np.unique(self._met(low[at], high[at], level))) < min(4 * k, n):
                level -= 1
            kth = compare(rows)
            # ... and on until a row as near as that meets the query often enough.
            same = same_bit(min(kth / self.radius, 2.0)) if np.isfinite(kth) else 0.0
            while level and trees * same**level < MEETINGS:
                level -= 1
            times = np.bincount(self._met(low[at], high[at], level), minlength=n)
            order = np.argsort(-times, kind="stable")
            order = order[: np.count_nonzero(times)] if level else order
            for start in range(0, len(order), GROUP):
                some = order[start : start + GROUP]
                if np.isfinite(kth) and times[some[0]] < least_meetings(trees, round(same_bit(min(kth / self.radius, 2.0)) ** level, 3)):
                    break
                kth = compare(some)
            rows = np.flatnonzero(far <= (kth if np.isfinite(kth) else np.finfo(float).max))
            nearest_first = np.argsort(far[rows], kind="stable")
            yield rows[nearest_first], far[rows][nearest_first]

    def _met(self, low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
        """Rows that share a prefix of ``level`` bits with the query, as often as there are such trees."""
        return np.concatenate([order[a:b] for order, a, b in zip(self.order, low[:, level], high[:, level], strict=True)])


def usable(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector, digest): rows with a vector that takes part, each once."""
    values = F.col(vector).cast("array<double>")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(values, lambda x: x != 0)
    rows = frame.select(F.col(key).alias("id"), values.alias("vector")).where(fine & some & F.col("id").isNotNull())
    # -0.0 and 0.0 are equal components.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    return rows.withColumn("digest", F.sha2(F.col("vector").cast("string"), 256)).dropDuplicates(["id", "digest"])


def nearest(queries: DataFrame, rows: DataFrame, k: int, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows other than its own id.

    Both frames are of the form that ``usable`` gives.
    """
    ship(rows.sparkSession)
    first = W.partitionBy("digest").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    own = few.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
    sizes = own.agg(F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()
    blocks, radius = max(1, -(-sizes[0] // block_rows)), float(np.sqrt(sizes[1] or 1.0)) * (1 + 1e-9)
    asked = queries.groupBy("digest").agg(F.first("vector").alias("vector"))
    parts = max(1, -(-asked.count() // block_queries))
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    # Digests of one length class lie together, so that a block's vectors have one length.
    held = own.withColumn("dims", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int"))
    held = held.withColumn("part", each_part)
    sought = asked.withColumn("dims", F.size("vector")).withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int"))
    sought = sought.withColumn("block", each_block)

    def search(key: tuple, here: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(here) and len(wanted):
            forest = Forest(np.stack(here["vector"].to_numpy()), radius)
            ids, targets = here["ids"].to_numpy(), wanted["digest"].to_numpy()
            found = forest.search(np.stack(wanted["vector"].to_numpy()), k + 1)
            for digest, (at, far) in zip(targets, found, strict=True):
                near = sorted((d, int(i)) for row, d in zip(at, far, strict=True) for i in ids[row])[: k + 1]
                out += [(digest, i, d) for d, i in near]
        return pd.DataFrame(out, columns=["digest", "vec_id", "score"])

    by = ("block", "part", "dims")
    found = held.groupBy(*by).cogroup(sought.groupBy(*by)).applyInPandas(search, "digest string, vec_id bigint, score double")
    # Per distinct query k + 1 rows survive before they meet the queries that share it.
    ahead = W.partitionBy("digest").orderBy("score", "vec_id")
    found = found.withColumn("n", F.row_number().over(ahead)).where(F.col("n") <= k + 1).drop("n")
    each = queries.select(F.col("id").alias("query_id"), "digest").join(found, "digest").where("vec_id <> query_id")
    order = W.partitionBy("query_id", "digest").orderBy("score", "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every row whose id is divisible by 100."""
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest(rows.where(F.col("id") % EVERY == 0), rows, K)
