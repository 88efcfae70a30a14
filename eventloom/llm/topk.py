"""Exact inner-product search with a ball tree per shard.

Vectors are split into shards by a hash of their id.  Each shard builds a ball
tree; a node bounds the product of a query with anything below it by
q . centre + |q| radius.  Nodes are visited by decreasing bound and skipped
when the bound is below the query's current k-th score.  That score is shared:
a first search in a query's own shard gives every query a floor, which travels
with it to the other shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import store

TOP = 5
SCALE = 256
QUERY_EVERY = 50
SHARD_ROWS = 4096
LEAF = 64
_NO_FLOOR = -(1 << 62)
# Products below this are exact in double precision.
_EXACT = float(1 << 53)


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, ints): floor(256 x) of each component; unusable vectors are left out."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.transform(x, lambda v: F.floor(v * SCALE)).alias("ints"))


class BallTree:
    """Balls over integer vectors, split at the median of the widest direction."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.wide = points.astype(np.float64)[order]
        self.leaf = leaf
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.sons: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        if len(ids):
            self._grow(np.arange(len(ids)))
        self.centre = np.array(self.centres)
        self.radius = np.array(self.radii)

    def _grow(self, rows: np.ndarray) -> int:
        points = self.wide[rows]
        centre = points.mean(axis=0)
        node = len(self.centres)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(np.square(points - centre).sum(axis=1).max())))
        self.sons.append(None)
        self.rows.append(rows)
        if len(rows) > self.leaf and self.radii[node] > 0:
            far = points[np.argmax(np.square(points - centre).sum(axis=1))]
            along = points @ (far - centre)
            cut = np.argsort(along, kind="stable")
            half = len(rows) // 2
            self.rows[node] = None
            low = self._grow(np.sort(rows[cut[:half]]))
            high = self._grow(np.sort(rows[cut[half:]]))
            self.sons[node] = (low, high)
        return node

    def _products(self, rows: np.ndarray, query: np.ndarray, bound: float) -> list[int]:
        if bound < _EXACT:
            return (self.wide[rows] @ query.astype(np.float64)).astype(np.int64).tolist()
        whole = query.astype(object)
        return [int(sum(self.points[r].astype(object) * whole)) for r in rows.tolist()]

    def search(self, own: int, query: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """At most k (score, vec_id) of scores not below ``floor``, best first, ``own`` left out."""
        if not len(self.ids):
            return []
        flat = query.astype(np.float64)
        length = float(np.sqrt(flat @ flat))
        bounds = self.centre @ flat + length * self.radius
        # Rounding may not prune a node that holds an equal score.
        bounds += 1e-9 * (np.abs(bounds) + length * self.radius) + 1e-6
        largest = length * float(np.sqrt(np.square(self.wide).sum(axis=1).max()))
        best: list[tuple[int, int]] = []
        agenda = [(-bounds[0], 0)]
        while agenda:
            bound, node = heapq.heappop(agenda)
            if -bound < floor:
                break
            if (sons := self.sons[node]) is not None:
                for son in sons:
                    if bounds[son] >= floor:
                        heapq.heappush(agenda, (-bounds[son], son))
                continue
            rows = self.rows[node]
            scores = self._products(rows, query, largest)
            best += [(-s, i) for s, i in zip(scores, self.ids[rows].tolist())
                     if s >= floor and i != own]
            best = sorted(best)[:k]
            if len(best) == k:
                floor = max(floor, -best[-1][0])
        return [(-s, i) for s, i in best]


def _search(k: int):
    def run(key: tuple, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for size, part in members.groupby(members["ints"].map(len)) if len(members) else ():
            asked = queries[queries["own_ints"].map(len) == size] if len(queries) else queries
            if not len(asked):
                continue
            tree = BallTree(part["vec_id"].to_numpy(),
                            np.array(part["ints"].tolist(), dtype=np.int64).reshape(len(part), size))
            for own, ints, floor in zip(asked["own_id"], asked["own_ints"], asked["floor"]):
                found = tree.search(own, np.asarray(ints, dtype=np.int64), k, floor)
                out += [(own, vec, score) for score, vec in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _cogrouped(queries: DataFrame, members: DataFrame, k: int) -> DataFrame:
    return queries.groupBy("shard").cogroup(members.groupBy("shard")).applyInPandas(
        _search(k), "query_id long, vec_id long, score long")


def top_products(vectors: DataFrame, k: int = TOP, every: int = QUERY_EVERY,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates
    all other rows of the same length.  Scores are exact integers; ties go to
    the smaller ``vec_id``; with fewer than k candidates all are returned.
    Null vectors and ids, and vectors with null or non-finite components, take
    no part; of rows repeating an id the least vector counts; empty vectors
    score 0.  Only the two named columns are read.
    """
    whole = quantized(vectors).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    rows = store(whole, "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    asked = placed.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("own_id"), F.col("ints").alias("own_ints"),
        F.col("shard").alias("home"))
    first = asked.select("own_id", "own_ints", F.lit(_NO_FLOOR).alias("floor"), "home",
                         F.col("home").alias("shard"))
    near = store(_cogrouped(first, placed, k), "floors")
    floors = near.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(F.lit(_NO_FLOOR)).alias("floor"))
    elsewhere = (
        asked.join(floors, F.col("own_id") == F.col("query_id"), "left")
        .select("own_id", "own_ints", F.coalesce("floor", F.lit(_NO_FLOOR)).alias("floor"), "home",
                F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
                .alias("shard"))
        .filter("shard <> home")
    )
    found = near.union(_cogrouped(elsewhere, placed, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
