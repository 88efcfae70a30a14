"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import drop_stored, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above each node move to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.hint("merge").join(least, "u").filter("v > u AND v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its lower neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.hint("merge").join(least, "u").filter("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    row = edges.agg(F.count(F.lit(1)).alias("n"), digest.alias("d")).first()
    return row.n, row.d


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): every node that has an edge, with the least node it reaches.

    Two stars per round, each round stored; the rounds end when the edges stop
    changing, after about log(n) of them.  Minima combine before the shuffle
    and the joins are merges, left to skew splitting, so a node with very many
    edges does not fill one task, and no table of edges, broadcast, the driver.  Edges with a null end and loops are ignored.
    """
    clean = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    now = store(clean.distinct(), "edges")
    seen = None
    while True:
        state = _state(now)
        if state == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
        following = store(_small_star(_large_star(now)), "edges")
        drop_stored(now)
        now = following
