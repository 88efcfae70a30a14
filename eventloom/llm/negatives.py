"""Hard negatives by exact scores within a band, with segment summaries as filter.

Vectors are cut into segments; of each segment the mean and the deviation from
it are stored, at several depths.  For two vectors a segment of length L
contributes L (mean * mean) plus or minus L (deviation * deviation) to the
product, which bounds the score from both sides.  A pair that a depth cannot
rule out is refined at the next, and only what is left after the last depth is
scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.prefix import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
ANCHOR_EVERY = 100
# A negative scores between these hundredths of its positive's score.
BAND = (30, 90)
# Segments per vector at each depth.
DEPTHS = (1, 2, 4, 8, 16)
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
# Anchors that are compared with a shard at a time: bounds the size of the score matrix.
_STRIP = 128
# Above this share of pairs left, scores come from one product of matrices.
_DENSE = 0.1
# Products below this are exact in double precision.
_EXACT = float(1 << 53)
_NO_FLOOR = -(1 << 62)
_NO_LIMIT = 1 << 62


Relabel = Callable[[Column, Column], Column]


def usable_rows(vectors: DataFrame, relabel: Relabel | None = None) -> DataFrame:
    """(vec_id, label, ints): floor(256 x) of each component; rows that cannot take part are left out.

    ``relabel`` makes a row's label from its id and its stored label.  Of rows
    that repeat an id the least (ints, label) counts.
    """
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    label = F.col("label").cast("long")
    ints = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE))
    rows = vectors.filter(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.struct(ints.alias("ints"), (relabel(F.col("vec_id"), label) if relabel else label)
                           .alias("label")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.ints")


def shifted_labels(vec_id: Column, label: Column) -> Column:
    """Every seventh row takes the next label, as noise in the labels would."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


# --- segment summaries ------------------------------------------------------


@dataclass(frozen=True)
class Summaries:
    """Means and deviations of equally long vectors at one depth, scaled by the root of the length."""

    means: np.ndarray
    deviations: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, segments: int) -> Summaries:
        edges = np.linspace(0, points.shape[1], min(segments, points.shape[1]) + 1).astype(int)
        means, deviations = [], []
        for low, high in zip(edges[:-1], edges[1:]):
            part = points[:, low:high]
            mean = part.mean(axis=1)
            means.append(mean * np.sqrt(high - low))
            deviations.append(np.sqrt(np.square(part - mean[:, None]).sum(axis=1)))
        return cls(np.stack(means, axis=1), np.stack(deviations, axis=1))

    def bounds(self, other: Summaries) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible product of every row here with every row of ``other``."""
        middle = self.means @ other.means.T
        reach = self.deviations @ other.deviations.T
        # Rounding may not rule out a pair that holds an equal score.
        reach += 1e-9 * (np.abs(middle) + reach) + 1e-6
        return middle - reach, middle + reach


class Shard:
    """Members of one length, in id order, with their summaries at every depth."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        self.wide = self.points.astype(np.float64)
        self.depths = [Summaries.of(self.wide, s) for s in DEPTHS] if points.shape[1] else []
        self.largest = np.abs(self.wide).max(initial=0) * points.shape[1]

    def survivors(self, queries: np.ndarray, possible: np.ndarray,
                  least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which of the ``possible`` pairs may score between a query's ``least`` and ``most``."""
        wide = queries.astype(np.float64)
        for segments, own in zip(DEPTHS, self.depths):
            low, high = Summaries.of(wide, segments).bounds(own)
            possible = possible & (high >= least[:, None]) & (low <= most[:, None])
            if not possible.any():
                break
        return possible

    def scored(self, queries: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the members left and their exact products."""
        wide = queries.astype(np.float64)
        exact = np.abs(wide).max(initial=0) * self.largest < _EXACT
        # One product of matrices is cheaper than gathering most of the members per query.
        dense = wide @ self.wide.T if exact and left.mean() > _DENSE else None
        for query, flat, row, k in zip(queries, wide, left, range(len(left))):
            rows = np.flatnonzero(row)
            if dense is not None:
                yield rows, dense[k, rows].astype(np.int64)
            elif exact:
                yield rows, (self.wide[rows] @ flat).astype(np.int64)
            else:
                whole = query.astype(object)
                yield rows, np.array(
                    [int(sum(self.points[r].astype(object) * whole)) for r in rows], dtype=np.int64)

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int,
             low: int, high: int = _NO_LIMIT) -> list[tuple[int, int]]:
        """The k best (vec_id, score) within a band, ties by smaller id."""
        inside = (scores >= low) & (scores <= high)
        rows, scores = rows[inside], scores[inside]
        order = np.argsort(-scores, kind="stable")[:k]
        return list(zip(self.ids[rows[order]].tolist(), scores[order].tolist()))


def _strips(anchors: pd.DataFrame, members: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, Shard]]:
    """Strips of anchors, their vectors, and the members of the same length."""
    if not len(anchors) or not len(members):
        return
    asked = dict(list(anchors.groupby(anchors["own_ints"].map(len))))
    for size, part in members.groupby(members["ints"].map(len)):
        if size not in asked:
            continue
        shard = Shard(part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["ints"], size))
        for at in range(0, len(asked[size]), _STRIP):
            strip = asked[size].iloc[at:at + _STRIP]
            yield strip, _matrix(strip["own_ints"], size), shard


def _matrix(ints: pd.Series, size: int) -> np.ndarray:
    return np.array([np.asarray(row, dtype=np.int64) for row in ints]).reshape(len(ints), size)


# --- the two searches -------------------------------------------------------


def _positives(k: int):
    def run(key: tuple, anchors: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for strip, queries, shard in _strips(anchors, members):
            ids, labels, floors = (strip[c].to_numpy() for c in ("anchor_id", "own_label", "floor"))
            same = (shard.labels == labels[:, None]) & (shard.ids != ids[:, None])
            left = shard.survivors(queries, same, floors, np.full(len(strip), np.inf))
            for anchor, floor, (rows, scores) in zip(ids, floors, shard.scored(queries, left)):
                out += [(anchor, *hit) for hit in shard.best(rows, scores, k, floor)]
        return pd.DataFrame(out, columns=["anchor_id", "vec_id", "score"]).astype("int64")

    return run


def _negatives(k: int):
    def run(key: tuple, anchors: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for strip, queries, shard in _strips(anchors, members):
            labels = strip["own_label"].to_numpy()
            # The filter takes the hull of an anchor's bands, the exact scores each band by itself.
            least = strip["lows"].map(min).to_numpy()
            most = strip["highs"].map(max).to_numpy()
            left = shard.survivors(queries, shard.labels != labels[:, None], least, most)
            bands = zip(strip["anchor_id"], strip["positives"], strip["lows"], strip["highs"])
            for (anchor, *lists), (rows, scores) in zip(bands, shard.scored(queries, left)):
                for positive, low, high in zip(*lists):
                    out += [(anchor, positive, *hit) for hit in shard.best(rows, scores, k, low, high)]
        return pd.DataFrame(
            out, columns=["anchor_id", "positive_id", "vec_id", "score"]).astype("int64")

    return run


def _spread(column: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(column), count)


def _all_of(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def _compared(anchors: DataFrame, members: DataFrame, search, schema: str,
              own_keys: tuple[str, ...] = (), keys: tuple[str, ...] = ()) -> DataFrame:
    """Every block of anchors against every shard of members, with equal keys if given.

    A group holds one block and one shard, whatever the size of the tables.
    """
    asked = anchors.groupBy(*own_keys, "shard", "block")
    return asked.cogroup(members.groupBy(*keys, "shard", "block")).applyInPandas(search, schema)


def _leading(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _floors(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k-th best score so far, for those that have k."""
    best = _leading(found, keys, k).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("reached"))
    return best.filter(F.col("n") == k).select(*keys, "reached")


def _first_shards(shards: Column) -> Column:
    """The shards of the first round: their square root, so both rounds return about as many rows."""
    return F.ceil(F.sqrt(shards))


def positives(rows: DataFrame, every: int = ANCHOR_EVERY, k: int = POSITIVES,
              shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, score): each anchor's k best other rows of its label.

    Input as from ``usable_rows``, stored.  A label is split into shards by its
    count, so one that holds most rows is spread like any other.
    """
    is_anchor = F.col("vec_id") % every == 0
    plan = rows.groupBy("label").agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"),
        F.ceil(F.count_if(is_anchor) / block_rows).alias("blocks")).filter("blocks > 0")
    planned = rows.join(plan, "label")
    members = planned.select(
        "label", _spread("vec_id", F.col("shards")).alias("shard"), _all_of(F.col("blocks")).alias("block"),
        "vec_id", "ints")
    asked = planned.filter(is_anchor).select(
        F.col("label").alias("own_label"), F.col("vec_id").alias("anchor_id"),
        F.col("ints").alias("own_ints"), _spread("vec_id", F.col("blocks")).alias("block"),
        _first_shards(F.col("shards")).alias("early"), _all_of(F.col("shards")).alias("shard"))
    search, schema = _positives(k), "anchor_id long, vec_id long, score long"

    def run(early: Column, questions: DataFrame) -> DataFrame:
        return written(_compared(
            questions.filter(early), members, search, schema, ("own_label",), ("label",)), "positives")

    first = run(F.col("shard") < F.col("early"), asked.withColumn("floor", F.lit(_NO_FLOOR)))
    floors = _floors(first, ["anchor_id"], k)
    later = asked.join(floors, "anchor_id", "left").withColumn(
        "floor", F.coalesce("reached", F.lit(_NO_FLOOR)))
    found = first.union(run(F.col("shard") >= F.col("early"), later))
    return _leading(found, ["anchor_id"], k).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), "score")


def _floor_div(a: Column, b: int) -> Column:
    """a / b rounded down, for long a, without passing through doubles."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def hard_negatives(vectors: DataFrame, relabel: Relabel | None = None, every: int = ANCHOR_EVERY,
                   n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   band: tuple[int, int] = BAND, shard_rows: int = SHARD_ROWS,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; each is compared
    with all other rows of its length.  A negative has another label and scores
    between ``band`` hundredths of the positive's score.  Scores are exact
    integers, one beyond 64 bits raises; ties go to the smaller id.  Rows with a
    null id, label or vector or a null or non-finite component take no part; of
    rows that repeat an id the least vector counts; empty vectors score 0 with
    each other.  Anchors without positives, and positives with a negative score
    (whose band is empty), give no rows.  Other columns are not read.
    """
    rows = written(usable_rows(vectors, relabel), "vectors")
    pairs = written(positives(rows, every, n_positives, shard_rows, block_rows), "pairs").withColumns({
        "low": -_floor_div(-F.col("score") * band[0], 100),
        "high": _floor_div(F.col("score") * band[1], 100),
    }).filter("low <= high")
    size = rows.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(F.col("vec_id") % every == 0).alias("anchors")).first()
    shards = F.lit(max(1, -(-size.n // shard_rows)))
    blocks = F.lit(max(1, -(-size.anchors // block_rows)))
    early = _first_shards(shards)
    members = rows.select(_spread("vec_id", shards).alias("shard"), _all_of(blocks).alias("block"),
                          "vec_id", "label", "ints")
    search, schema = _negatives(n_negatives), "anchor_id long, positive_id long, vec_id long, score long"

    def run(asked: DataFrame, which: Column) -> DataFrame:
        """Search some shards for the pairs (``anchor_id``, ``positive_id``, ``low``, ``high``)."""
        bands = asked.groupBy("anchor_id").agg(
            F.sort_array(F.collect_list(F.struct("positive_id", "low", "high"))).alias("bands"))
        questions = rows.join(bands, F.col("vec_id") == F.col("anchor_id")).select(
            "anchor_id", F.col("label").alias("own_label"), F.col("ints").alias("own_ints"),
            F.col("bands.positive_id").alias("positives"), F.col("bands.low").alias("lows"),
            F.col("bands.high").alias("highs"), _spread("anchor_id", blocks).alias("block"),
            _all_of(shards).alias("shard")).filter(which)
        return written(_compared(questions, members, search, schema), "negatives")

    keys = ["anchor_id", "positive_id"]
    first = run(pairs, F.col("shard") < early)
    refreshed = pairs.join(_floors(first, keys, n_negatives), keys, "left").withColumn(
        "low", F.greatest("low", F.coalesce("reached", F.lit(_NO_FLOOR)))).drop("reached")
    found = first.union(run(refreshed, F.col("shard") >= early))
    return _leading(found, keys, n_negatives).join(
        pairs.select(*keys, F.col("score").alias("positive_score")), keys).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
