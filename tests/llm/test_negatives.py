"""Hard negatives against a plain version; bounds of the segment summaries."""

import random

import brute
import numpy as np
import pytest

from eventloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def relabel(vec, label):
    return (label + 1) % 10 if vec % 7 == 0 else label


def sample(n, dim, labels, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    which = rng.integers(0, labels, n)
    points = centres[which] + spread * rng.normal(size=(n, dim)) if dim else np.zeros((n, 0))
    return [(int(k * 5), [float(np.float32(x)) for x in p], int(w)) for k, (p, w) in enumerate(zip(points, which))]


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(frame, **options).collect()))


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 1024), (20, 3)])
def test_equals_the_plain_version(spark, shard_rows, block_rows):
    rows = sample(400, 24, 4)
    got = found(spark, rows, relabel=negatives.shifted_labels, every=20,
                shard_rows=shard_rows, block_rows=block_rows)
    assert got == brute.hard_negatives(rows, relabel, every=20) and len(got) > 300


def test_one_label_holds_most_rows(spark):
    rows = [(v, x, 0 if v % 50 else 1) for v, x, _ in sample(300, 6, 3)]
    got = found(spark, rows, every=25, shard_rows=16, block_rows=2)
    assert got == brute.hard_negatives(rows, every=25) and got


def test_ties_and_copies_go_to_the_smaller_id(spark):
    rows = [(k, [1.0, 0.0], 0) for k in range(0, 60, 2)] + [(k, [0.5, 3.0], 1) for k in range(1, 60, 2)]
    got = found(spark, rows, every=10, shard_rows=8)
    assert got == brute.hard_negatives(rows, every=10) and got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = sample(80, 5, 3) + [
        (None, [0.1] * 5, 1), (1001, None, 1), (1002, [0.1] * 5, None), (1003, [0.1, None, 0.2, 0.3, 0.1], 1),
        (1004, [nan] * 5, 1), (1005, [inf] * 5, 2), (100, [9.0] * 5, 2), (100, [9.0] * 5, 0),
        (1100, [], 1), (1101, [], 1), (1102, [], 2), (1200, [0.1, 0.2], 1), (1201, [0.2, 0.2], 1),
        (1202, [0.05, 0.1], 2), (-100, [0.4] * 5, 0), (1300, [0.0] * 5, 0)]
    got = found(spark, rows, relabel=negatives.shifted_labels)
    assert got == brute.hard_negatives(rows, relabel) and (1100, 1101, 1, 1102, 0, 0) in got


def test_scores_beyond_double_precision(spark):
    rng = random.Random(3)
    rows = [(5 * k, [float(np.float32(rng.uniform(1e5, 2e5))) for _ in range(6)], k % 2) for k in range(60)]
    got = found(spark, rows, every=50, band=(10, 100))
    assert got == brute.hard_negatives(rows, every=50, band=(10, 100)) and max(r[4] for r in got) > 1 << 50


def test_empty_tables_and_missing_sides(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [0.5], 1), (1, [0.5], 1)]) == []
    assert found(spark, [(0, [0.5], 1), (1, [0.3], 2)]) == []
    assert found(spark, [(0, [0.5], 1), (1, [-0.5], 1), (2, [-0.3], 2)]) == []


def test_extra_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    rows = sample(60, 4, 2)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in (
        "ints", "row", "shard", "block", "score", "rank", "anchor_id", "low", "n", "shards")})
    got = sorted(map(tuple, negatives.hard_negatives(frame, every=50).collect()))
    assert got == brute.hard_negatives(rows, every=50)


def test_bounds_hold_and_tighten_with_depth():
    rng = np.random.default_rng(8)
    a, b = (np.cumsum(rng.integers(-40, 40, (30, 23)), axis=1).astype(float) for _ in range(2))
    exact, widths = a @ b.T, []
    for segments in negatives.DEPTHS:
        low, high = negatives.Summaries.of(a, segments).bounds(negatives.Summaries.of(b, segments))
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths[-1] < widths[0] / 2


def test_summaries_rule_out_most_pairs_of_smooth_vectors():
    rng = np.random.default_rng(9)
    levels = np.repeat(rng.normal(size=(600, 8)), 8, axis=1)
    points = np.floor(256 * (levels + 0.02 * rng.normal(size=levels.shape))).astype(np.int64)
    shard = negatives.Shard(np.arange(600), np.zeros(600), points)
    queries, exact = points[:20], points[:20] @ points.T
    least = np.sort(exact, axis=1)[:, -6]
    left = shard.survivors(queries, np.ones((20, 600), dtype=bool), least, np.full(20, np.inf))
    assert left[exact >= least[:, None]].all() and left.mean() < 0.1
