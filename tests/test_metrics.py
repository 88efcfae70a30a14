import pytest
from pyspark.sql import functions as F

from eventloom.functions import metrics as M


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def long(x):
    return F.lit(x).cast("bigint")


@pytest.mark.parametrize("cur,prev,want", [
    (5, 0, 100.0), (0, 0, 0.0), (None, None, 0.0), (None, 4, -100.0), (5, None, 100.0),
    (110, 100, 10.0), (1, 3, -66.7),
])
def test_pct_change(spark, cur, prev, want):
    assert value(spark, M.pct_change(long(cur), long(prev))) == want


@pytest.mark.parametrize("change,want", [(1.5, "pos"), (-0.1, "neg"), (0.0, "neu")])
def test_direction(spark, change, want):
    assert value(spark, M.change_direction(F.lit(change))) == want


@pytest.mark.parametrize("part,whole,want", [(1, 3, 33), (0, 0, 0), (None, None, 0), (5, 5, 100), (1, 8, 12), (3, 8, 38)])
def test_whole_percent(spark, part, whole, want):
    assert value(spark, M.whole_percent(long(part), long(whole))) == want


def test_limit_stop_pct(spark):
    assert value(spark, M.limit_stop_pct(long(22), long(922))) == 2.4
    assert value(spark, M.limit_stop_pct(long(None), long(0))) == 0.0


def test_percent_and_ratio_of_zero(spark):
    assert value(spark, M.percent(long(1), long(0))) is None
    assert value(spark, M.ratio(long(7), long(2))) == 3.5


def test_dashboard_figures_round_ties_to_even(spark):
    assert value(spark, M.whole_percent(long(1), long(8))) == 12
    assert value(spark, M.pct_change(long(17), long(16))) == 6.2
    assert value(spark, M.percent(long(1), long(16))) == 6.3
    assert value(spark, M.percent(long(1), long(16), ties="even")) == 6.2
    assert value(spark, M.limit_stop_pct(long(1), long(16))) == 6.2


def test_depth_score(spark):
    args = [long(n) for n in (5, 5, 10, 0, 10)]
    assert value(spark, M.depth_score(*args)) == 50.0
    assert value(spark, M.depth_score(*[long(0)] * 5)) == 0.0


def test_hours_and_projection(spark):
    assert value(spark, M.hours_saved(long(977))) == 32.6
    assert value(spark, M.hours_saved(long(None))) == 0.0
    assert value(spark, M.annual_hours(F.lit(7.0), 7)) == 365.0
    assert value(spark, M.person_months(F.lit(320.0))) == 2.0


@pytest.mark.parametrize("rate,want", [(90.0, "good"), (89.9, "warn"), (70.0, "warn"), (69.9, "bad"), (None, "none")])
def test_success_tier(spark, rate, want):
    assert value(spark, M.success_tier(F.lit(rate).cast("double"))) == want


def test_user_tags(spark):
    assert value(spark, M.user_tags(long(1), long(0), long(2))) == ["skill", "mcp"]
    assert value(spark, M.user_tags(long(0), long(0), long(0))) == []


def test_marker_size(spark):
    assert value(spark, M.marker_size(long(5), long(10))) == 23.0
    assert value(spark, M.marker_size(long(0), long(0))) == 8.0


def test_rounding_is_that_of_python(spark):
    pairs = [(a, b) for b in (1, 3, 7, 16, 40, 160, 997, 2000) for a in range(0, 4200, 7)]
    pairs += [(a, 2000) for a in range(1990, 2300)] + [(a, 80) for a in range(1, 300)]
    values = [(a - b) / b * 100 for a, b in pairs] + [
        0.0, -0.0, 0.05, 0.15, 0.25, 0.35, -0.25, -0.05, 12.25, 12.35, 2.5, 1e-9, 1e14 + 0.25, 1e15, 1e17, 1e300,
        0.049999999999999996, 0.05000000000000001, 8.35, 1.005, 0.95, 99.95, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2):
        got = [r[0] for r in df.select(M.exact_round(F.col("v"), digits)).collect()]
        wrong = [(v, g, round(v, digits)) for v, g in zip(values, got) if g != round(v, digits)]
        assert not wrong, wrong[:5]
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "v double")
    rest = [r[0] for r in odd.select(M.exact_round(F.col("v"))).collect()]
    assert rest[0] is None and rest[1] != rest[1] and rest[2] == float("inf")


def test_change_on_ties(spark):
    df = spark.createDataFrame([(2001, 2000), (2003, 2000), (1, 0), (0, 0), (None, 5)], "a bigint, b bigint")
    got = [r[0] for r in df.select(M.pct_change(F.col("a"), F.col("b"))).collect()]
    assert got == [round(1 / 2000 * 100, 1), round(3 / 2000 * 100, 1), 100.0, 0.0, -100.0]
    assert got[:2] == [0.1, 0.1]
