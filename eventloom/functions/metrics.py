"""Derived metrics as column expressions over aggregated rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.schema import MINUTES_SAVED_PER_EXECUTION, WORK_HOURS_PER_MONTH


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def at_least_one(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(1)), F.lit(1))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def exact_round(value: Column, digits: int = 1) -> Column:
    """Rounding by a double's exact binary value, as Python's ``round`` does; true ties go to even.

    The double times a power of two is a whole number, and so is everything
    after that: with h the floor of twice the value in units of the last digit,
    an odd h with a remainder lies above the middle, without one on it.  Doubles
    from 2^53 units on lie further apart than the last digit and stay.
    """
    units = 10**digits

    def nearest(scaled: Column) -> Column:
        """Rounded quotient of a struct: ``doubled`` units over 2^``shift``."""
        shift, doubled = scaled["shift"], scaled["doubled"]
        halves = F.call_function("shiftright", doubled, shift)

        def settled(half: Column) -> Column:
            on_tie = F.call_function("shiftleft", half, shift) == doubled
            below = F.floor(half / 2)
            up = (half % 2 == 1) & (~on_tie | (below % 2 == 1))
            return (below + F.when(up, 1).otherwise(0)) / F.lit(float(units))

        return _let(halves, settled)

    def scaled(size: Column) -> Column:
        shift = (F.lit(53) - F.floor(F.log2(size))).cast("int")
        return _let(shift, lambda by: F.struct(
            by.alias("shift"),
            ((size * F.pow(F.lit(2.0), by)).cast("bigint") * (2 * units)).alias("doubled")))

    def rounded(v: Column) -> Column:
        size = F.abs(v)
        return (
            F.when(v.isNull() | F.isnan(v) | (size >= 2.0**53 / units), v)
            .when(size < 0.5 / units, F.lit(0.0))
            .otherwise(F.signum(v) * _let(scaled(size), nearest))
        )

    return _let(value, rounded)


# Stored figures round ties away from zero, those a dashboard computes as Python does.
_ROUND = {"up": F.round, "even": exact_round}


def percent(part: Column, whole: Column, digits: int = 1, ties: str = "up") -> Column:
    """Rounded share in percent; NULL when the whole is zero."""
    return _ROUND[ties](F.try_divide(part.cast("double"), whole) * 100, digits)


def ratio(part: Column, whole: Column, digits: int = 1, ties: str = "up") -> Column:
    """Rounded quotient; NULL when the divisor is zero."""
    return _ROUND[ties](F.try_divide(part.cast("double"), whole), digits)


def pct_change(current: Column, previous: Column) -> Column:
    """Change against the previous period; 100 when there was nothing before."""

    def change(pair: Column) -> Column:
        cur, prev = pair["cur"], pair["prev"]
        return (
            F.when((prev == 0) & (cur > 0), F.lit(100.0))
            .when(prev == 0, F.lit(0.0))
            .otherwise(exact_round((cur - prev).cast("double") / prev * 100))
        )

    return _let(F.struct(or_zero(current).alias("cur"), or_zero(previous).alias("prev")), change)


def change_direction(change: Column) -> Column:
    return F.when(change > 0, "pos").when(change < 0, "neg").otherwise("neu")


def whole_percent(part: Column, whole: Column) -> Column:
    """Share as a whole percentage; a zero or missing whole counts as one."""
    base = F.when(or_zero(whole) == 0, F.lit(1)).otherwise(whole)
    return F.bround(or_zero(part).cast("double") / base * 100).cast("bigint")


def limit_stop_pct(limit_stopped: Column, sessions: Column) -> Column:
    return F.when(or_zero(sessions) > 0, percent(or_zero(limit_stopped), sessions, ties="even")).otherwise(0.0)


def depth_score(skill: Column, mcp: Column, subagent: Column, command: Column, total: Column) -> Column:
    """Weighted share of users per feature, 0 to 100."""
    weighted = (
        or_zero(skill) / total * 0.3
        + or_zero(mcp) / total * 0.3
        + or_zero(subagent) / total * 0.2
        + or_zero(command) / total * 0.2
    )
    return F.when(total == 0, F.lit(0.0)).otherwise(exact_round(weighted * 100))


def hours_saved(executions: Column, minutes: int = MINUTES_SAVED_PER_EXECUTION) -> Column:
    return exact_round(or_zero(executions) * minutes / F.lit(60.0))


def annual_hours(hours: Column, days: int) -> Column:
    return hours * F.lit(365 / max(days, 1))


def person_months(hours: Column) -> Column:
    return hours / F.lit(float(WORK_HOURS_PER_MONTH))


def success_tier(rate: Column) -> Column:
    return (
        F.when(rate.isNull(), "none")
        .when(rate >= 90, "good")
        .when(rate >= 70, "warn")
        .otherwise("bad")
    )


def user_tags(skill: Column, subagent: Column, mcp: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(skill > 0, "skill"),
            F.when(subagent > 0, "agent"),
            F.when(mcp > 0, "mcp"),
        )
    )


def marker_size(value: Column, largest: Column) -> Column:
    return value / at_least_one(largest).cast("double") * 30 + 8
