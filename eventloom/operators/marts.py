"""Mart builders: clean events to daily team, user and tool summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.counters import counts, pick, sums
from eventloom.schema import MART_COUNTERS

_CONDITIONS = [name for name in MART_COUNTERS if name != "total_events"]
_MEASURES = [*MART_COUNTERS, "success_count", "failure_count"]


def usage_base(events: DataFrame, by_tool: bool = False) -> DataFrame:
    """Counters per date, team and user, and per tool if asked.

    Every mart rolls up from here, so one pass over the events feeds all three,
    and a team holding most of the rows is spread over its users.
    """
    keys = ["summary_date", "team_id", "user_id"] + (["tool_name"] if by_tool else [])
    dated = events.withColumn("summary_date", F.col("event_date"))
    return dated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        *counts(pick(_CONDITIONS)),
        F.count_if(F.col("tool_success")).alias("success_count"),
        F.count_if(~F.col("tool_success")).alias("failure_count"),
        F.max("event_timestamp").alias("last_active_at"),
    )


def usage_rows(events: DataFrame) -> DataFrame:
    """Every event as a by-tool base of its own, for ``merged_usage`` to add up."""

    def once(condition: Column, name: str) -> Column:
        return F.when(condition, 1).otherwise(0).cast("bigint").alias(name)

    return events.select(
        F.col("event_date").alias("summary_date"), "team_id", "user_id", "tool_name",
        F.lit(1).cast("bigint").alias("total_events"),
        *[once(condition, name) for name, condition in pick(_CONDITIONS).items()],
        once(F.col("tool_success"), "success_count"), once(~F.col("tool_success"), "failure_count"),
        F.col("event_timestamp").alias("last_active_at"),
    )


def merged_usage(parts: DataFrame) -> DataFrame:
    """Counters that lie in several parts of a by-tool base, added up per key."""
    return parts.groupBy("summary_date", "team_id", "user_id", "tool_name").agg(
        *sums(_MEASURES), F.max("last_active_at").alias("last_active_at"))


def _success_rate() -> Column:
    """Successes among events whose outcome is known, in percent."""
    known = F.sum("success_count") + F.sum("failure_count")
    return F.round(F.try_divide(F.sum("success_count").cast("double"), known) * 100, 1)


def daily_from_base(base: DataFrame) -> DataFrame:
    """Daily mart of a base with one row per date, team and user."""
    return base.groupBy("summary_date", "team_id").agg(
        *sums(MART_COUNTERS),
        F.count("user_id").alias("active_users"),
        _success_rate().alias("success_rate"),
    )


def users_from_base(base: DataFrame) -> DataFrame:
    """Per-user rows of a base with one row per date, team, user and tool."""
    return base.groupBy("summary_date", "team_id", "user_id").agg(
        *sums(_MEASURES), F.max("last_active_at").alias("last_active_at")
    )


def _user_columns(users: DataFrame) -> DataFrame:
    return users.select("summary_date", "user_id", "team_id", *MART_COUNTERS, "last_active_at")


def daily_summary(events: DataFrame) -> DataFrame:
    return daily_from_base(usage_base(events))


def user_summary(events: DataFrame) -> DataFrame:
    return _user_columns(usage_base(events))


def tool_summary(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("tool_name").isNotNull())
        .withColumn("summary_date", F.col("event_date"))
        .groupBy("summary_date", "team_id", "tool_name")
        .agg(
            F.count(F.lit(1)).alias("execution_count"),
            F.count_if(F.col("tool_success")).alias("success_count"),
            F.count_if(~F.col("tool_success")).alias("failure_count"),
        )
    )


def marts_from_base(base: DataFrame, users: DataFrame | None = None) -> dict[str, DataFrame]:
    """All three marts of one by-tool base; ``users`` are its ``users_from_base``, if at hand."""
    users = users_from_base(base) if users is None else users
    tools = (
        base.filter(F.col("tool_name").isNotNull())
        .groupBy("summary_date", "team_id", "tool_name")
        .agg(
            F.sum("total_events").alias("execution_count"),
            *sums(["success_count", "failure_count"]),
        )
    )
    return {
        "daily_summary": daily_from_base(users),
        "user_summary": _user_columns(users),
        "tool_summary": tools,
    }
