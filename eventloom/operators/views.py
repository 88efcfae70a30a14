"""All-history views over the clean events.

Days are the stored partition column, so a filter on a view's date prunes.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.clock import date_lit, minutes_between, month_start
from eventloom.functions.counters import counts, counts_with_users, has_tool, is_message, pick
from eventloom.functions.metrics import percent
from eventloom.functions.text import blank_to_null, display_name
from eventloom.schema import NO_PROJECT

_DAY_COUNTERS = [
    "message_count", "session_count", "tool_execution_count", "mcp_count",
    "subagent_count", "command_count", "skill_count", "limit_hit_count",
]
_TOOL_AS = {"tool_execution_count": "tool_count"}


def kpi_metrics(events: DataFrame) -> DataFrame:
    """Counters and active users per team and day."""
    return counts_with_users(
        events, ["team_id", "event_date"], pick(_DAY_COUNTERS, _TOOL_AS),
        total="total_events", users="active_users",
    )


def overview_daily(events: DataFrame) -> DataFrame:
    """The day metrics plus file operations."""
    return counts_with_users(
        events, ["team_id", "event_date"],
        pick([*_DAY_COUNTERS, "file_op_count"], _TOOL_AS),
        total="total_events", users="active_users",
    )


def user_ranking(events: DataFrame) -> DataFrame:
    """All-time counters per user and team with a display name."""
    ranked = events.groupBy("user_id", "team_id").agg(
        F.count(F.lit(1)).alias("total_count"),
        *counts(pick(["message_count", "skill_count", "subagent_count", "mcp_count",
                      "command_count", "limit_hit_count"])),
        F.max("event_timestamp").alias("last_active_at"),
    )
    return ranked.withColumn("display_name", display_name(F.col("user_id")))


def user_stats_all(events: DataFrame) -> DataFrame:
    """All-time counters per user and team with first and last activity."""
    return events.groupBy("user_id", "team_id").agg(
        F.count(F.lit(1)).alias("total_count"),
        *counts(pick(["message_count", "session_count", "skill_count", "subagent_count",
                      "mcp_count", "command_count", "file_op_count", "limit_hit_count"])),
        F.max("event_timestamp").alias("last_active_at"),
        F.to_date(F.min("event_timestamp")).alias("first_active_date"),
    )


def _tool_days(events: DataFrame, *extra) -> DataFrame:
    # Rows with an unknown outcome stay in the denominator of this rate.
    return (
        events.filter(has_tool())
        .groupBy("team_id", "tool_name", "event_date")
        .agg(
            F.count(F.lit(1)).alias("execution_count"),
            F.count_if(F.col("tool_success")).alias("success_count"),
            F.count_if(~F.col("tool_success")).alias("failure_count"),
            *extra,
        )
        .withColumn("success_rate", percent(F.col("success_count"), F.col("execution_count")))
    )


def tool_ranking(events: DataFrame) -> DataFrame:
    """Outcomes per team, tool and day."""
    return _tool_days(events)


def tool_stats_daily(events: DataFrame) -> DataFrame:
    """Outcomes per team, tool and day with the mean output length."""
    return _tool_days(events, F.avg("output_length").alias("avg_output_length"))


def session_stats(events: DataFrame) -> DataFrame:
    """Span and size of every session of a user in a team."""
    spans = events.groupBy("session_id", "user_id", "team_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(is_message()).alias("message_count"),
        F.count_if(has_tool()).alias("tool_count"),
    )
    return spans.withColumn(
        "duration_min", minutes_between(F.col("session_start"), F.col("session_end"))
    )


def project_stats(events: DataFrame) -> DataFrame:
    """Counters per team and project; a blank project counts as none."""
    named = events.withColumn(
        "project_name", F.coalesce(blank_to_null(F.col("project_name")), F.lit(NO_PROJECT))
    )
    return counts_with_users(
        named, ["team_id", "project_name"],
        pick(["message_count", "session_count", "skill_count", "mcp_count", "command_count"],
             {"message_count": "msg_count"}),
        total="event_count", users="user_count",
        extra=[("last_active_at", F.max("event_timestamp"), F.max("last_active_at"))],
    )


def monthly_active_events(events: DataFrame, first: date | None = None,
                          last: date | None = None) -> DataFrame:
    """Distinct users and sessions per team and month, from month ``first`` to month ``last`` if given.

    The months become bounds on the day, which the stored events are divided by;
    a filter on the result's month could not rule out a day.  Events are first reduced to one row per user and session, so the two
    distinct counts expand that small frame instead of the events.
    """
    keys = ["team_id", "month"]
    if first is not None:
        events = events.filter(F.col("event_date") >= date_lit(first.replace(day=1)))
    if last is not None:
        after = (last.replace(day=28) + timedelta(days=4)).replace(day=1)
        events = events.filter(F.col("event_date") < date_lit(after))
    pairs = (
        events.withColumn("month", month_start(F.col("event_date")))
        .groupBy(*keys, "user_id", "session_id")
        .agg(F.count_if(is_message()).alias("messages"), F.count(F.lit(1)).alias("total_events"))
    )
    return pairs.groupBy(*keys).agg(
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("session_id").alias("sessions"),
        F.sum("messages").alias("messages"),
        F.sum("total_events").alias("total_events"),
    )


def feature_adoption_daily(events: DataFrame) -> DataFrame:
    """Distinct users per team and day, in all and per feature.

    The per-user level keeps one row per user with a yes/no per feature, which
    makes the five conditional distinct counts plain counts.
    """
    keys = ["team_id", "event_date"]
    features = ["skill", "mcp", "subagent", "command"]
    per_user = (
        events
        .groupBy(*keys, "user_id")
        .agg(*[F.max(f"is_{name}").alias(name) for name in features])
    )
    return per_user.groupBy(*keys).agg(
        F.count("user_id").alias("total_users"),
        *[F.count_if(F.col(name) & F.col("user_id").isNotNull()).alias(f"{name}_users")
          for name in features],
    )


def all_views(events: DataFrame) -> dict[str, DataFrame]:
    """The ten views by name."""
    return {
        "v_kpi_metrics": kpi_metrics(events),
        "v_user_ranking": user_ranking(events),
        "v_tool_ranking": tool_ranking(events),
        "v_overview_daily": overview_daily(events),
        "v_user_stats": user_stats_all(events),
        "v_tool_stats": tool_stats_daily(events),
        "v_session_stats": session_stats(events),
        "v_project_stats": project_stats(events),
        "v_monthly_active": monthly_active_events(events),
        "v_feature_adoption": feature_adoption_daily(events),
    }
