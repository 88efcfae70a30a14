"""Statistics of the service endpoints, the command line and the admin guide.

These surfaces define their measures differently from the marts (UTC periods,
Pre and Post tool events only, subagents by stop event) and keep doing so.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.clock import (
    AsOf,
    event_since,
    for_team,
    from_utc,
    iso_utc,
    ntz_lit,
    resolve_as_of,
    to_utc,
    utc_wall,
)
from eventloom.functions.counters import is_message, is_session_start, is_tool_call
from eventloom.functions.metrics import pct_change
from eventloom.functions.text import display_name
from eventloom.operators.dashboard import one_row, top_k
from eventloom.operators.distinct_users import user_counts


def _tool() -> Column:
    return F.coalesce("tool_name", F.lit("unknown"))


def _utc_day() -> Column:
    return F.to_date(utc_wall(F.col("event_timestamp")))


def api_stats(events: DataFrame, users: DataFrame, team_id: str, days: int = 1,
              as_of: AsOf = None) -> DataFrame:
    """One row: counts of the period, change against the one before, users.

    Only the two periods of the events are read; the number of all users comes
    from ``users``, the user mart or the bitmaps of users per day.
    """
    now = resolve_as_of(as_of)
    start = now - timedelta(days=days)
    ts = F.col("event_timestamp")
    current = ts >= ntz_lit(start)
    previous = (ts >= ntz_lit(start - timedelta(days=days))) & (ts < ntz_lit(start))
    measures = {
        "skill": F.col("is_skill"),
        "subagent": F.col("event_type") == "SubagentStop",
        "mcp": F.col("is_mcp"),
        "message": is_message(),
        "session": is_session_start(),
    }
    recent = for_team(events, team_id).filter(event_since(start - timedelta(days=days)))
    per_user = recent.groupBy("user_id").agg(
        *[F.count_if(current & cond).alias(f"{name}_now") for name, cond in measures.items()],
        *[F.count_if(previous & cond).alias(f"{name}_before") for name, cond in measures.items()],
        F.count_if(current & F.col("is_command")).alias("command_now"),
        F.max(current).alias("active"),
    )
    row = per_user.agg(
        *[F.coalesce(F.sum(f"{name}_now"), F.lit(0)).alias(f"{name}_count")
          for name in (*measures, "command")],
        *[F.coalesce(F.sum(f"{name}_before"), F.lit(0)).alias(f"{name}_before")
          for name in measures],
        F.count_if("active").alias("active_users"),
    )
    mine = for_team(users, team_id)
    if "user_id" in users.columns:
        known = mine.select("user_id").distinct().agg(F.count("user_id").alias("total_users"))
    else:
        known = user_counts(mine, {"total_users": F.lit(True)})
    return one_row(row, known).select(
        *[f"{name}_count" for name in (*measures, "command")],
        "active_users",
        "total_users",
        *[pct_change(F.col(f"{name}_count"), F.col(f"{name}_before")).alias(f"{name}_change")
          for name in measures],
        iso_utc(ntz_lit(to_utc(start))).alias("period_start"),
        iso_utc(ntz_lit(to_utc(now))).alias("period_end"),
    )


def _recent(events: DataFrame, team_id: str, days: int, as_of: AsOf) -> DataFrame:
    start = resolve_as_of(as_of) - timedelta(days=days)
    return for_team(events, team_id).filter(event_since(start))


def api_users(events: DataFrame, team_id: str, days: int = 1, as_of: AsOf = None,
              limit: int = 20) -> DataFrame:
    """Busiest users with their counters and last UTC activity."""
    ranked = _recent(events, team_id, days, as_of).groupBy("user_id").agg(
        F.count_if("is_skill").alias("skill_count"),
        F.count_if(F.col("event_type") == "SubagentStop").alias("subagent_count"),
        F.count_if("is_mcp").alias("mcp_count"),
        F.count_if("is_command").alias("command_count"),
        F.count_if(is_message()).alias("message_count"),
        F.count(F.lit(1)).alias("total_count"),
        F.max("event_timestamp").alias("last_active"),
    )
    return top_k(ranked, "total_count", "user_id", limit).withColumns({
        "display_name": display_name(F.col("user_id")),
        "last_active": iso_utc(utc_wall(F.col("last_active"))),
    })


def api_tools(events: DataFrame, team_id: str, days: int = 1, as_of: AsOf = None) -> DataFrame:
    """Announced and completed calls per tool, with the overall total.

    The total is a scalar subquery over the same aggregate, so the tools never
    gather in one window partition and the event scan is shared.
    """
    used = (
        _recent(events, team_id, days, as_of)
        .filter(is_tool_call())
        .groupBy(_tool().alias("name"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    total = used.agg(F.sum("count").alias("total")).scalar()
    return used.select("name", "count", total.alias("total")).orderBy(F.col("count").desc(), "name")


def api_timeline(events: DataFrame, team_id: str, days: int = 7, as_of: AsOf = None) -> DataFrame:
    """Messages, tool calls and sessions per UTC day that has any of them."""
    return (
        _recent(events, team_id, days, as_of)
        .filter(is_message() | is_session_start() | is_tool_call())
        .groupBy(_utc_day().alias("date"))
        .agg(
            F.count_if(is_message()).alias("messages"),
            F.count_if(is_tool_call()).alias("tools"),
            F.count_if(is_session_start()).alias("sessions"),
        )
        .orderBy("date")
    )


def _personal(events: DataFrame, days: int, as_of: AsOf) -> DataFrame:
    # The command compares UTC event times with the local wall clock as is.
    return events.filter(event_since(from_utc(resolve_as_of(as_of) - timedelta(days=days))))


def personal_stats(events: DataFrame, days: int = 7, as_of: AsOf = None) -> DataFrame:
    """One row of totals; features count inside tool calls only."""
    call = is_tool_call()
    return _personal(events, days, as_of).agg(
        F.count_if(is_message()).alias("messages"),
        F.count_if(is_session_start()).alias("sessions"),
        F.count_if(call).alias("tool_calls"),
        F.count_if(call & F.col("is_mcp")).alias("mcp"),
        F.count_if(call & F.col("is_subagent")).alias("subagent"),
    )


def personal_daily(events: DataFrame, days: int = 7, as_of: AsOf = None, width: int = 20) -> DataFrame:
    """Events per UTC day and the length of their bar, the longest being ``width``."""
    daily = (
        _personal(events, days, as_of)
        .groupBy(_utc_day().alias("date"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    longest = daily.agg(F.max("count").alias("longest")).scalar()
    bar = F.floor(F.col("count") / longest * width).cast("bigint")
    return daily.select("date", "count", bar.alias("bar_length")).orderBy("date")


def personal_top_tools(events: DataFrame, days: int = 7, as_of: AsOf = None, k: int = 5) -> DataFrame:
    """Most called tools with their rank."""
    used = (
        _personal(events, days, as_of)
        .filter(is_tool_call())
        .groupBy(_tool().alias("tool_name"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    order = Window.orderBy(F.col("cnt").desc(), "tool_name")
    # At most k rows reach the unpartitioned window.
    return top_k(used, "cnt", "tool_name", k).withColumn("rank", F.row_number().over(order))


def user_activity(events: DataFrame, newest_first: bool = False) -> DataFrame:
    """Events, first and last activity per user."""
    activity = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_timestamp").alias("first_active"),
        F.max("event_timestamp").alias("last_active"),
    )
    if newest_first:
        return activity.orderBy(F.col("last_active").desc(), "user_id")
    return activity.orderBy("user_id")


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of every named table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)
