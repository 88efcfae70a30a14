"""Parameterised dashboard queries over the marts and the clean events.

Every function takes the team, the period in days and an explicit ``as_of``
clock, and returns a lazy frame.  Ranked results break ties by their key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.clock import (
    AsOf,
    cap_days,
    current_dates,
    current_events,
    date_in_current,
    date_in_previous,
    day_of_week,
    for_team,
    minutes_between,
    month_start,
    week_start,
)
from eventloom.functions.counters import counts_with_users, pick, sums
from eventloom.functions.metrics import percent, ratio
from eventloom.functions.text import display_name
from eventloom.operators.distinct_users import user_counts
from eventloom.schema import NO_PROJECT, TREND_CAP_DAYS

_FEATURES = {"skill": "skill_count", "mcp": "mcp_count", "sa": "subagent_count", "cmd": "command_count"}


def top_k(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """Largest ``k`` rows by a measure, ties broken by the key."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc()).limit(k)


def join_topk(df: DataFrame, topk: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a top-k frame; its measured size decides the join."""
    return df.join(topk.select(key), key, "left_semi")


def one_row(*parts: DataFrame) -> DataFrame:
    """Put single-row frames side by side without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _sum_when(condition: Column, column: str, alias: str) -> Column:
    return F.sum(F.when(condition, F.col(column))).alias(alias)


# --- overview ---------------------------------------------------------------


def _period_users(user_days: DataFrame, team_id: str, **periods: Column) -> DataFrame:
    """One row: distinct users of each period and of all time, from bitmaps."""
    return user_counts(for_team(user_days, team_id), {**periods, "total_users": F.lit(True)})


def kpi_overview(daily: DataFrame, user_sum: DataFrame | None, team_id: str, days: int,
                 as_of: AsOf = None, user_days: DataFrame | None = None) -> DataFrame:
    """One row of current and previous totals and user counts.

    With ``user_days`` users are counted from bitmaps and ``user_sum`` is not read.
    """
    current, previous = date_in_current(days, as_of), date_in_previous(days, as_of)
    measures = {"message_count": "msg", "session_count": "sess", "skill_count": "skill",
                "mcp_count": "mcp"}
    totals = for_team(daily, team_id).filter(current | previous).agg(
        *[_sum_when(current, col, f"{short}_count") for col, short in measures.items()],
        _sum_when(current, "limit_hit_count", "limit_hits"),
        *[_sum_when(previous, col, f"prev_{short}") for col, short in measures.items()],
    )
    if user_days is not None:
        return one_row(totals, _period_users(
            user_days, team_id, active_users=current, prev_users=previous))
    users = (
        for_team(user_sum, team_id)
        .groupBy("user_id")
        .agg(F.max(current).alias("now"), F.max(previous).alias("before"))
        .agg(
            F.count_if("now").alias("active_users"),
            F.count_if("before").alias("prev_users"),
            F.count("user_id").alias("total_users"),
        )
    )
    return one_row(totals, users)


def timeline(daily: DataFrame, team_id: str, days: int, as_of: AsOf = None,
             max_days: int | None = TREND_CAP_DAYS) -> DataFrame:
    """Messages, tools, sessions and limit hits per day, at most ``max_days`` back (None: no limit)."""
    return (
        current_dates(for_team(daily, team_id), cap_days(days, max_days), as_of)
        .select(
            F.col("summary_date").alias("event_date"),
            F.col("message_count").alias("messages"),
            F.col("tool_execution_count").alias("tools"),
            F.col("session_count").alias("sessions"),
            F.col("limit_hit_count").alias("limit_hits"),
        )
        .orderBy("event_date")
    )


def heatmap(events: DataFrame, team_id: str, days: int, as_of: AsOf = None) -> DataFrame:
    """Events per weekday (0 = Sunday) and hour."""
    return (
        current_events(for_team(events, team_id), days, as_of)
        .groupBy(
            day_of_week(F.col("event_timestamp")).alias("dow"),
            F.hour("event_timestamp").alias("hour_of_day"),
        )
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("dow", "hour_of_day")
    )


# --- users ------------------------------------------------------------------


def user_leaderboard(user_sum: DataFrame, team_id: str, days: int, as_of: AsOf = None,
                     limit: int = 30) -> DataFrame:
    """Busiest users of the period with their counters."""
    ranked = (
        current_dates(for_team(user_sum, team_id), days, as_of)
        .groupBy("user_id")
        .agg(
            *sums(["skill_count", "subagent_count", "mcp_count", "command_count",
                   "message_count", "session_count"]),
            F.sum("limit_hit_count").alias("limit_hits"),
            F.sum("total_events").alias("total_count"),
            F.max("last_active_at").alias("last_active"),
            F.min("summary_date").alias("first_active"),
        )
    )
    return top_k(ranked, "total_count", "user_id", limit).withColumn(
        "display_name", display_name(F.col("user_id"))
    )


def user_timeline(user_sum: DataFrame, team_id: str, user_id: str, days: int,
                  as_of: AsOf = None) -> DataFrame:
    """One user's messages, sessions and limit hits per day."""
    return (
        current_dates(for_team(user_sum, team_id), days, as_of)
        .filter(F.col("user_id") == F.lit(user_id))
        .select(
            F.col("summary_date").alias("event_date"),
            F.col("message_count").alias("messages"),
            F.col("session_count").alias("sessions"),
            F.col("limit_hit_count").alias("limit_hits"),
        )
        .orderBy("event_date")
    )


def user_top_tools(events: DataFrame, team_id: str, user_id: str, days: int,
                   as_of: AsOf = None, limit: int = 10) -> DataFrame:
    """One user's most used tools."""
    used = (
        current_events(for_team(events, team_id), days, as_of)
        .filter((F.col("user_id") == F.lit(user_id)) & F.col("tool_name").isNotNull())
        .groupBy("tool_name")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return top_k(used, "cnt", "tool_name", limit)


# --- tools ------------------------------------------------------------------


def tool_leaderboard(tool_sum: DataFrame, team_id: str, days: int, as_of: AsOf = None,
                     limit: int = 15) -> DataFrame:
    """Most used tools with their success rate."""
    used = (
        current_dates(for_team(tool_sum, team_id), days, as_of)
        .groupBy("tool_name")
        .agg(F.sum("execution_count").alias("total_count"), *sums(["success_count"]))
        .withColumn("success_rate", percent(F.col("success_count"), F.col("total_count")))
    )
    return top_k(used, "total_count", "tool_name", limit)


def tool_trend(tool_sum: DataFrame, team_id: str, days: int, as_of: AsOf = None,
               k: int = 5) -> DataFrame:
    """Daily counts of the period's most used tools."""
    period = current_dates(for_team(tool_sum, team_id), days, as_of)
    used = period.groupBy("tool_name").agg(F.sum("execution_count").alias("total"))
    return (
        join_topk(period, top_k(used, "total", "tool_name", k), "tool_name")
        .select(
            F.col("summary_date").alias("event_date"),
            "tool_name",
            F.col("execution_count").alias("cnt"),
        )
        .orderBy("event_date", "tool_name")
    )


# --- sessions ---------------------------------------------------------------


def session_kpi(events: DataFrame, team_id: str, days: int, as_of: AsOf = None) -> DataFrame:
    """One row about the period's sessions.

    A session counts as normal when "normal" is the greatest of its stop
    reasons; two flags state that without carrying strings in the aggregate.
    """
    reason = F.col("stop_reason")
    sessions = (
        current_events(for_team(events, team_id), days, as_of)
        .groupBy("session_id", "user_id")
        .agg(
            F.min("event_timestamp").alias("start_time"),
            F.max("event_timestamp").alias("end_time"),
            F.max(F.when(reason == "usage_limit", 1).otherwise(0)).alias("is_limit"),
            F.max(F.when(reason == "normal", 1).otherwise(0)).alias("has_normal"),
            F.max(F.when(reason > "normal", 1).otherwise(0)).alias("has_greater"),
        )
    )
    minutes = minutes_between(F.col("start_time"), F.col("end_time"))
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.round(F.avg(minutes), 1).alias("avg_duration_min"),
        F.sum("is_limit").alias("limit_stopped"),
        F.count_if((F.col("has_normal") == 1) & (F.col("has_greater") == 0)).alias("normal_stopped"),
        F.count_distinct("user_id").alias("active_users_sess"),
    )


def stop_reasons(events: DataFrame, team_id: str, days: int, as_of: AsOf = None) -> DataFrame:
    """Distinct sessions per stop reason."""
    return (
        current_events(for_team(events, team_id), days, as_of)
        .filter(F.col("event_type") == "Stop")
        .groupBy(F.coalesce("stop_reason", F.lit("unknown")).alias("stop_reason"))
        .agg(F.count_distinct("session_id").alias("session_count"))
        .orderBy(F.col("session_count").desc(), "stop_reason")
    )


def limit_hits_by_hour(events: DataFrame, team_id: str, days: int, as_of: AsOf = None) -> DataFrame:
    """Usage-limit events per hour of day."""
    return (
        current_events(for_team(events, team_id), days, as_of)
        .filter(F.col("is_usage_limit"))
        .groupBy(F.hour("event_timestamp").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("limit_hits"))
        .orderBy("hour_of_day")
    )


# --- projects ---------------------------------------------------------------


def project_ranking(events: DataFrame, team_id: str, days: int, as_of: AsOf = None,
                    limit: int = 15) -> DataFrame:
    """Busiest projects; only a missing name, not a blank one, is renamed."""
    named = current_events(for_team(events, team_id), days, as_of).withColumn(
        "project_name", F.coalesce("project_name", F.lit(NO_PROJECT))
    )
    ranked = counts_with_users(
        named, ["project_name"],
        pick(["message_count", "skill_count", "mcp_count"], {"message_count": "msg_count"}),
        total="event_count", users="user_count",
    )
    return top_k(ranked, "event_count", "project_name", limit)


# --- adoption ---------------------------------------------------------------


def monthly_active(daily: DataFrame, user_sum: DataFrame, team_id: str) -> DataFrame:
    """Distinct users, sessions and messages per month, all history."""
    month = month_start(F.col("summary_date")).alias("month")
    totals = (
        for_team(daily, team_id).groupBy(month)
        .agg(F.sum("session_count").alias("sessions"), F.sum("message_count").alias("messages"))
    )
    users = (
        for_team(user_sum, team_id).groupBy(month)
        .agg(F.count_distinct("user_id").alias("active_users"))
    )
    return users.join(totals, "month").orderBy("month")


def _feature_sums(period: Column, prefix: str) -> list[Column]:
    """Per-user sums of the four features within a period."""
    return [_sum_when(period, col, f"{prefix}{name}") for name, col in _FEATURES.items()]


def feature_adoption(user_sum: DataFrame, team_id: str, days: int, as_of: AsOf = None) -> DataFrame:
    """Users of the period, in all and per feature."""
    per_user = (
        current_dates(for_team(user_sum, team_id), days, as_of)
        .groupBy("user_id")
        .agg(*[F.sum(col).alias(name) for name, col in _FEATURES.items()])
    )
    return per_user.agg(
        F.count("user_id").alias("total_users"),
        F.count_if(F.col("skill") > 0).alias("skill_users"),
        F.count_if(F.col("mcp") > 0).alias("mcp_users"),
        F.count_if(F.col("sa") > 0).alias("subagent_users"),
        F.count_if(F.col("cmd") > 0).alias("command_users"),
    )


# --- return on investment ---------------------------------------------------


def roi_kpi(daily: DataFrame, user_sum: DataFrame, tool_sum: DataFrame, team_id: str, days: int,
            as_of: AsOf = None, user_days: DataFrame | None = None) -> DataFrame:
    """One row of 23 current, previous and total figures; one pass per mart.

    With ``user_days`` the users of all time are counted from bitmaps, and only
    the two periods of the user mart are read.
    """
    current, previous = date_in_current(days, as_of), date_in_previous(days, as_of)
    totals = for_team(daily, team_id).filter(current | previous).agg(
        _sum_when(current, "tool_execution_count", "tool_execs"),
        _sum_when(current, "message_count", "msg_count"),
        _sum_when(current, "session_count", "sess_count"),
        _sum_when(previous, "tool_execution_count", "prev_tool_execs"),
    )
    tools = for_team(tool_sum, team_id).filter(current | previous).agg(
        _sum_when(current, "success_count", "tool_success"),
        _sum_when(current, "execution_count", "tool_total"),
        _sum_when(previous, "success_count", "prev_tool_success"),
        _sum_when(previous, "execution_count", "prev_tool_total"),
    )
    mine = for_team(user_sum, team_id)
    if user_days is not None:
        mine = mine.filter(current | previous)
    per_user = mine.groupBy("user_id").agg(
        F.max(current).alias("now"),
        F.max(previous).alias("before"),
        _sum_when(current, "total_events", "now_events"),
        _sum_when(previous, "total_events", "before_events"),
        *_feature_sums(current, "now_"),
        *_feature_sums(previous, "before_"),
    )
    users = per_user.agg(
        F.count_if("now").alias("active_users"),
        F.sum("now_events").alias("total_events"),
        F.count_if("now").alias("feat_total"),
        *[F.count_if(F.col(f"now_{f}") > 0).alias(f"{f}_users") for f in _FEATURES],
        F.count_if("before").alias("prev_active_users"),
        F.sum("before_events").alias("prev_total_events"),
        F.count_if("before").alias("prev_feat_total"),
        *[F.count_if(F.col(f"before_{f}") > 0).alias(f"prev_{f}_users") for f in _FEATURES],
        F.count("user_id").alias("total_users"),
    )
    if user_days is not None:
        return one_row(totals, tools, users.drop("total_users"), _period_users(user_days, team_id))
    return one_row(totals, tools, users)


def productivity_trend(daily: DataFrame, user_sum: DataFrame, team_id: str, days: int,
                       as_of: AsOf = None,
             max_days: int | None = TREND_CAP_DAYS) -> DataFrame:
    """Executions and messages per active user and day, at most ``max_days`` back (None: no limit)."""
    cap = cap_days(days, max_days)
    totals = (
        current_dates(for_team(daily, team_id), cap, as_of)
        .groupBy("summary_date")
        .agg(
            F.sum("tool_execution_count").alias("tool_execs"),
            F.sum("message_count").alias("messages"),
            F.sum("session_count").alias("sessions"),
        )
    )
    users = (
        current_dates(for_team(user_sum, team_id), cap, as_of)
        .groupBy("summary_date")
        .agg(F.count_distinct("user_id").alias("active_users"))
    )
    return (
        totals.join(users, "summary_date", "left")
        .select(
            F.col("summary_date").alias("event_date"),
            "tool_execs", "messages", "sessions", "active_users",
            ratio(F.col("tool_execs"), F.col("active_users")).alias("tools_per_user"),
            ratio(F.col("messages"), F.col("active_users")).alias("msgs_per_user"),
        )
        .orderBy("event_date")
    )


def user_efficiency(user_sum: DataFrame, team_id: str, days: int, as_of: AsOf = None) -> DataFrame:
    """Users with messages: volume against use of advanced features."""
    return (
        current_dates(for_team(user_sum, team_id), days, as_of)
        .groupBy("user_id")
        .agg(
            F.sum("message_count").alias("messages"),
            F.sum("session_count").alias("sessions"),
            F.sum("total_events").alias("total_events"),
            (F.sum("skill_count") + F.sum("mcp_count") + F.sum("subagent_count")).alias(
                "advanced_features"
            ),
        )
        .filter(F.col("messages") > 0)
        .withColumn("display_name", display_name(F.col("user_id")))
        .orderBy(F.col("total_events").desc(), "user_id")
    )


def weekly_feature_mix(daily: DataFrame, team_id: str, days: int, as_of: AsOf = None,
             max_days: int | None = TREND_CAP_DAYS) -> DataFrame:
    """Messages, skills, mcp and other tool use per ISO week, at most ``max_days`` back (None: no limit)."""
    basic = F.sum("tool_execution_count") - F.sum("skill_count") - F.sum("mcp_count")
    return (
        current_dates(for_team(daily, team_id), cap_days(days, max_days), as_of)
        .groupBy(week_start(F.col("summary_date")).alias("week_start"))
        .agg(
            F.sum("message_count").alias("messages"),
            F.sum("skill_count").alias("skills"),
            F.sum("mcp_count").alias("mcp"),
            F.greatest(basic, F.lit(0)).alias("basic_tools"),
        )
        .orderBy("week_start")
    )
