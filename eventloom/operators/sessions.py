"""Sessions from daily partial rows.

A session-day holds what one day's events say about a session of a user in a
team.  Loads add to the days they touch; reports join the days of a session,
which may run over midnight, without going back to the events.
"""

from __future__ import annotations

from datetime import time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.clock import AsOf, date_lit, event_since, for_team, minutes_between, resolve_as_of
from eventloom.functions.counters import has_tool, is_message, sums

_KEY = ("session_id", "user_id", "team_id")
_COUNTS = ("event_count", "message_count", "tool_count")
_FLAGS = ("is_limit", "has_normal", "has_greater")


def _flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def session_days(events: DataFrame) -> DataFrame:
    """One row per session, user, team and day of its events."""
    reason = F.col("stop_reason")
    return events.groupBy(*_KEY, "event_date").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(is_message()).alias("message_count"),
        F.count_if(has_tool()).alias("tool_count"),
        _flag(reason == "usage_limit").alias("is_limit"),
        _flag(reason == "normal").alias("has_normal"),
        _flag(reason > "normal").alias("has_greater"),
    )


def session_rows(events: DataFrame) -> DataFrame:
    """Every event as a session-day of its own, for ``merged_session_days`` to put together."""
    reason = F.col("stop_reason")

    def once(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return events.select(
        *_KEY, "event_date",
        F.col("event_timestamp").alias("session_start"),
        F.col("event_timestamp").alias("session_end"),
        F.lit(1).cast("bigint").alias("event_count"),
        once(is_message()).cast("bigint").alias("message_count"),
        once(has_tool()).cast("bigint").alias("tool_count"),
        once(reason == "usage_limit").alias("is_limit"),
        once(reason == "normal").alias("has_normal"),
        once(reason > "normal").alias("has_greater"),
    )


def joined_days(days: DataFrame, *keys: str) -> DataFrame:
    """Session-days (or parts of one) put together per ``keys``."""
    return days.groupBy(*keys).agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        *sums(_COUNTS),
        *[F.max(name).alias(name) for name in _FLAGS],
    )


def merged_session_days(parts: DataFrame) -> DataFrame:
    """Rows that lie in several parts, one per session and day."""
    return joined_days(parts, *_KEY, "event_date")


def session_stats(days: DataFrame) -> DataFrame:
    """Span and size of every session, over all its days."""
    return joined_days(days, *_KEY).select(
        *_KEY, "session_start", "session_end", *_COUNTS,
        minutes_between(F.col("session_start"), F.col("session_end")).alias("duration_min"),
    )


def period_days(days: DataFrame, events: DataFrame, length: int, as_of: AsOf = None) -> DataFrame:
    """Session-days of a rolling period.

    Whole days come from the stored rows.  Only the day that the period's start
    cuts is taken from its events, and none is if the period starts at midnight.
    """
    start = resolve_as_of(as_of) - timedelta(days=length)
    if start.time() == time():
        return days.filter(F.col("event_date") >= date_lit(start.date()))
    whole = days.filter(F.col("event_date") > date_lit(start.date()))
    cut = events.filter(event_since(start) & (F.col("event_date") == date_lit(start.date())))
    return whole.unionByName(session_days(cut))


def session_kpi(days: DataFrame, events: DataFrame, team_id: str, length: int,
                as_of: AsOf = None) -> DataFrame:
    """One row about the period's sessions, as from the events themselves."""
    recent = period_days(for_team(days, team_id), for_team(events, team_id), length, as_of)
    sessions = joined_days(recent, "session_id", "user_id")
    minutes = minutes_between(F.col("session_start"), F.col("session_end"))
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.round(F.avg(minutes), 1).alias("avg_duration_min"),
        F.sum("is_limit").alias("limit_stopped"),
        F.count_if((F.col("has_normal") == 1) & (F.col("has_greater") == 0)).alias("normal_stopped"),
        F.count_distinct("user_id").alias("active_users_sess"),
    )
