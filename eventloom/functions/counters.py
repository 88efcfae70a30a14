"""Named event counters shared by marts, views and dashboard queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_message() -> Column:
    return F.col("event_type") == "UserPromptSubmit"


def is_session_start() -> Column:
    return F.col("event_type") == "SessionStart"


def is_tool_call() -> Column:
    """A completed or announced call; failures are not counted here."""
    return F.col("event_type").isin("PostToolUse", "PreToolUse")


def has_tool() -> Column:
    """Any event that names a tool: announced, completed or failed."""
    return F.col("tool_name").isNotNull()


def event_counters() -> dict[str, Column]:
    """Row conditions by counter name."""
    return {
        "message_count": is_message(),
        "session_count": is_session_start(),
        "tool_execution_count": has_tool(),
        "mcp_count": F.col("is_mcp"),
        "subagent_count": F.col("is_subagent"),
        "command_count": F.col("is_command"),
        "skill_count": F.col("is_skill"),
        "file_op_count": F.col("is_file_operation"),
        "limit_hit_count": F.col("is_usage_limit"),
    }


def pick(names: Sequence[str], rename: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Some event counters, in the given order, under their output names."""
    known = event_counters()
    rename = rename or {}
    return {rename.get(name, name): known[name] for name in names}


def counts(conditions: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def sums(names: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def counts_with_users(
    events: DataFrame,
    keys: Sequence[str],
    conditions: Mapping[str, Column],
    total: str,
    users: str,
    extra: Sequence[tuple[str, Column, Column]] = (),
) -> DataFrame:
    """Counters and exact distinct users per key, in two aggregation levels.

    The first level groups by key and user, so one hot key is spread over its
    users before the small second level adds the per-user rows up.  ``extra``
    holds (name, first-level aggregate, second-level aggregate) triples.
    """
    per_user = events.groupBy(*keys, "user_id").agg(
        F.count(F.lit(1)).alias(total),
        *counts(conditions),
        *[first.alias(name) for name, first, _ in extra],
    )
    return per_user.groupBy(*keys).agg(
        *sums([total, *conditions]),
        F.count("user_id").alias(users),
        *[second.alias(name) for name, _, second in extra],
    )
