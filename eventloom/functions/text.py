"""Text rules of single events as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.schema import (
    COMMAND_TOOLS,
    FILE_TOOLS,
    LIMIT_PHRASES,
    TRANSCRIPT_TAIL_LINES,
)

# Line ends other than a newline that a universal-newline reader recognises.
OTHER_LINE_ENDS = "\\r\\n?|[\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """Whether the lower-cased text holds any phrase; NULL text holds none."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(or_, [lowered.contains(phrase) for phrase in phrases])


def is_usage_limit(text: Column) -> Column:
    return contains_any(text, LIMIT_PHRASES)


def tool_flags(name: Column, tool_input: Column) -> Column:
    """Struct of the five tool categories; they do not exclude one another."""
    lowered = F.lower(name)

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return F.struct(
        flag(lowered.startswith("notebook")).alias("skill"),
        flag((lowered == "task") | lowered.startswith("task_")).alias("subagent"),
        (flag(lowered.startswith("mcp__")) | flag(tool_input.contains("mcp_server"))).alias("mcp"),
        flag(lowered.isin(*COMMAND_TOOLS)).alias("command"),
        flag(lowered.isin(*FILE_TOOLS)).alias("file_operation"),
    )


def last_lines(text: Column, lines: int = TRANSCRIPT_TAIL_LINES) -> Column:
    """The last lines of a text, joined by spaces.

    A cheap cut at newlines first leaves one newline-ended piece more than
    asked for, which holds at least as many lines of any kind, so only the end
    of a long text is searched for the rarer line ends.
    """
    piece = F.substring_index(text, "\n", -(lines + 1))
    piece = F.regexp_replace(piece, OTHER_LINE_ENDS, "\n")
    piece = F.regexp_replace(piece, "\n\\z", "")
    return F.replace(F.substring_index(piece, "\n", -lines), F.lit("\n"), F.lit(" "))


def stop_reason_of(tail: Column, phrases: Iterable[str] = LIMIT_PHRASES) -> Column:
    """unknown without a transcript, else usage_limit or normal."""
    return (
        F.when(tail.isNull(), F.lit("unknown"))
        .when(contains_any(tail, phrases), F.lit("usage_limit"))
        .otherwise(F.lit("normal"))
    )


def strip(text: Column) -> Column:
    return F.regexp_replace(text, "^\\s+|\\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def user_identifier(
    explicit: Column, username: Column, hostname: Column, anonymize: bool = False
) -> Column:
    """Explicit id when given, else user@host, as 16 hex digits if anonymous."""
    account = F.concat_ws(
        "@",
        F.coalesce(blank_to_null(username), F.lit("unknown")),
        F.coalesce(hostname, F.lit("")),
    )
    if anonymize:
        account = F.substring(F.sha2(account, 256), 1, 16)
    return F.coalesce(blank_to_null(strip(explicit)), account)


def project_name(project_dir: Column) -> Column:
    """Last segment of a POSIX or Windows path; unknown without a path."""
    trimmed = F.regexp_replace(project_dir, "[/\\\\]+$", "")
    segment = F.element_at(F.split(trimmed, "[/\\\\]"), -1)
    return F.when(F.coalesce(project_dir, F.lit("")) == "", F.lit("unknown")).otherwise(
        F.regexp_replace(segment, "^[A-Za-z]:$", "")
    )


def project_display(name: Column) -> Column:
    """Short project name: the part after the last slash."""
    return F.element_at(F.split(name, "/"), -1)


def display_name(user_id: Column) -> Column:
    """Part of a user id before the first @."""
    return F.split_part(user_id, F.lit("@"), F.lit(1))


def label(col: Column, mapping: dict) -> Column:
    """Look a value up in a small fixed mapping; unknown values pass through."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[col], col.cast("string"))
