import datetime as dt

from eventloom.operators import service_stats as C
from eventloom.operators.marts import user_summary
from eventloom.sources.testdata import AS_OF, TEAM
from frames import by, events, one, records

AT = (TEAM, 1, AS_OF)  # current period: from 2024-01-30 00:00 Tokyo time


def test_api_counts_subagents_by_stop_event(spark):
    df = events(spark, {"event_type": "SubagentStop", "is_subagent": True},
                {"event_type": "PostToolUse", "tool_name": "Task", "is_subagent": True},
                {"event_timestamp": "2024-01-29 10:00:00", "is_mcp": True, "user_id": "bob"},
                {"event_timestamp": "2023-01-29 10:00:00", "user_id": "old"},
                {"is_mcp": True, "team_id": "other", "user_id": "eve"})
    row = one(C.api_stats(df, user_summary(df), *AT))
    assert (row["subagent_count"], row["subagent_change"]) == (1, 100.0)
    assert (row["mcp_count"], row["mcp_change"]) == (0, -100.0)
    assert (row["active_users"], row["total_users"]) == (1, 3)
    assert row["period_start"] == "2024-01-29T15:00:00.000000+00:00"
    assert row["period_end"] == "2024-01-30T15:00:00.000000+00:00"


def test_api_stats_of_nothing(spark):
    row = one(C.api_stats(events(spark), user_summary(events(spark)), *AT))
    assert row["skill_count"] == 0 and row["skill_change"] == 0.0 and row["total_users"] == 0


def test_api_tools_leave_failures_out(spark):
    df = events(spark, *[{"event_type": t, "tool_name": "Bash"} for t in
                         ("PreToolUse", "PostToolUse", "PostToolUseFailure")],
                {"event_type": "PreToolUse", "tool_name": None})
    rows = by(C.api_tools(df, *AT), "name")
    assert rows["Bash"] == {"name": "Bash", "count": 2, "total": 3}
    assert rows["unknown"]["count"] == 1


def test_api_timeline_uses_utc_days(spark):
    df = events(spark, {"event_type": "SessionStart", "event_timestamp": "2024-01-30 08:00:00"},
                {"event_type": "UserPromptSubmit", "event_timestamp": "2024-01-30 09:00:00"},
                {"event_type": "Stop", "event_timestamp": "2024-01-31 10:00:00"})
    rows = by(C.api_timeline(df, *AT), "date")
    assert set(rows) == {dt.date(2024, 1, 29), dt.date(2024, 1, 30)}
    assert rows[dt.date(2024, 1, 29)]["sessions"] == 1


def test_api_users(spark):
    df = events(spark, {}, {"event_timestamp": "2024-01-30 12:00:00", "is_command": True},
                {"user_id": "bob"})
    rows = records(C.api_users(df, *AT, limit=1))
    assert [(r["display_name"], r["total_count"], r["command_count"]) for r in rows] == [("ann", 2, 1)]
    assert rows[0]["last_active"] == "2024-01-30T03:00:00.000000+00:00"


def test_personal_stats_count_features_in_tool_calls_only(spark):
    df = events(spark, {"event_type": "PreToolUse", "tool_name": "Task", "is_subagent": True},
                {"event_type": "SubagentStop", "is_subagent": True},
                {"event_type": "PostToolUseFailure", "tool_name": "x", "is_mcp": True})
    row = one(C.personal_stats(df, 7, AS_OF))
    assert (row["tool_calls"], row["subagent"], row["mcp"]) == (1, 1, 0)


def test_personal_bars(spark):
    df = events(spark, *[{}] * 3, {"event_timestamp": "2024-01-29 12:00:00"})
    rows = by(C.personal_daily(df, 7, AS_OF), "date")
    assert rows[dt.date(2024, 1, 30)]["bar_length"] == 20
    assert rows[dt.date(2024, 1, 29)]["bar_length"] == 6


def test_personal_top_tools(spark):
    df = events(spark, *[{"event_type": "PreToolUse", "tool_name": t} for t in "bbaac"])
    rows = records(C.personal_top_tools(df, 7, AS_OF, k=2))
    assert [(r["rank"], r["tool_name"], r["cnt"]) for r in rows] == [(1, "a", 2), (2, "b", 2)]


def test_user_activity_orders(spark):
    df = events(spark, {"user_id": "b", "event_timestamp": "2024-01-31 10:00:00"}, {"user_id": "a"})
    assert [r["user_id"] for r in records(C.user_activity(df))] == ["a", "b"]
    assert [r["user_id"] for r in records(C.user_activity(df, newest_first=True))] == ["b", "a"]


def test_layer_row_counts(spark):
    rows = by(C.layer_row_counts({"x": events(spark, {}, {}), "y": events(spark)}), "table_name")
    assert rows["x"]["row_count"] == 2 and rows["y"]["row_count"] == 0
