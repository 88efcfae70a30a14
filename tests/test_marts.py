import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import marts as A
from eventloom.operators import views as V
from eventloom.schema import MART_COUNTERS
from eventloom.sources.testdata import usage_events
from frames import by, events, one, records

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ev(spark):
    return usage_events(spark, SF).cache()


def same(a, b):
    return sorted(map(repr, records(a.select(*b.columns)))) == sorted(map(repr, records(b)))


def test_success_rate_ignores_unknown_outcomes(spark):
    df = events(
        spark, {"tool_name": "Bash", "tool_success": True}, {"tool_name": "Bash", "tool_success": False},
        {"tool_name": "Bash"}, {"user_id": "bob"},
    )
    row = one(A.daily_summary(df))
    assert row["success_rate"] == 50.0
    assert (row["total_events"], row["tool_execution_count"], row["active_users"]) == (4, 3, 2)
    # The view divides by all rows that name a tool, unknown outcomes included.
    assert one(V.tool_ranking(df))["success_rate"] == 33.3


def test_no_outcome_at_all_gives_no_rate(spark):
    assert one(A.daily_summary(events(spark, {})))["success_rate"] is None


def test_user_mart_adds_up_to_daily_mart(ev):
    daily = A.daily_summary(ev).select("summary_date", "team_id", *MART_COUNTERS)
    summed = A.user_summary(ev).groupBy("summary_date", "team_id").agg(
        *[F.sum(c).alias(c) for c in MART_COUNTERS])
    assert same(summed, daily)


def test_shared_base_builds_the_same_marts(ev):
    shared = A.marts_from_base(A.usage_base(ev, by_tool=True))
    assert same(shared["daily_summary"], A.daily_summary(ev))
    assert same(shared["user_summary"], A.user_summary(ev))
    assert same(shared["tool_summary"], A.tool_summary(ev))


def test_overview_extends_kpi_metrics(ev):
    kpi = V.kpi_metrics(ev)
    assert same(V.overview_daily(ev), kpi)


def test_blank_and_missing_sessions_are_groups(spark):
    df = events(spark, {"session_id": ""}, {"session_id": "", "event_timestamp": "2024-01-30 11:30:30"},
                {"session_id": None}, {"session_id": "", "user_id": "bob"})
    rows = {(r.session_id, r.user_id): r for r in V.session_stats(df).collect()}
    assert len(rows) == 3
    assert rows[("", "ann@x.com")].duration_min == 90
    assert rows[(None, "ann@x.com")].event_count == 1


def test_blank_project_is_no_project(spark):
    df = events(spark, {"project_name": ""}, {"project_name": None}, {"project_name": "web"})
    assert {r.project_name: r.event_count for r in V.project_stats(df).collect()} == {
        "(no project)": 2, "web": 1}


def test_monthly_distincts_are_not_added_over_days(spark):
    df = events(spark, {"event_timestamp": "2024-01-01 00:00:00"}, {"event_timestamp": "2024-01-02 00:00:00"},
                {"event_timestamp": "2024-01-03 00:00:00", "user_id": "bob", "session_id": "s1"},
                {"event_timestamp": "2024-02-01 00:00:00", "session_id": None})
    rows = by(V.monthly_active_events(df), "month")
    jan, feb = rows[dt.date(2024, 1, 1)], rows[dt.date(2024, 2, 1)]
    assert (jan["active_users"], jan["sessions"], jan["total_events"]) == (2, 1, 3)
    assert (feb["active_users"], feb["sessions"]) == (1, 0)


def test_feature_users_are_counted_once(spark):
    df = events(spark, {"is_mcp": True}, {"is_mcp": True}, {"user_id": "bob", "is_skill": True},
                {"user_id": "cid"})
    row = one(V.feature_adoption_daily(df))
    assert (row["total_users"], row["mcp_users"], row["skill_users"], row["command_users"]) == (3, 1, 1, 0)


def test_user_views(spark):
    df = events(spark, {"event_type": "UserPromptSubmit"},
                {"event_timestamp": "2024-01-02 03:00:00", "is_file_operation": True})
    rank, stats = one(V.user_ranking(df)), one(V.user_stats_all(df))
    assert rank["display_name"] == "ann" and rank["message_count"] == 1
    assert stats["first_active_date"] == dt.date(2024, 1, 2) and stats["file_op_count"] == 1


def test_mean_output_length(spark):
    df = events(spark, {"tool_name": "Read", "output_length": 1}, {"tool_name": "Read", "output_length": 4},
                {"tool_name": "Read"})
    assert one(V.tool_stats_daily(df))["avg_output_length"] == 2.5
