import datetime as dt

import pytest

from eventloom.operators import dashboard as Q
from eventloom.operators import derived as D
from eventloom.operators import marts as A
from eventloom.operators import views as V
from eventloom.operators.clean import remap_users
from eventloom.sources.testdata import AS_OF, TEAM, usage_events
from frames import by, events, one, records

SF = "/root/testdata/sf0.001"
AT = (TEAM, 7, AS_OF)


def marts(df):
    return A.daily_summary(df), A.user_summary(df), A.tool_summary(df)


def test_empty_input_still_gives_one_row(spark):
    daily, users, tools = marts(events(spark))
    kpi = one(Q.kpi_overview(daily, users, *AT))
    assert kpi["msg_count"] is None and kpi["prev_mcp"] is None
    assert kpi["active_users"] == kpi["prev_users"] == kpi["total_users"] == 0
    roi = one(Q.roi_kpi(daily, users, tools, *AT))
    assert len(roi) == 23
    assert roi["tool_execs"] is None and roi["feat_total"] == 0
    assert one(Q.feature_adoption(users, *AT))["total_users"] == 0
    assert one(Q.session_kpi(events(spark), *AT))["total_sessions"] == 0
    assert {r["value"] for r in records(D.overview_cards(Q.kpi_overview(daily, users, *AT)))} == {0}
    assert one(D.roi_summary(Q.roi_kpi(daily, users, tools, *AT), 7))["depth_score"] == 0.0
    assert one(D.session_cards(Q.session_kpi(events(spark), *AT)))["limit_stop_pct"] == 0.0
    assert [r["advice"] for r in records(D.insights(Q.kpi_overview(daily, users, *AT)).orderBy("position"))] == [
        "watch_trend", "code_generation", "share_skills", "no_limit_hits", "reach_inactive"]


def test_kpi_periods_and_distinct_users(spark):
    msg = {"event_type": "UserPromptSubmit"}
    df = events(
        spark,
        {**msg, "event_timestamp": "2024-01-24 00:00:00"},  # first current day
        {**msg, "event_timestamp": "2024-01-31 08:00:00"},  # after the clock: still current
        {**msg, "event_timestamp": "2024-01-23 23:59:59"},  # last previous moment
        {**msg, "event_timestamp": "2024-01-17 00:00:00", "user_id": "bob"},
        {**msg, "event_timestamp": "2024-01-16 23:59:59", "user_id": "old"},
        {**msg, "event_timestamp": "2024-01-30 00:00:00", "user_id": "eve", "team_id": "other"},
    )
    row = one(Q.kpi_overview(*marts(df)[:2], *AT))
    assert (row["msg_count"], row["prev_msg"]) == (2, 2)
    assert (row["active_users"], row["prev_users"], row["total_users"]) == (1, 2, 3)


def test_session_stop_is_the_greatest_reason(spark):
    stops = {"s1": ["normal"], "s2": ["normal", "unknown"], "s3": ["usage_limit", "unknown"],
             "s4": [None], "s5": ["normal", "normal"], "s6": ["normal", "zzz"], "s7": ["aborted", "normal"]}
    rows = [{"session_id": s, "stop_reason": r} for s, reasons in stops.items() for r in reasons]
    got = one(Q.session_kpi(events(spark, *rows), *AT))
    brute = sum(max([r for r in reasons if r] or ["unknown"]) == "normal" for reasons in stops.values())
    assert got["normal_stopped"] == brute == 3
    assert got["limit_stopped"] == 1 and got["total_sessions"] == 7


def test_blank_project_stays_blank_in_the_ranking(spark):
    df = events(spark, {"project_name": ""}, {"project_name": None}, {"project_name": None, "user_id": "b"})
    rows = by(Q.project_ranking(df, *AT), "project_name")
    assert rows["(no project)"]["user_count"] == 2 and rows[""]["event_count"] == 1


def test_ties_are_broken_by_key(spark):
    df = events(spark, *[{"tool_name": t} for t in "fedcba"])
    tools = A.tool_summary(df)
    assert [r["tool_name"] for r in records(Q.tool_leaderboard(tools, *AT, limit=3))] == ["a", "b", "c"]
    assert {r["tool_name"] for r in records(Q.tool_trend(tools, *AT, k=2))} == {"a", "b"}
    assert [r["tool_name"] for r in records(Q.user_top_tools(df, TEAM, "ann@x.com", 7, AS_OF, limit=2))] == ["a", "b"]


def test_trend_is_capped_at_ninety_days(spark):
    df = events(spark, {"event_timestamp": "2023-11-02 00:00:00"}, {"event_timestamp": "2023-11-01 23:00:00"})
    daily, users, _ = marts(df)
    assert [r["event_date"] for r in records(Q.timeline(daily, TEAM, 365, AS_OF))] == [dt.date(2023, 11, 2)]
    assert Q.productivity_trend(daily, users, TEAM, 365, AS_OF).count() == 1
    assert Q.weekly_feature_mix(daily, TEAM, 365, AS_OF).count() == 1
    assert Q.user_leaderboard(users, TEAM, 365, AS_OF).count() == 1


def test_quote_in_a_user_id(spark):
    users = A.user_summary(events(spark, {"user_id": "o'neil"}))
    assert Q.user_timeline(users, TEAM, "o'neil", 7, AS_OF).count() == 1


def test_users_without_messages_are_left_out(spark):
    df = events(spark, {}, {"user_id": "bob", "event_type": "UserPromptSubmit", "is_skill": True})
    row = one(D.user_bubble(Q.user_efficiency(A.user_summary(df), *AT)))
    assert row["user_id"] == "bob" and row["advanced_features"] == 1 and row["marker_size"] == 8.0


def test_weekly_mix_never_goes_negative(spark):
    df = events(spark, {"tool_name": None, "is_skill": True}, {"event_type": "UserPromptSubmit"})
    row = one(D.weekly_mix_share(Q.weekly_feature_mix(A.daily_summary(df), *AT)))
    assert row["basic_tools_pct"] == 0.0 and row["skills_pct"] == 50.0


def test_dense_spines(spark):
    df = events(spark, {"is_usage_limit": True})  # a Tuesday at 10
    hours = by(D.limit_hours_dense(Q.limit_hits_by_hour(df, *AT)), "hour_of_day")
    assert len(hours) == 24 and sum(r["limit_hits"] for r in hours.values()) == hours[10]["limit_hits"] == 1
    cells = records(D.heatmap_dense(Q.heatmap(df, *AT)))
    assert len(cells) == 168 and cells[0]["day_order"] == 0 and cells[0]["dow"] == 1
    assert [c for c in cells if c["event_count"]] == [
        {"day_order": 1, "dow": 2, "weekday": "火", "hour_of_day": 10, "event_count": 1}]
    wide = records(D.heatmap_pivot(Q.heatmap(df, *AT)))
    assert [r["weekday"] for r in wide] == list("月火水木金土日") and wide[1]["h10"] == 1


def test_adoption_long(spark):
    df = events(spark, {"is_mcp": True}, {"user_id": "b"}, {"user_id": "c"})
    rows = by(D.adoption_long(Q.feature_adoption(A.user_summary(df), *AT)), "feature")
    assert rows["MCP"]["feature_pct"] == 33 and rows["MCP"]["non_adopters"] == 2
    assert rows["Skill"]["users"] == 0 and list(rows) == ["Skill", "MCP", "Subagent", "Command"]


def test_leaderboard_rows(spark):
    df = events(spark, {"is_mcp": True}, {}, {"user_id": "bob", "is_subagent": True})
    rows = records(D.user_ranked(Q.user_leaderboard(A.user_summary(df), *AT), AS_OF))
    assert [(r["rank"], r["display_name"], r["tags"], r["last_seen"]) for r in rows] == [
        (1, "ann", ["mcp"], "14 hours"), (2, "bob", ["agent"], "14 hours")]


def test_tool_tiers(spark):
    df = events(spark, *[{"tool_name": "a", "tool_success": True}] * 9, {"tool_name": "a", "tool_success": False},
                {"tool_name": "b"})
    rows = by(D.tool_tiers(Q.tool_leaderboard(A.tool_summary(df), *AT)), "tool_name")
    assert rows["a"]["tier"] == "good" and rows["b"]["tier"] == "bad"


@pytest.fixture(scope="module")
def ev(spark):
    return usage_events(spark, SF).cache()


def test_monthly_active_agrees_with_the_event_view(ev):
    mart = by(Q.monthly_active(*marts(ev)[:2], TEAM), "month")
    view = by(V.monthly_active_events(ev).filter(f"team_id = '{TEAM}'"), "month")
    assert mart.keys() == view.keys()
    for month, row in mart.items():
        assert (row["active_users"], row["messages"]) == (view[month]["active_users"], view[month]["messages"])


def test_remap_before_and_after_the_mart(ev):
    mapping = {"user8@example.com": "user1@example.com"}
    moved = Q.user_leaderboard(A.user_summary(remap_users(ev, mapping)), *AT)
    assert "user8@example.com" not in {r["user_id"] for r in records(moved)}
