"""Loads that add to daily states: deltas, repairs, journal, sessions and user bitmaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import dashboard as Q
from eventloom.operators import distinct_users as U
from eventloom.operators import service_stats as C
from eventloom.operators import sessions as S
from eventloom.operators import views as V
from eventloom.plans import pipeline as P
from eventloom.sources.raw_logs import list_files, new_files
from frames import events as clean_events
from frames import one, records
from test_pipeline import Site, line

TEAM = "default-team"


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def same(got, want):
    return sorted(map(repr, records(got.select(*want.columns)))) == sorted(map(repr, records(want)))


def check_states(site):
    """States, marts, sessions and bitmaps equal a build from all events."""
    spark, house = site.spark, site.house
    stored = house.events(spark)
    for state in P.STATES:
        assert same(house.state(spark, state), state.build(stored).select(*state.schema.fieldNames())), state.name
    site.check_marts()
    assert same(S.session_stats(house.session_days(spark)), V.session_stats(stored))
    known = {r.user_id for r in stored.select("user_id").collect()}
    numbers = [r.user_no for r in house.user_numbers(spark).collect()]
    assert len(numbers) == len(set(numbers)) >= len(known)
    for days in (1, 3, 400):
        as_of = "2024-01-21 00:00:00"
        users = house.mart(spark, "user_summary")
        want = Q.kpi_overview(house.mart(spark, "daily_summary"), users, TEAM, days, as_of)
        got = Q.kpi_overview(house.mart(spark, "daily_summary"), None, TEAM, days, as_of, house.user_days(spark))
        assert one(got) == one(want)


def actions(site, load_id):
    dates = P.dates_of(site.house.events(site.spark), "event_date")
    return {r.event_date.day: r.action for r in P.date_actions(site.spark, site.house, dates, load_id).collect()}


def test_second_load_is_merged_not_rebuilt(site, spark, monkeypatch):
    site.drop("a.jsonl", line(1), line(1, "bob", 5), line(2))
    site.run()
    seen = []
    original = P.date_actions

    def spy(*args):
        found = original(*args)
        seen.extend(r.action for r in found.collect())
        return found

    monkeypatch.setattr(P, "date_actions", spy)
    # The second load cuts a session, brings a new user, and repeats a known line.
    site.drop("b.jsonl", line(1, n=30), line(1, "cid", 7), line(2), line(3, "ann"))
    site.run()
    assert sorted(seen) == ["keep", "merge", "merge"]
    check_states(site)


def test_sessions_over_midnight_and_two_loads(site, spark):
    stamp = "2024-01-{:02d}T14:{:02d}:00+00:00"  # 23:xx in Tokyo
    for name, minutes in (("a", (50, 55)), ("b", (52, 58))):
        site.drop(f"{name}.jsonl", *[
            line(1, n=m, timestamp=stamp.format(1, m)) for m in minutes],
            line(1, n=1, timestamp=f"2024-01-01T15:0{len(name)}:0{minutes[0] % 7}+00:00"))
        site.run()
    days = site.house.session_days(spark)
    assert {r.event_date.day for r in days.collect()} == {1, 2}
    row = one(S.session_stats(days))
    assert row["event_count"] == 6 and row["duration_min"] == 11
    check_states(site)


def test_loads_whose_marts_failed_are_healed(site, spark, monkeypatch):
    site.drop("a.jsonl", line(1), line(2))
    site.run()
    original = P.write_mart
    monkeypatch.setattr(P, "write_mart", lambda *a: (_ for _ in ()).throw(RuntimeError("disk")))
    site.drop("b.jsonl", line(1, "bob"), line(5, "bob"))
    P.ingest_batch(spark, str(site.logs), site.house, strict=False)
    monkeypatch.setattr(P, "write_mart", original)
    failed = site.house.journal(spark).latest().filter("result = 'failed'").collect()
    assert [(r.stage, r.detail) for r in failed] == [("marts", "disk")]
    stale = {r.event_date.day for r in P.stale_dates(spark, site.house).collect()}
    assert stale == {1, 5}
    P.heal(spark, site.house)
    assert P.stale_dates(spark, site.house).isEmpty()
    check_states(site)


@pytest.mark.parametrize("fails_at", ["usage_days", "session_days", "user_days", "daily_summary", "user_summary"])
def test_retry_after_a_crash_between_marts(site, spark, monkeypatch, fails_at):
    site.drop("a.jsonl", line(1), line(2, n=3))
    site.run()
    original = P.write_days
    written = P.write_mart

    def failing(call):
        def run(rows, path, *rest):
            if path.endswith(fails_at):
                raise RuntimeError("lost")
            call(rows, path, *rest)
        return run

    monkeypatch.setattr(P, "write_days", failing(original))
    monkeypatch.setattr(P, "write_mart", failing(written))
    site.drop("b.jsonl", line(1, "bob"), line(2, n=9), line(4))
    with pytest.raises(Exception):
        site.run()
    monkeypatch.setattr(P, "write_days", original)
    monkeypatch.setattr(P, "write_mart", written)
    assert site.run() == 1
    check_states(site)


def test_another_load_heals_what_a_lost_load_left(site, spark, monkeypatch):
    site.drop("a.jsonl", line(1), line(1, "bob"))
    monkeypatch.setattr(P, "refresh_marts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        P.ingest_batch(spark, str(site.logs), site.house)
    monkeypatch.undo()
    # The lost load is never retried; the next one brings as many events to the same day.
    site.drop("c/b.jsonl", line(1, "cid"), line(1, "dan"))
    P.load_lines(P.read_raw(spark, str(site.logs / "c")), site.house, "other")
    check_states(site)


def test_journal_of_loads(site, spark):
    site.drop("a.jsonl", line(1))
    site.run()
    site.drop("b.jsonl", "broken")
    site.run()
    rows = site.house.journal(spark).latest().collect()
    assert sorted((r.stage, r.result) for r in rows) == [
        ("events", "done"), ("events", "done"), ("marts", "done"), ("raw", "done"), ("raw", "done")]
    assert site.house.journal(spark).entries("no such load").isEmpty()


def test_a_failed_second_layer_names_no_files(site, spark, monkeypatch):
    site.drop("a.jsonl", line(1))
    monkeypatch.setattr(P, "write_events", lambda *a: (_ for _ in ()).throw(RuntimeError("full")))
    with pytest.raises(RuntimeError):
        P.ingest_batch(spark, str(site.logs), site.house, strict=False)
    assert site.house.ledger(spark).isEmpty()
    assert [r.stage for r in site.house.journal(spark).latest().filter("result = 'failed'").collect()] == ["events"]


def test_ledger_names_files_without_lines(site, spark):
    site.drop("a.jsonl", line(1), line(2))
    (site.logs / "none.jsonl").touch()
    P.ingest_batch(spark, str(site.logs), site.house)
    counts = {r.source_file.rsplit("/", 1)[1]: r.line_count for r in site.house.ledger(spark).collect()}
    assert counts == {"a.jsonl": 2, "none.jsonl": 0}
    site.drop("b.jsonl", line(3))
    fresh = new_files(list_files(spark, str(site.logs)), site.house.ledger(spark))
    assert [r.source_file.rsplit("/", 1)[1] for r in fresh.collect()] == ["b.jsonl"]


@pytest.mark.parametrize("step", ["update_states", "write_marts", "write_mart"])
def test_remap_goes_on_after_a_crash(site, spark, monkeypatch, step):
    site.drop("a.jsonl", line(1, "ann"), line(2, "bob"), line(3, "ann"))
    site.run()
    mapping = spark.createDataFrame([("ann", "zoe")], "old_id string, new_id string")
    monkeypatch.setattr(P, step, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        P.apply_remap(spark, site.house, mapping)
    monkeypatch.undo()
    P.apply_remap(spark, site.house, mapping)
    users = {r.user_id for r in site.house.mart(spark, "user_summary").collect()}
    assert users == {"zoe", "bob"}
    check_states(site)


def test_chained_mappings_are_refused(site, spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c")], "old_id string, new_id string")
    with pytest.raises(ValueError, match="renamed"):
        P.apply_remap(spark, site.house, chain)


@pytest.mark.parametrize("most", [0, 1000])
def test_known_hashes_are_found_either_way(site, spark, monkeypatch, most):
    monkeypatch.setattr(P, "POINT_HASHES", most)
    site.drop("a.jsonl", *[line(1, n=i) for i in range(20)])
    site.run()
    site.drop("b.jsonl", *[line(1, n=i) for i in range(10, 30)])
    site.run()
    assert site.count() == 30
    check_states(site)


def test_periods_that_cut_a_day(spark):
    rows = clean_events(spark, *[
        {"event_timestamp": f"2024-01-{d:02d} {h:02d}:15:00", "session_id": f"s{d // 2}", "user_id": f"u{h % 2}",
         "stop_reason": reason, "event_type": "Stop"}
        for d in range(20, 28) for h, reason in ((1, "normal"), (11, None), (13, "usage_limit"), (22, "unknown"))])
    days = S.session_days(rows)
    for as_of in ("2024-01-27 12:00:00", "2024-01-28 00:00:00", "2024-01-30 13:15:00", "2024-01-24 23:59:59"):
        for length in (1, 3, 5):
            want = Q.session_kpi(rows, TEAM, length, as_of)
            assert one(S.session_kpi(days, rows, TEAM, length, as_of)) == one(want), (as_of, length)


def test_numbers_stay_and_bits_count_exactly(spark):
    users = spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("user_id"))
    first = U.number_users(users.filter("user_id < 'u5'")).cache()
    later = U.new_numbers(users, first)
    both = first.union(later).cache()
    assert both.count() == 70_000 == both.select("user_no").distinct().count()
    assert later.join(first, "user_id").isEmpty() and both.agg(F.min("user_no")).first()[0] >= 1
    mart = users.select(F.lit(dt.date(2024, 1, 1)).alias("summary_date"), F.lit(TEAM).alias("team_id"), "user_id")
    mart = mart.union(mart.filter("user_id < 'u3'").withColumn("summary_date", F.lit(dt.date(2024, 1, 2))))
    days = U.user_days(mart, both)
    got = U.user_counts(days, {"second": F.col("summary_date") == "2024-01-02", "all": F.lit(True)})
    assert one(got) == {"second": mart.filter("summary_date = '2024-01-02'").count(), "all": 70_000}
    none = U.user_counts(days.limit(0), {"all": F.lit(True)})
    assert one(none) == {"all": 0}


def test_service_figures_count_users_from_bits(spark):
    rows = clean_events(spark, *[{"user_id": f"u{k % 5}", "event_timestamp": f"2024-01-{10 + k} 10:00:00"} for k in range(9)])
    from eventloom.operators.marts import user_summary

    users = user_summary(rows)
    bits = U.user_days(users, U.number_users(users))
    at = (TEAM, 2, "2024-01-19 00:00:00")
    assert one(C.api_stats(rows, bits, *at)) == one(C.api_stats(rows, users, *at))
