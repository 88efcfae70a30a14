import datetime as dt
import json

from eventloom.operators import clean as C
from frames import by, events, records

GOOD = {"event_type": "Stop", "timestamp": "2024-01-01T20:00:00+00:00", "user_id": "ann"}


def keyed(spark, *lines):
    rows = [(i, line if isinstance(line, str) else json.dumps(line)) for i, line in enumerate(lines)]
    return C.key_lines(spark.createDataFrame(rows, "i int, value string"))


def test_reject_reasons(spark):
    df = keyed(
        spark, GOOD, "", "   ", '{"event_type":"Stop"', {**GOOD, "event_type": None},
        {k: v for k, v in GOOD.items() if k != "event_type"}, {**GOOD, "timestamp": "soon"},
        {k: v for k, v in GOOD.items() if k != "timestamp"}, {**GOOD, "user_id": None}, "[1]", "12",
        json.dumps(GOOD) * 2, json.dumps(GOOD) + "," + json.dumps(GOOD), json.dumps(GOOD) + " x", "null",
    )
    got = {r.i: r.reject_reason for r in df.collect()}
    assert got == {
        0: None, 1: "blank_line", 2: "blank_line", 3: "malformed_json", 4: "missing_event_type",
        5: "missing_event_type", 6: "bad_timestamp", 7: "bad_timestamp", 8: "missing_user",
        9: "missing_event_type", 10: "missing_event_type", 11: "malformed_json",
        12: "malformed_json", 13: "malformed_json", 14: "missing_event_type",
    }
    good, bad = C.split_bad(df)
    assert good.count() == 1 and bad.count() == 14
    # Only good lines carry a date; unreadable ones keep their text.
    assert {r.i for r in df.filter("event_date IS NOT NULL").collect()} == {0}
    assert df.filter("i = 3").first().raw == '{"event_type":"Stop"'


def test_hash_ignores_key_order_and_spacing(spark):
    reverse = dict(reversed(list(GOOD.items())))
    df = keyed(spark, json.dumps(GOOD), json.dumps(reverse, separators=(",", ":")), {**GOOD, "x": 1})
    hashes = [r.event_hash for r in df.orderBy("i").collect()]
    assert hashes[0] == hashes[1] != hashes[2]
    raws = [r.raw for r in df.orderBy("i").collect()]
    assert raws[0] == raws[1]


def test_clean_types_and_defaults(spark):
    line = {**GOOD, "project": "web", "success": "maybe", "output_length": 12, "prompt_length": "x",
            "categories": {"subagent": True}, "extra": {"kept": [1, 2]}}
    row = C.clean(keyed(spark, line)).first().asDict()
    assert row["event_timestamp"] == dt.datetime(2024, 1, 2, 5)
    assert row["event_date"] == dt.date(2024, 1, 2)
    assert row["team_id"] == "default-team"
    assert row["is_subagent"] is True and row["is_mcp"] is False and row["is_usage_limit"] is False
    assert row["tool_success"] is None and row["prompt_length"] is None  # not castable
    assert row["output_length"] == 12 and row["session_id"] is None
    assert json.loads(row["raw_data"])["extra"] == {"kept": [1, 2]}


def test_clean_drops_incomplete_lines(spark):
    df = keyed(spark, GOOD, {**GOOD, "timestamp": "x"}, {**GOOD, "event_type": None}, "{")
    assert C.clean(df).count() == 1


def test_odd_values_do_not_spoil_an_event(spark):
    line = {**GOOD, "categories": "none", "success": {"a": 1}, "output_length": 12.0, "error": {"code": 1}}
    row = C.clean(keyed(spark, line)).first()
    assert row.event_type == "Stop" and row.is_mcp is False and row.tool_success is None
    assert row.output_length == 12 and row.error_message == '{"code":1}'


def test_null_categories_count_as_false(spark):
    row = C.clean(keyed(spark, {**GOOD, "categories": None})).first()
    assert (row.is_skill, row.is_mcp, row.is_file_operation) == (False, False, False)


def test_remap_with_dict_and_frame(spark):
    ev = events(spark, {"user_id": "a"}, {"user_id": "b"}, {"user_id": "it's"})
    mapping = {"a": "b", "it's": "c"}
    frame = spark.createDataFrame([("a", "b"), ("it's", "c"), ("a", "b")], "old_id string, new_id string")
    for change in (mapping, frame):
        out = C.remap_users(ev, change)
        assert out.columns == ev.columns
        assert sorted(r.user_id for r in out.collect()) == ["b", "b", "c"]
    assert C.remap_users(ev, {}).count() == 3


def test_remapped_mart_keeps_one_row_per_key(spark):
    from eventloom.operators.marts import user_summary

    ev = events(spark, {"user_id": "a"}, {"user_id": "b", "event_timestamp": "2024-01-30 12:00:00"},
                {"user_id": "b", "event_timestamp": "2024-01-29 12:00:00"})
    out = C.remap_user_summary(user_summary(ev), {"a": "b"})
    rows = by(out, "summary_date")
    assert rows[dt.date(2024, 1, 30)]["total_events"] == 2
    assert rows[dt.date(2024, 1, 30)]["last_active_at"] == dt.datetime(2024, 1, 30, 12)
    rebuilt = user_summary(C.remap_users(ev, {"a": "b"}))
    assert sorted(map(repr, records(out.select(*rebuilt.columns)))) == sorted(map(repr, records(rebuilt)))
