import json

import pytest
from pyspark.sql import functions as F

from eventloom.operators import normalize as N
from eventloom.operators.clean import clean, key_lines
from eventloom.schema import EVENT_TYPES
from eventloom.sources.testdata import HOOK_COLUMNS
from frames import by, one, records

TYPES = {"ts": "timestamp_ntz", "is_interrupt": "boolean", "stop_hook_active": "boolean", "event_id": "bigint"}


def hooks(spark, *rows):
    """Hook records from partial dicts."""
    base = {name: None for name in HOOK_COLUMNS}
    base |= {"event_type": "Stop", "ts": "2024-01-01 00:00:00", "username": "ann", "hostname": "h"}
    full = [tuple(({**base, "event_id": i} | row)[name] for name in HOOK_COLUMNS) for i, row in enumerate(rows)]
    raw = spark.createDataFrame(full, ", ".join(
        f"{n} {'boolean' if TYPES.get(n) == 'boolean' else 'bigint' if n == 'event_id' else 'string'}"
        for n in HOOK_COLUMNS))
    return raw.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_success_is_unknown_before_the_call(spark):
    df = N.normalize_hooks(hooks(spark, *[
        {"event_type": t, "tool_name": "Bash", "tool_response": "héllo", "error": "boom"}
        for t in ("PreToolUse", "PostToolUse", "PostToolUseFailure")]))
    rows = by(df, "event_type")
    assert [rows[t]["success"] for t in ("PreToolUse", "PostToolUse", "PostToolUseFailure")] == [None, True, False]
    assert rows["PostToolUse"]["output_length"] == 5 and rows["PreToolUse"]["output_length"] is None
    assert rows["PostToolUseFailure"]["error"] == "boom" and rows["PostToolUse"]["error"] is None
    assert rows["PreToolUse"]["categories"].command is True


def test_every_event_type_keeps_the_common_fields(spark):
    rows = by(N.normalize_hooks(hooks(spark, *[{"event_type": t} for t in EVENT_TYPES])), "event_type")
    assert set(rows) == set(EVENT_TYPES)
    for kind, row in rows.items():
        assert (row["user_id"], row["project"], row["session_id"]) == ("ann@h", "unknown", "")
        assert row["timestamp"] == "2024-01-01T00:00:00.000000+00:00"
        assert row["hook_event_name"] == kind
    assert rows["SessionStart"]["model"] == "unknown" and rows["SessionEnd"]["reason"] == "other"
    assert rows["SubagentStart"]["categories"].subagent is True
    assert rows["SubagentStart"]["categories"].mcp is None
    assert rows["TeammateIdle"]["categories"] is None and rows["TeammateIdle"]["stop_reason"] is None


def test_limit_phrase_in_the_title_only(spark):
    row = one(N.normalize_hooks(hooks(spark, {"event_type": "Notification", "title": "Rate LIMIT reached"})))
    assert row["is_usage_limit"] is True and row["message"] == ""
    quiet = one(N.normalize_hooks(hooks(spark, {"event_type": "Notification"})))
    assert quiet["is_usage_limit"] is False


def test_stop_reasons_come_from_transcripts(spark):
    df = hooks(spark, {"transcript_path": "a"}, {"transcript_path": "b"}, {"transcript_path": "gone"},
               {"transcript_path": ""}, {"transcript_path": None},
               {"event_type": "SessionEnd", "transcript_path": "a"})
    transcripts = spark.createDataFrame(
        [("a", "x\nusage limit\nreached\n"), ("b", "fine")], "path string, value string")
    rows = by(N.normalize_hooks(df, transcripts), "event_id")
    assert [rows[i]["stop_reason"] for i in range(6)] == [
        "usage_limit", "normal", "unknown", "unknown", "unknown", None]
    assert rows[0]["transcript_path"] == "a" and len(rows) == 6


def test_payload_json_loads_back_into_clean_events(spark):
    df = N.normalize_hooks(hooks(
        spark, {"event_type": "PostToolUse", "tool_name": "mcp__x", "tool_response": "abc", "project_dir": "/p/web"}))
    lines = N.to_jsonl(df)
    doc = json.loads(lines.first().value)
    assert "error" not in doc and doc["categories"]["mcp"] is True
    row = clean(key_lines(lines)).first()
    assert (row.tool_success, row.is_mcp, row.output_length, row.project_name) == (True, True, 3, "web")


def test_redaction_keeps_lengths(spark):
    df = N.normalize_hooks(hooks(spark, {"event_type": "UserPromptSubmit", "prompt": "secret"}))
    kept = N.redact(df)
    assert not {"prompt", "raw_input", "tool_input", "tool_response", "message"} & set(kept.columns)
    assert one(kept)["prompt_length"] == 6


def test_anonymous_users(spark):
    row = one(N.normalize_hooks(hooks(spark, {}), anonymize=True))
    assert len(row["user_id"]) == 16 and "ann" not in row["user_id"]


def test_anonymous_payloads_hold_no_identity(spark):
    df = N.normalize_hooks(hooks(
        spark, {"username": "dev-ann", "hostname": "host-ann",
                "project_dir": "/home/dev-ann/web", "session_id": "s"}), anonymize=True)
    text = N.to_jsonl(df).first().value
    assert "ann" not in text
    assert "ann" not in str(clean(key_lines(N.to_jsonl(df))).first().asDict())


def test_documents_are_nested_in_json_lines(spark):
    df = N.normalize_hooks(hooks(spark, {
        "event_type": "PostToolUse", "tool_name": "Bash", "tool_input": '{"k": 1}', "tool_response": "plain"}))
    doc = json.loads(N.to_jsonl(df).first().value)
    assert doc["tool_input"] == {"k": 1} and doc["tool_response"] == "plain"
    assert doc["raw_input"]["tool_name"] == "Bash"


def test_a_transcript_listed_twice_counts_once(spark):
    df = hooks(spark, {"event_type": "Stop", "transcript_path": "t"})
    twice = spark.createDataFrame([("t", "usage limit reached"), ("t", "fine")], "path string, value string")
    rows = records(N.normalize_hooks(df, twice))
    assert len(rows) == 1 and rows[0]["stop_reason"] == "usage_limit"


def test_validation(spark):
    df = spark.createDataFrame(
        [("Stop", "t", "u", "team", None), (None, "t", None, "team", "p"), ("Stop", "t", "u", None, "p")],
        "event_type string, timestamp string, user_id string, team_id string, project string")
    ok, bad = N.validate_events(df)
    assert one(ok)["project"] == ""
    assert sorted(r["reject_reason"] for r in records(bad)) == ["missing_event_type", "missing_team_id"]


@pytest.mark.parametrize("tail", [1, 2, 3, 30])
def test_line_tails_against_brute_force(spark, tail):
    lines = [(k, i, "usage limit" if i % 5 == k else "reached" if i % 5 == (k + 1) % 5 else "x")
             for k in range(4) for i in range(k * 7 + 1)]
    df = spark.createDataFrame(lines, "k int, i int, line string").repartition(5)
    got = {r.k: r.stop_reason for r in N.stop_reason_by_line(df, "k", ["i"], "line", tail).collect()}
    for k in range(4):
        text = " ".join(line for key, _, line in lines if key == k)
        last = " ".join([line for key, _, line in lines if key == k][-tail:])
        assert got[k] == ("usage_limit" if "usage limit reached" in last else "normal"), text


GOOD = {"event_type": "Stop", "timestamp": "t", "user_id": "u", "team_id": "x"}


def judged(spark, *documents):
    """(reasons or None, typed row or None) per document, in order."""
    lines = [(k, d if isinstance(d, str) else json.dumps(d)) for k, d in enumerate(documents)]
    ok, bad = N.validate_documents(spark.createDataFrame(lines, "k int, value string"))
    good, bad = {r.k: r for r in ok.collect()}, {r.k: r.reject_reasons for r in bad.collect()}
    assert not set(good) & set(bad)
    return [(bad.get(k), good.get(k)) for k in range(len(documents))]


def test_complete_document_is_typed(spark):
    (reasons, row), = judged(spark, {
        **GOOD, "categories": {"mcp": True, "skill": 0}, "success": "No", "output_length": "12",
        "prompt_length": 3.0, "error": None, "metadata": {"a": [1, {"b": 2}]}, "other": 5})
    assert reasons is None
    assert (row.categories, row.success, row.output_length, row.prompt_length, row.error) == (
        {"mcp": True, "skill": False}, False, 12, 3, None)
    assert (row.project, row.session_id, row.tool_name) == ("", "", None)
    assert json.loads(row.metadata) == {"a": [1, {"b": 2}]}


def test_each_field_has_its_reason(spark):
    cases = {
        "event_type": (7, "event_type_not_text"), "timestamp": (True, "timestamp_not_text"),
        "user_id": (None, "missing_user_id"), "team_id": ({}, "team_id_not_text"),
        "project": (1, "project_not_text"), "session_id": ([], "session_id_not_text"),
        "tool_name": (False, "tool_name_not_text"), "categories": ({"mcp": "perhaps"}, "categories_not_flags"),
        "success": (2, "success_not_flag"), "output_length": (1.5, "output_length_not_number"),
        "prompt_length": ("1e3", "prompt_length_not_number"), "error": ({"m": 1}, "error_not_text"),
        "metadata": ([1], "metadata_not_object"),
    }
    found = judged(spark, *[{**GOOD, name: value} for name, (value, _) in cases.items()])
    assert [r for r, _ in found] == [[reason] for _, reason in cases.values()]


def test_several_reasons_and_lines_that_hold_no_object(spark):
    found = judged(spark, {"event_type": 1, "success": "x"}, "[1]", "{", "", "null", "12", "{} {}", '{"a":1},{"b":2}')
    assert found[0][0] == ["event_type_not_text", "missing_timestamp", "missing_user_id", "missing_team_id",
                           "success_not_flag"]
    assert [r for r, _ in found[1:]] == [["not_an_object"]] * 7


def test_null_and_missing_options_are_accepted(spark):
    options = ("project", "session_id", "tool_name", "categories", "success", "output_length", "error", "metadata")
    found = judged(spark, GOOD, {**GOOD, **{name: None for name in options}}, {**GOOD, "categories": {}})
    assert all(r is None for r, _ in found) and found[2][1].categories == {}
