import hashlib

import pytest
from pyspark.sql import functions as F

from eventloom.functions import text
from eventloom.schema import LIMIT_PHRASES, STOP_LABELS


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_every_limit_phrase_in_any_case(spark):
    assert apply(spark, [f"x {p.upper()} y" for p in LIMIT_PHRASES], text.is_usage_limit) == [True] * 12
    assert apply(spark, ["usage is fine", "", None], text.is_usage_limit) == [False, False, False]


@pytest.mark.parametrize("name,tool_input,want", [
    ("Task", "", {"subagent"}), ("task_x", "", {"subagent"}), ("TaskCreate", "", set()),
    ("mcp__a__b", "", {"mcp"}), ("MCP__A", "", {"mcp"}), ("WebFetch", "{mcp_server: 1}", {"mcp"}),
    ("Bash", "mcp_server", {"command", "mcp"}), ("execute_bash", "", {"command"}),
    ("MultiEdit", "", {"file_operation"}), ("LS", "", {"file_operation"}),
    ("NotebookEdit", "", {"skill"}), (None, None, set()),
])
def test_tool_flags(spark, name, tool_input, want):
    df = spark.createDataFrame([(name, tool_input)], "n string, i string")
    flags = df.select(text.tool_flags(F.col("n"), F.col("i")).alias("f")).first().f.asDict()
    assert {k for k, v in flags.items() if v} == want
    assert None not in flags.values()


CASES = ["", "a", "a\n", "a\n\n", "a\nb\nc\nd", "a\r\nb\r\nc\r\n", "a\rb\rc\r", "a\x0bb\x0cc",
         "x\u2028y\u2029z\x85w", "\n", "\n\n\n\n", "a\n\rb", "a\x1cb\x1dc\x1ed", "1\r\n2\n3\r4\n5\r\n"]


@pytest.mark.parametrize("lines", [1, 2, 3, 30])
def test_last_lines_equal_splitlines(spark, lines):
    want = [" ".join(case.splitlines()[-lines:]) for case in CASES]
    assert apply(spark, CASES, lambda c: text.last_lines(c, lines)) == want


def test_stop_reason_of_whole_texts(spark):
    old = "Usage limit reached\n" + "line\n" * 30
    split = "text\nusage\nLIMIT reached\n"
    assert apply(spark, [old, split, "fine", None, ""],
                 lambda c: text.stop_reason_of(text.last_lines(c))) == [
        "normal", "usage_limit", "normal", "unknown", "normal"]


def test_user_identifier(spark):
    df = spark.createDataFrame(
        [(1, " boss ", "ann", "h"), (2, "  ", "ann", "h"), (3, None, "", "h"), (4, None, None, None)],
        "i int, e string, u string, h string").orderBy("i")
    who = [F.col("e"), F.col("u"), F.col("h")]
    assert [r[0] for r in df.select(text.user_identifier(*who)).collect()] == [
        "boss", "ann@h", "unknown@h", "unknown@"]
    hashed = [r[0] for r in df.select(text.user_identifier(*who, anonymize=True)).collect()]
    assert hashed[0] == "boss"
    assert hashed[1] == hashlib.sha256(b"ann@h").hexdigest()[:16]


def test_project_name(spark):
    paths = ["/home/a/web", "/home/a/web/", "C:\\work\\app", "D:\\repo\\", "plain", "", None, "/", "C:\\"]
    assert apply(spark, paths, text.project_name) == [
        "web", "web", "app", "repo", "plain", "unknown", "unknown", "", ""]


def test_short_names(spark):
    assert apply(spark, ["org/web", "web", "org/"], text.project_display) == ["web", "web", ""]
    assert apply(spark, ["a@b@c", "plain", "@x"], text.display_name) == ["a", "plain", ""]


def test_label_passes_unknown_values_through(spark):
    got = apply(spark, ["normal", "other", None], lambda c: text.label(c, STOP_LABELS))
    assert got == [STOP_LABELS["normal"], "other", None]
