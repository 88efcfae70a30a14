"""Adapters that turn the bundled test tables into telemetry inputs.

They only rename and recode rows of the given tables, so every query on top of
them grows with those tables.  The SQL fragments run on Spark and on the
checking engine alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
TEAM = "default-team"
DAYS = 7
USER = "user8@example.com"

# --- fragments shared by both engines ---------------------------------------

EVENT_TYPE = """CASE event_type WHEN 'signup' THEN 'SessionStart' WHEN 'view' THEN 'UserPromptSubmit'
 WHEN 'click' THEN 'PostToolUse' WHEN 'error' THEN 'PostToolUseFailure'
 ELSE CASE k % 4 WHEN 0 THEN 'Stop' WHEN 1 THEN 'Notification' WHEN 2 THEN 'SubagentStop'
 ELSE 'PreToolUse' END END"""

TOOL = """CASE WHEN et IN ('PreToolUse', 'PostToolUse', 'PostToolUseFailure') THEN CASE k % 10
 WHEN 0 THEN 'Bash' WHEN 1 THEN 'Read' WHEN 2 THEN 'Write' WHEN 3 THEN 'Edit' WHEN 4 THEN 'Glob'
 WHEN 5 THEN 'Grep' WHEN 6 THEN 'Task' WHEN 7 THEN 'mcp__db__query' WHEN 8 THEN 'NotebookEdit'
 ELSE 'WebFetch' END END"""

EVENT_COLUMNS = {
    "event_id": "event_id",
    "event_type": "et",
    "event_timestamp": "jst",
    "user_id": "CASE WHEN user_id % 7 = 0 THEN concat('user', user_id)"
               " ELSE concat('user', user_id, '@example.com') END",
    "team_id": "CASE WHEN user_id % 10 = 9 THEN 'team-b' ELSE 'default-team' END",
    "session_id": "concat('s-', user_id, '-', utc_day)",
    "project_name": "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'org/web'"
                    " WHEN 3 THEN 'api-service' WHEN 4 THEN 'data-pipeline' ELSE 'unknown' END",
    "tool_name": "tool",
    "tool_success": "CASE et WHEN 'PostToolUse' THEN true WHEN 'PostToolUseFailure' THEN false END",
    "output_length": "CASE WHEN et = 'PostToolUse' THEN CAST(floor(value) AS BIGINT) END",
    "error_message": "CASE WHEN et = 'PostToolUseFailure' THEN concat('exit ', k) END",
    "prompt_length": "CASE WHEN et = 'UserPromptSubmit' THEN CAST(k AS BIGINT) END",
    "is_skill": "coalesce(tool = 'NotebookEdit', false)",
    "is_subagent": "coalesce(tool = 'Task', false) OR et = 'SubagentStop'",
    "is_mcp": "coalesce(tool = 'mcp__db__query', false)",
    "is_command": "coalesce(tool = 'Bash', false)",
    "is_file_operation": "coalesce(tool IN ('Read', 'Write', 'Edit', 'Glob', 'Grep'), false)",
    "is_usage_limit": "et = 'Notification' AND k % 3 = 0",
    "stop_reason": "CASE WHEN et = 'Stop' THEN CASE k % 5 WHEN 0 THEN 'usage_limit'"
                   " WHEN 1 THEN 'unknown' ELSE 'normal' END END",
}

# Hook records: every event becomes one record of the hook input table.
HOOK_COLUMNS = {
    "event_id": "event_id",
    "event_type": "CASE WHEN et = 'PreToolUse' AND k % 8 = 3 THEN 'SubagentStart'"
                  " WHEN et = 'SubagentStop' AND k % 12 = 2 THEN 'SessionEnd'"
                  " WHEN et = 'Notification' AND k % 12 = 5 THEN 'PreCompact'"
                  " WHEN et = 'Stop' AND k % 12 = 4 THEN 'TaskCompleted' ELSE et END",
    "ts": "ts",
    "explicit_user_id": "CASE user_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '  '"
                        " ELSE concat(' user', user_id, '@example.com ') END",
    "username": "CASE WHEN user_id % 5 = 0 THEN NULL ELSE concat('dev', user_id) END",
    "hostname": "concat('host-', user_id % 4)",
    "project_dir": "CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '/home/dev/web/'"
                   " WHEN 3 THEN '/srv/api-service' WHEN 4 THEN concat('C:', chr(92), 'work', chr(92), 'app')"
                   " WHEN 5 THEN concat('D:', chr(92), 'repo', chr(92)) ELSE 'plain' END",
    "session_id": "CASE WHEN k % 11 = 0 THEN NULL ELSE concat('s-', user_id) END",
    "transcript_path": "CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN ''"
                       " ELSE concat('doc-', event_id % 1500) END",
    "cwd": "'/home/dev'",
    "permission_mode": "CASE WHEN k % 2 = 0 THEN 'default' END",
    "hook_event_name": "CASE WHEN k % 2 = 1 THEN et END",
    "tool_name": "CASE k % 13 WHEN 0 THEN 'Bash' WHEN 1 THEN 'execute_bash' WHEN 2 THEN 'Task'"
                 " WHEN 3 THEN 'task_x' WHEN 4 THEN 'TaskCreate' WHEN 5 THEN 'mcp__a__b'"
                 " WHEN 6 THEN 'MCP__Z' WHEN 7 THEN 'MultiEdit' WHEN 8 THEN 'NotebookEdit'"
                 " WHEN 9 THEN 'WebFetch' WHEN 10 THEN 'LS' WHEN 11 THEN 'GREP' END",
    "tool_use_id": "concat('t', event_id)",
    "tool_input": "CASE WHEN k % 10 = 9 THEN '{\"mcp_server\":\"x\"}' WHEN k % 10 = 8 THEN NULL"
                  " ELSE concat('{\"k\":', k, '}') END",
    "tool_response": "concat('{\"out\":\"', event_type, '\",\"k\":', k, '}')",
    "error": "CASE WHEN k % 5 > 0 THEN concat('exit ', k) END",
    "is_interrupt": "CASE WHEN k % 4 = 0 THEN true WHEN k % 4 = 1 THEN false END",
    "prompt": "CASE WHEN k % 3 > 0 THEN concat('please fix ', props) END",
    "source": "CASE WHEN k % 3 = 0 THEN 'startup' END",
    "model": "CASE WHEN k % 4 = 0 THEN 'm-1' END",
    "agent_type": "CASE WHEN k % 5 = 0 THEN 'explore' END",
    "reason": "CASE WHEN k % 2 = 0 THEN 'logout' END",
    "agent_id": "concat('a', k)",
    "agent_transcript_path": "CASE WHEN k % 2 = 0 THEN '/t/a.jsonl' END",
    "stop_hook_active": "CASE WHEN k % 6 = 0 THEN true END",
    "message": "CASE k % 7 WHEN 0 THEN 'Usage limit reached for today' WHEN 1 THEN 'Waiting for input'"
               " WHEN 2 THEN 'UPGRADE YOUR PLAN to go on' WHEN 3 THEN NULL ELSE 'usage is fine' END",
    "title": "CASE k % 5 WHEN 0 THEN 'Rate Limit Reached' WHEN 1 THEN NULL ELSE 'Notice' END",
    "notification_type": "CASE WHEN k % 2 = 0 THEN 'idle' END",
    "trigger": "CASE WHEN k % 2 = 1 THEN 'auto' END",
    "custom_instructions": "CASE WHEN k % 3 = 0 THEN 'short' END",
    "last_assistant_message": "CASE WHEN k % 3 = 1 THEN 'done' END",
}

# A limit phrase split over two turns, and one in the first turn only.
TURN_LINE = """CASE WHEN conv_id % 3 = 0 AND turn % 4 = 1 THEN concat(text, ' Usage limit')
 WHEN conv_id % 3 = 0 AND turn % 4 = 2 THEN concat('reached. ', text)
 WHEN conv_id % 5 = 1 AND turn = 0 THEN concat('Daily Usage Limit ', text) ELSE text END"""

# A limit phrase as first line, as last line, or split over a line break.
DOCUMENT_TEXT = """CASE doc_id % 7 WHEN 0 THEN concat('API usage limit', chr(10), text)
 WHEN 1 THEN concat(text, chr(10), 'Monthly Usage', chr(10), 'LIMIT', chr(10))
 WHEN 2 THEN concat(text, chr(13), chr(10), 'usage has been exceeded') ELSE text END"""


# --- frames -----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
        .selectExpr("*", f"{EVENT_TYPE} AS et")
        .selectExpr("*", f"{TOOL} AS tool", "convert_timezone('UTC', 'Asia/Tokyo', ts) AS jst",
                    "date_format(ts, 'yyyyMMdd') AS utc_day")
    )


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events, with ``event_id`` in place of the hash."""
    staged = _staged_events(spark, sf_dir)
    return staged.selectExpr(*[f"{sql} AS {name}" for name, sql in EVENT_COLUMNS.items()]).withColumn(
        "event_date", F.to_date("event_timestamp")
    )


def hook_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hook input records."""
    staged = _staged_events(spark, sf_dir)
    return staged.selectExpr(*[f"{sql} AS {name}" for name, sql in HOOK_COLUMNS.items()])


def transcript_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts with one turn per line."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", f"{TURN_LINE} AS line"
    )


def transcript_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as whole transcripts."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('doc-', doc_id) AS path", f"{DOCUMENT_TEXT} AS value"
    )


def jsonl_lines(events: DataFrame, reverse_keys: bool = False) -> DataFrame:
    """Clean events as the JSON lines they would have been loaded from.

    ``seq`` carries the event id as an extra key that only the raw text keeps.
    """
    flags = {"skill": "is_skill", "subagent": "is_subagent", "mcp": "is_mcp",
             "command": "is_command", "file_operation": "is_file_operation"}
    utc = F.convert_timezone(F.lit("Asia/Tokyo"), F.lit("UTC"), F.col("event_timestamp"))
    stamp = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    fields = [
        F.col("event_id").alias("seq"),
        "event_type",
        stamp.alias("timestamp"),
        "user_id",
        F.when(F.col("team_id") != TEAM, F.col("team_id")).alias("team_id"),
        "session_id",
        F.col("project_name").alias("project"),
        "tool_name",
        F.col("tool_success").alias("success"),
        "output_length",
        F.col("error_message").alias("error"),
        "prompt_length",
        F.when(F.col("is_usage_limit"), True).alias("is_usage_limit"),
        "stop_reason",
        F.struct(*[F.when(F.col(col), True).alias(name) for name, col in flags.items()])
        .alias("categories"),
    ]
    if reverse_keys:
        fields = fields[::-1]
    return events.select("event_id", "event_date", F.to_json(F.struct(*fields)).alias("value"))


# Lines whose fields have many kinds, right and wrong ones, as JSON text by field.
LOOSE_FIELDS = {
    "event_type": "CASE event_id % 11 WHEN 0 THEN '7' WHEN 1 THEN 'null' ELSE '\"Stop\"' END",
    "timestamp": "CASE event_id % 17 WHEN 3 THEN '{}' ELSE '\"2024-01-01T00:00:00+00:00\"' END",
    "team_id": "CASE event_id % 19 WHEN 4 THEN 'true' ELSE '\"t\"' END",
    "project": "CASE event_id % 5 WHEN 2 THEN 'null' WHEN 3 THEN '\"web\"' ELSE '\"\"' END",
    "categories": "CASE event_id % 4 WHEN 0 THEN '{\"mcp\":true,\"skill\":\"no\"}' WHEN 1 THEN 'null'"
                  " WHEN 2 THEN CASE WHEN event_id % 8 = 2 THEN '{\"mcp\":3}' ELSE '{}' END"
                  " ELSE CASE WHEN event_id % 8 = 3 THEN '\"x\"' ELSE '{\"mcp\":1,\"command\":\"ON\"}' END END",
    "success": "CASE event_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN '\"yes\"' WHEN 2 THEN '0'"
               " WHEN 3 THEN '\"maybe\"' WHEN 4 THEN 'null' WHEN 5 THEN '1.0' ELSE 'false' END",
    "output_length": "CASE event_id % 6 WHEN 0 THEN '12' WHEN 1 THEN '\"34\"' WHEN 2 THEN '5.0'"
                     " WHEN 3 THEN '5.5' WHEN 4 THEN 'true' ELSE '-7' END",
    "error": "CASE event_id % 23 WHEN 5 THEN '[\"e\"]' ELSE 'null' END",
    "metadata": "CASE event_id % 29 WHEN 6 THEN '[]' ELSE '{\"k\":[1]}' END",
}

# A user is named by most lines; some lines are no object at all.
LOOSE_LINE = ("CASE event_id % 31 WHEN 7 THEN '[1]' WHEN 8 THEN '{\"event_type\":' ELSE concat('{',"
              " CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('\"user_id\":\"u', event_id % 50, '\",') END, "
              + ", ',', ".join(f"'\"{name}\":', {sql}" for name, sql in LOOSE_FIELDS.items()) + ", '}') END")

# Plain event lines of known text, so that their bytes can be counted.
PLAIN_LINE = ("concat('{\"event_type\":\"', event_type, '\",\"timestamp\":\"', {iso}, '\",\"user_id\":\"', user_id,"
              " '\",\"seq\":', event_id, '}')")

# Text of a document in a transcript file, with limit phrases at the start or end of a few.
FILE_TEXT = """CASE WHEN doc_id % 9 = 4 THEN concat('API usage limit', chr(10), coalesce(text, ''))
 WHEN doc_id % 13 = 5 THEN concat(coalesce(text, ''), chr(10), 'Monthly Usage', chr(10), 'LIMIT')
 ELSE coalesce(text, '') END"""
FILES = 40


def loose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value): lines whose fields have kinds that an event may not have."""
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{LOOSE_LINE} AS value")


def plain_lines(events: DataFrame) -> DataFrame:
    """(event_id, event_date, value) of clean events."""
    iso = ("concat(date_format(convert_timezone('Asia/Tokyo', 'UTC', event_timestamp),"
           " 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS'), '+00:00')")
    return events.selectExpr("event_id", "event_date", f"{PLAIN_LINE.replace("{iso}", iso)} AS value")


def transcript_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, doc_id, pos, value): documents dealt to transcripts, a row per line in order."""
    lines = F.split(F.expr(FILE_TEXT), "\n", -1)
    return table(spark, sf_dir, "documents").select(
        F.expr(f"doc_id % {FILES}").alias("file"), "doc_id", F.posexplode(lines).alias("pos", "value"))
