"""Table schemas and fixed values of the event warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

EVENT_ZONE = "Asia/Tokyo"
DEFAULT_TEAM = "default-team"
MINUTES_SAVED_PER_EXECUTION = 2
WORK_HOURS_PER_MONTH = 160
TREND_CAP_DAYS = 90
TRANSCRIPT_TAIL_LINES = 30
PERIOD_DAYS = {"1D": 1, "7D": 7, "30D": 30, "90D": 90, "All": 365}

EVENT_TYPES = (
    "SessionStart", "SessionEnd", "UserPromptSubmit", "PreToolUse",
    "PostToolUse", "PostToolUseFailure", "SubagentStart", "SubagentStop",
    "Notification", "PreCompact", "Stop", "PermissionRequest",
    "TeammateIdle", "TaskCompleted",
)

# Lower-case phrases that mark a message or transcript as limit-stopped.
LIMIT_PHRASES = (
    "usage limit reached",
    "claude ai usage limit",
    "you have reached your usage limit",
    "you've reached your usage limit",
    "usage limit has been reached",
    "daily usage limit",
    "monthly usage limit",
    "rate limit reached",
    "api usage limit",
    "your claude.ai pro plan",
    "upgrade your plan",
    "usage has been exceeded",
)

COMMAND_TOOLS = ("bash", "execute_bash")
FILE_TOOLS = ("read", "write", "edit", "multiedit", "glob", "grep", "ls")

NO_PROJECT = "(no project)"
STOP_LABELS = {"normal": "正常終了", "usage_limit": "利用制限", "unknown": "不明"}
WEEKDAY_LABELS = {0: "日", 1: "月", 2: "火", 3: "水", 4: "木", 5: "金", 6: "土"}

# --- layer 1: raw lines -----------------------------------------------------

RAW_SCHEMA = T.StructType([
    T.StructField("raw", T.StringType()),
    T.StructField("event_hash", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("team_id", T.StringType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
])

# --- layer 2: clean events --------------------------------------------------

FLAGS = (
    "is_skill", "is_subagent", "is_mcp", "is_command",
    "is_file_operation", "is_usage_limit",
)

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_hash", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("team_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("project_name", T.StringType()),
    T.StructField("tool_name", T.StringType()),
    T.StructField("tool_success", T.BooleanType()),
    T.StructField("output_length", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("prompt_length", T.LongType()),
    *[T.StructField(flag, T.BooleanType()) for flag in FLAGS],
    T.StructField("stop_reason", T.StringType()),
    T.StructField("raw_data", T.StringType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
])

# --- layer 3: marts ---------------------------------------------------------

MART_COUNTERS = (
    "total_events", "message_count", "session_count", "tool_execution_count",
    "mcp_count", "subagent_count", "command_count", "skill_count",
    "limit_hit_count",
)
_COUNTER_FIELDS = [T.StructField(name, T.LongType()) for name in MART_COUNTERS]

DAILY_SCHEMA = T.StructType([
    T.StructField("summary_date", T.DateType()),
    T.StructField("team_id", T.StringType()),
    *_COUNTER_FIELDS,
    T.StructField("active_users", T.LongType()),
    T.StructField("success_rate", T.DoubleType()),
    T.StructField("updated_at", T.TimestampType()),
])

USER_SCHEMA = T.StructType([
    T.StructField("summary_date", T.DateType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("team_id", T.StringType()),
    *_COUNTER_FIELDS,
    T.StructField("last_active_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampType()),
])

TOOL_SCHEMA = T.StructType([
    T.StructField("summary_date", T.DateType()),
    T.StructField("team_id", T.StringType()),
    T.StructField("tool_name", T.StringType()),
    T.StructField("execution_count", T.LongType()),
    T.StructField("success_count", T.LongType()),
    T.StructField("failure_count", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])

# --- daily states: partial aggregates that loads add to ----------------------

USAGE_SCHEMA = T.StructType([
    T.StructField("team_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("tool_name", T.StringType()),
    *_COUNTER_FIELDS,
    T.StructField("success_count", T.LongType()),
    T.StructField("failure_count", T.LongType()),
    T.StructField("last_active_at", T.TimestampNTZType()),
    T.StructField("summary_date", T.DateType()),
])

SESSION_DAYS_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("team_id", T.StringType()),
    T.StructField("session_start", T.TimestampNTZType()),
    T.StructField("session_end", T.TimestampNTZType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("message_count", T.LongType()),
    T.StructField("tool_count", T.LongType()),
    T.StructField("is_limit", T.IntegerType()),
    T.StructField("has_normal", T.IntegerType()),
    T.StructField("has_greater", T.IntegerType()),
    T.StructField("event_date", T.DateType()),
])

# --- users as bits ------------------------------------------------------------

USER_NUMBERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("user_no", T.LongType()),
])

USER_DAYS_SCHEMA = T.StructType([
    T.StructField("team_id", T.StringType()),
    T.StructField("chunk", T.LongType()),
    T.StructField("users", T.BinaryType()),
    T.StructField("summary_date", T.DateType()),
])

# --- loads --------------------------------------------------------------------

LEDGER_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("line_count", T.LongType()),
    T.StructField("load_id", T.StringType()),
])

JOURNAL_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
])

# The document a hook reads from its standard input; it holds no identity.
HOOK_INPUT = (
    "session_id", "transcript_path", "cwd", "permission_mode", "hook_event_name", "tool_name",
    "tool_use_id", "tool_input", "tool_response", "error", "is_interrupt", "prompt", "source", "model",
    "agent_type", "reason", "agent_id", "agent_transcript_path", "stop_hook_active",
    "last_assistant_message", "message", "title", "notification_type", "trigger",
    "custom_instructions",
)

# Payload columns that redaction drops: free text, and paths, which name users.
PRIVATE_COLUMNS = (
    "prompt", "tool_input", "tool_response", "message", "title", "error",
    "last_assistant_message", "custom_instructions", "raw_input",
    "cwd", "transcript_path", "agent_transcript_path",
)
