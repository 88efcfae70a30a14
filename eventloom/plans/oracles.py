"""Checking SQL for the named queries, written against the bundled tables."""

from __future__ import annotations

from eventloom.plans.ingest_cases import DEFECTS, RENAMES
from eventloom.schema import HOOK_INPUT, LIMIT_PHRASES, NO_PROJECT, PRIVATE_COLUMNS, STOP_LABELS, WEEKDAY_LABELS
from eventloom.sources import testdata as td

_TEAM = f"team_id = '{td.TEAM}'"
_CUR_D = "summary_date >= DATE '2024-01-24'"
_PREV_D = "summary_date >= DATE '2024-01-17' AND summary_date < DATE '2024-01-24'"
_CUR_E = "event_timestamp >= TIMESTAMP '2024-01-24 00:00:00'"
_UTC = "(event_timestamp - INTERVAL 9 HOUR)"
_ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"


def _staged() -> str:
    return f"""e0 AS (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
e1 AS (SELECT *, {td.EVENT_TYPE} AS et FROM e0),
e2 AS (SELECT *, {td.TOOL} AS tool, ts + INTERVAL 9 HOUR AS jst,
  strftime(ts, '%Y%m%d') AS utc_day FROM e1)"""


def _columns(mapping: dict[str, str]) -> str:
    return ",\n".join(f"{sql} AS {name}" for name, sql in mapping.items())


_EV = f"""{_staged()},
ev AS (SELECT *, CAST(event_timestamp AS DATE) AS event_date
  FROM (SELECT {_columns(td.EVENT_COLUMNS)} FROM e2))"""

_HOOKS = f"""{_staged()},
hk AS (SELECT {_columns(td.HOOK_COLUMNS)} FROM e2)"""


def _n(condition: str, alias: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {alias}"


_MSG = "event_type = 'UserPromptSubmit'"
_START = "event_type = 'SessionStart'"
_CALL = "event_type IN ('PostToolUse', 'PreToolUse')"

_MART_COUNTS = ",\n".join([
    "count(*) AS total_events", _n(_MSG, "message_count"), _n(_START, "session_count"),
    _n("tool_name IS NOT NULL", "tool_execution_count"), _n("is_mcp", "mcp_count"),
    _n("is_subagent", "subagent_count"), _n("is_command", "command_count"),
    _n("is_skill", "skill_count"), _n("is_usage_limit", "limit_hit_count"),
])

_MARTS = f"""{_EV},
daily AS (SELECT event_date AS summary_date, team_id, {_MART_COUNTS},
  count(DISTINCT user_id) AS active_users,
  round(avg(CASE WHEN tool_success IS NOT NULL THEN CASE WHEN tool_success THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END) * 100, 1)
    AS success_rate
  FROM ev GROUP BY event_date, team_id),
usr AS (SELECT event_date AS summary_date, user_id, team_id, {_MART_COUNTS},
  max(event_timestamp) AS last_active_at FROM ev GROUP BY event_date, user_id, team_id),
tls AS (SELECT event_date AS summary_date, team_id, tool_name, count(*) AS execution_count,
  {_n("tool_success = true", "success_count")}, {_n("tool_success = false", "failure_count")}
  FROM ev WHERE tool_name IS NOT NULL GROUP BY event_date, team_id, tool_name)"""


def _ev(sql: str) -> str:
    return f"WITH {_EV}\n{sql}"


def _mart(sql: str) -> str:
    return f"WITH {_MARTS}\n{sql}"


def _sum(column: str, alias: str | None = None, where: str | None = None) -> str:
    flt = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum({column}){flt} AS BIGINT) AS {alias or column}"


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 1)"


def _exact(value: str) -> str:
    """One decimal by the exact binary value, ties to even, without a negative zero."""
    return f"(CAST(printf('%.1f', {value}) AS DOUBLE) + 0)"


def _change(cur: str, prev: str) -> str:
    c, p = f"coalesce({cur}, 0)", f"coalesce({prev}, 0)"
    return (f"CASE WHEN {p} = 0 THEN CASE WHEN {c} > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END"
            f" ELSE {_exact(f'CAST({c} - {p} AS DOUBLE) / {p} * 100')} END")


def _has_phrase(text: str) -> str:
    quoted = [p.replace("'", "''") for p in LIMIT_PHRASES]
    return "(" + " OR ".join(f"contains(lower({text}), '{p}')" for p in quoted) + ")"


def _case_map(col: str, mapping: dict) -> str:
    def lit(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE CAST({col} AS VARCHAR) END"


# --- shared query bodies ----------------------------------------------------

_KPI = f"""SELECT
 (SELECT {_sum("message_count")} FROM daily WHERE {_TEAM} AND {_CUR_D}) AS msg_count,
 (SELECT {_sum("session_count")} FROM daily WHERE {_TEAM} AND {_CUR_D}) AS sess_count,
 (SELECT count(DISTINCT user_id) FROM usr WHERE {_TEAM} AND {_CUR_D}) AS active_users,
 (SELECT {_sum("skill_count")} FROM daily WHERE {_TEAM} AND {_CUR_D}) AS skill_count,
 (SELECT {_sum("mcp_count")} FROM daily WHERE {_TEAM} AND {_CUR_D}) AS mcp_count,
 (SELECT {_sum("limit_hit_count")} FROM daily WHERE {_TEAM} AND {_CUR_D}) AS limit_hits,
 (SELECT {_sum("message_count")} FROM daily WHERE {_TEAM} AND {_PREV_D}) AS prev_msg,
 (SELECT {_sum("session_count")} FROM daily WHERE {_TEAM} AND {_PREV_D}) AS prev_sess,
 (SELECT count(DISTINCT user_id) FROM usr WHERE {_TEAM} AND {_PREV_D}) AS prev_users,
 (SELECT {_sum("skill_count")} FROM daily WHERE {_TEAM} AND {_PREV_D}) AS prev_skill,
 (SELECT {_sum("mcp_count")} FROM daily WHERE {_TEAM} AND {_PREV_D}) AS prev_mcp,
 (SELECT count(DISTINCT user_id) FROM usr WHERE {_TEAM}) AS total_users"""

_HEATMAP = f"""SELECT CAST(dayofweek(event_timestamp) AS INT) AS dow,
 CAST(hour(event_timestamp) AS INT) AS hour_of_day, count(*) AS event_count
 FROM ev WHERE {_TEAM} AND {_CUR_E} GROUP BY 1, 2"""

_HEATMAP_DENSE = f"""SELECT CAST((d.dow + 6) % 7 AS INT) AS day_order, d.dow,
 {_case_map("d.dow", WEEKDAY_LABELS)} AS weekday, h.hour_of_day,
 coalesce(c.event_count, 0) AS event_count
 FROM (SELECT CAST(unnest(range(7)) AS INT) AS dow) d
 CROSS JOIN (SELECT CAST(unnest(range(24)) AS INT) AS hour_of_day) h
 LEFT JOIN ({_HEATMAP}) c ON c.dow = d.dow AND c.hour_of_day = h.hour_of_day"""

_LEADERBOARD = f"""SELECT user_id, split_part(user_id, '@', 1) AS display_name,
 {_sum("skill_count")}, {_sum("subagent_count")}, {_sum("mcp_count")}, {_sum("command_count")},
 {_sum("message_count")}, {_sum("session_count")}, {_sum("limit_hit_count", "limit_hits")},
 {_sum("total_events", "total_count")}, max(last_active_at) AS last_active,
 min(summary_date) AS first_active
 FROM usr WHERE {_TEAM} AND {_CUR_D} GROUP BY user_id ORDER BY total_count DESC, user_id LIMIT 30"""

_TOOLS = f"""SELECT tool_name, {_sum("execution_count", "total_count")}, {_sum("success_count")},
 {_pct("sum(success_count)", "sum(execution_count)")} AS success_rate
 FROM tls WHERE {_TEAM} AND {_CUR_D} GROUP BY tool_name ORDER BY total_count DESC, tool_name LIMIT 15"""

_SESSION_KPI = f"""SELECT count(*) AS total_sessions,
 round(avg(date_diff('minute', start_time, end_time)), 1) AS avg_duration_min,
 CAST(sum(is_limit) AS BIGINT) AS limit_stopped,
 {_n("stop_reason = 'normal'", "normal_stopped")},
 count(DISTINCT user_id) AS active_users_sess
 FROM (SELECT session_id, user_id, min(event_timestamp) AS start_time,
   max(event_timestamp) AS end_time,
   max(CASE WHEN stop_reason = 'usage_limit' THEN 1 ELSE 0 END) AS is_limit,
   coalesce(max(stop_reason), 'unknown') AS stop_reason
   FROM ev WHERE {_TEAM} AND {_CUR_E} GROUP BY session_id, user_id)"""

_STOPS = f"""SELECT coalesce(stop_reason, 'unknown') AS stop_reason,
 count(DISTINCT session_id) AS session_count
 FROM ev WHERE {_TEAM} AND event_type = 'Stop' AND {_CUR_E} GROUP BY 1"""

_LIMIT_HOURS = f"""SELECT CAST(hour(event_timestamp) AS INT) AS hour_of_day, count(*) AS limit_hits
 FROM ev WHERE {_TEAM} AND is_usage_limit AND {_CUR_E} GROUP BY 1"""

_PROJECTS = f"""SELECT coalesce(project_name, '{NO_PROJECT}') AS project_name,
 count(*) AS event_count, count(DISTINCT user_id) AS user_count, {_n(_MSG, "msg_count")},
 {_n("is_skill", "skill_count")}, {_n("is_mcp", "mcp_count")}
 FROM ev WHERE {_TEAM} AND {_CUR_E} GROUP BY 1 ORDER BY event_count DESC, 1 LIMIT 15"""

_ADOPTION = f"""SELECT count(DISTINCT user_id) AS total_users,
 count(DISTINCT CASE WHEN s > 0 THEN user_id END) AS skill_users,
 count(DISTINCT CASE WHEN m > 0 THEN user_id END) AS mcp_users,
 count(DISTINCT CASE WHEN a > 0 THEN user_id END) AS subagent_users,
 count(DISTINCT CASE WHEN c > 0 THEN user_id END) AS command_users
 FROM (SELECT user_id, sum(skill_count) AS s, sum(mcp_count) AS m, sum(subagent_count) AS a,
   sum(command_count) AS c FROM usr WHERE {_TEAM} AND {_CUR_D} GROUP BY user_id)"""


def _roi() -> str:
    def features(period: str, prefix: str) -> str:
        return f"""SELECT count(DISTINCT user_id) AS {prefix}feat_total,
 count(DISTINCT CASE WHEN s > 0 THEN user_id END) AS {prefix}skill_users,
 count(DISTINCT CASE WHEN m > 0 THEN user_id END) AS {prefix}mcp_users,
 count(DISTINCT CASE WHEN a > 0 THEN user_id END) AS {prefix}sa_users,
 count(DISTINCT CASE WHEN c > 0 THEN user_id END) AS {prefix}cmd_users
 FROM (SELECT user_id, sum(skill_count) AS s, sum(mcp_count) AS m, sum(subagent_count) AS a,
   sum(command_count) AS c FROM usr WHERE {_TEAM} AND {period} GROUP BY user_id)"""

    def users(period: str, prefix: str) -> str:
        return (f"SELECT count(DISTINCT user_id) AS {prefix}active_users,"
                f" {_sum('total_events', prefix + 'total_events')}"
                f" FROM usr WHERE {_TEAM} AND {period}")

    def tools(period: str, prefix: str) -> str:
        return (f"SELECT {_sum('success_count', prefix + 'tool_success')},"
                f" {_sum('execution_count', prefix + 'tool_total')}"
                f" FROM tls WHERE {_TEAM} AND {period}")

    parts = [
        f"SELECT {_sum('tool_execution_count', 'tool_execs')}, {_sum('message_count', 'msg_count')},"
        f" {_sum('session_count', 'sess_count')} FROM daily WHERE {_TEAM} AND {_CUR_D}",
        f"SELECT {_sum('tool_execution_count', 'prev_tool_execs')}"
        f" FROM daily WHERE {_TEAM} AND {_PREV_D}",
        users(_CUR_D, ""), users(_PREV_D, "prev_"), features(_CUR_D, ""),
        features(_PREV_D, "prev_"), tools(_CUR_D, ""), tools(_PREV_D, "prev_"),
        f"SELECT count(DISTINCT user_id) AS total_users FROM usr WHERE {_TEAM}",
    ]
    return "SELECT * FROM " + ", ".join(f"({p}) p{i}" for i, p in enumerate(parts))


def _roi_summary() -> str:
    def figures(prefix: str) -> str:
        def get(name: str) -> str:
            return f"coalesce({prefix}{name}, 0)"

        total = f"greatest(coalesce({prefix}feat_total, 1), 1)"
        depth = " + ".join(f"CAST({get(col)} AS DOUBLE) / {total} * {w}::DOUBLE" for col, w in [
            ("skill_users", "0.3"), ("mcp_users", "0.3"), ("sa_users", "0.2"), ("cmd_users", "0.2")])
        per_user = f"CAST({get('total_events')} AS DOUBLE) / greatest({get('active_users')}, 1)"
        success = f"CAST({get('tool_success')} AS DOUBLE) / greatest(coalesce({prefix}tool_total, 1), 1) * 100"
        return f"""{_exact(get("tool_execs") + " * 2 / 60.0::DOUBLE")} AS {prefix}hours_saved,
 {_exact(per_user)} AS {prefix}events_per_user,
 {_exact(success)} AS {prefix}tool_success_pct,
 {_exact(f"({depth}) * 100")} AS {prefix}depth_score"""

    names = ["hours_saved", "events_per_user", "tool_success_pct", "depth_score"]
    changes = ", ".join(f"{_change(n, 'prev_' + n)} AS {n}_change" for n in names)
    annual = "hours_saved * (365::DOUBLE / 7)"
    scaled = f"{annual} * (CAST(total AS DOUBLE) / active)"
    return f"""SELECT {", ".join(names)}, {", ".join("prev_" + n for n in names)}, {changes},
 {annual} AS annual_hours, {annual} / 160.0::DOUBLE AS annual_person_months,
 hours_saved / active AS hours_per_user, {scaled} AS scaled_annual_hours,
 {scaled} / 160.0::DOUBLE AS scaled_person_months,
 CAST(round_even(CAST(active AS DOUBLE) / total * 100, 0) AS BIGINT) AS active_pct
 FROM (SELECT greatest(active_users, 1) AS active, greatest(total_users, 1) AS total,
 {figures("")}, {figures("prev_")} FROM ({_roi()}))"""


def _cards() -> str:
    cards = [("messages", "msg_count", "prev_msg"), ("sessions", "sess_count", "prev_sess"),
             ("active_users", "active_users", "prev_users"), ("skills", "skill_count", "prev_skill"),
             ("mcp", "mcp_count", "prev_mcp"), ("limit_hits", "limit_hits", None)]
    rows = []
    for name, cur, prev in cards:
        change = _change(cur, prev) if prev else "0.0::DOUBLE"
        share = ("CAST(round_even(CAST(active_users AS DOUBLE) / greatest(total_users, 1) * 100, 0) AS BIGINT)"
                 if name == "active_users" else "CAST(NULL AS BIGINT)")
        rows.append(f"SELECT '{name}' AS card, coalesce({cur}, 0) AS value, {change} AS change_pct,"
                    f" {share} AS penetration_pct FROM kpi")
    union = " UNION ALL ".join(rows)
    return f""", kpi AS ({_KPI})
SELECT *, CASE WHEN change_pct > 0 THEN 'pos' WHEN change_pct < 0 THEN 'neg' ELSE 'neu' END AS direction
FROM ({union})"""


def _insights() -> str:
    return f""", kpi AS ({_KPI}),
f AS (SELECT {_change("msg_count", "prev_msg")} AS msg, {_change("mcp_count", "prev_mcp")} AS mcp,
 coalesce(limit_hits, 0) AS hits,
 round_even(CAST(active_users AS DOUBLE) / greatest(total_users, 1) * 100, 0) AS pct FROM kpi)
SELECT 1 AS position, CASE WHEN msg >= 0 THEN 'trend-up' ELSE 'trend-down' END AS style,
 CASE WHEN msg >= 0 THEN 'TREND UP' ELSE 'TREND DOWN' END AS tag, msg AS value,
 'watch_trend' AS advice FROM f
UNION ALL SELECT 2, CASE WHEN mcp > 5 THEN 'trend-up' ELSE 'usecase' END,
 CASE WHEN mcp > 5 THEN 'MCP ADOPTION' ELSE 'USECASE' END, mcp,
 CASE WHEN mcp > 5 THEN 'mcp_growing' ELSE 'code_generation' END FROM f
UNION ALL SELECT 3, 'power-user', 'POWER USER', NULL, 'share_skills' FROM f
UNION ALL SELECT 4, CASE WHEN hits > 10 THEN 'trend-down' ELSE 'neutral' END, 'USAGE LIMIT',
 CAST(hits AS DOUBLE), CASE WHEN hits > 0 THEN 'plan_usage' ELSE 'no_limit_hits' END FROM f
UNION ALL SELECT 5, 'neutral', 'ADOPTION', pct,
 CASE WHEN pct < 80 THEN 'reach_inactive' ELSE 'high_adoption' END FROM f"""


def _adoption_long() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {col} AS users, greatest(total_users, 1) AS total_users FROM ad"
        for name, col in [("Skill", "skill_users"), ("MCP", "mcp_users"),
                          ("Subagent", "subagent_users"), ("Command", "command_users")])
    return f""", ad AS ({_ADOPTION})
SELECT *, CAST(round_even(CAST(users AS DOUBLE) / total_users * 100, 0) AS BIGINT) AS feature_pct,
 total_users - users AS non_adopters FROM ({rows})"""


_WEEKLY = f"""SELECT CAST(date_trunc('week', summary_date) AS DATE) AS week_start,
 {_sum("message_count", "messages")}, {_sum("skill_count", "skills")}, {_sum("mcp_count", "mcp")},
 CAST(greatest(sum(tool_execution_count) - sum(skill_count) - sum(mcp_count), 0) AS BIGINT)
   AS basic_tools
 FROM daily WHERE {_TEAM} AND summary_date >= DATE '2024-01-01' GROUP BY 1"""


def _time_ago() -> str:
    seconds = ("CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_active))"
               " / 1000000.0) AS BIGINT)")
    rest = f"((({seconds}) % 86400 + 86400) % 86400)"
    return f"""CASE WHEN last_active IS NULL THEN '-'
 WHEN floor({seconds} / 86400.0) > 0 THEN concat(CAST(floor({seconds} / 86400.0) AS BIGINT), ' days')
 WHEN {rest} // 3600 > 0 THEN concat({rest} // 3600, ' hours')
 WHEN {rest} // 60 > 0 THEN concat({rest} // 60, ' minutes') ELSE 'now' END"""


_API_WINDOW = {
    "now": "event_timestamp >= TIMESTAMP '2024-01-24 00:00:00'",
    "before": "event_timestamp >= TIMESTAMP '2024-01-17 00:00:00'"
              " AND event_timestamp < TIMESTAMP '2024-01-24 00:00:00'",
}


def _api_stats() -> str:
    measures = {"skill": "is_skill", "subagent": "event_type = 'SubagentStop'", "mcp": "is_mcp",
                "message": _MSG, "session": _START, "command": "is_command"}
    now = ", ".join(_n(f"{_API_WINDOW['now']} AND ({c})", f"{m}_count") for m, c in measures.items())
    before = ", ".join(_n(f"{_API_WINDOW['before']} AND ({c})", f"{m}_before")
                       for m, c in measures.items())
    changes = ", ".join(f"{_change(m + '_count', m + '_before')} AS {m}_change"
                        for m in measures if m != "command")
    return f"""SELECT {", ".join(m + "_count" for m in measures)}, active_users, total_users, {changes},
 '2024-01-23T15:00:00.000000+00:00' AS period_start, '2024-01-30T15:00:00.000000+00:00' AS period_end
 FROM (SELECT {now}, {before},
 count(DISTINCT CASE WHEN {_API_WINDOW['now']} THEN user_id END) AS active_users,
 count(DISTINCT user_id) AS total_users FROM ev WHERE {_TEAM})"""


_PERSONAL = f"{_UTC} >= TIMESTAMP '2024-01-24 00:00:00'"

# --- normalisation ----------------------------------------------------------

_FLAGS = {
    "skill": "lower({t}) LIKE 'notebook%'",
    "subagent": "lower({t}) = 'task' OR lower({t}) LIKE 'task\\_%' ESCAPE '\\'",
    "mcp": "lower({t}) LIKE 'mcp\\_\\_%' ESCAPE '\\' OR coalesce(contains({i}, 'mcp_server'), false)",
    "command": "lower({t}) IN ('bash', 'execute_bash')",
    "file_operation": "lower({t}) IN ('read', 'write', 'edit', 'multiedit', 'glob', 'grep', 'ls')",
}


def _flags(tool: str, tool_input: str, prefix: str = "", when: str | None = None,
           agent: str | None = None) -> str:
    parts = []
    for name, sql in _FLAGS.items():
        flag = "(" + sql.format(t=tool, i=tool_input) + ")"
        if when:
            other = f" WHEN {agent} THEN true" if name == "subagent" else ""
            flag = f"CASE WHEN {when} THEN {flag}{other} END"
        parts.append(f"{flag} AS {prefix}{name}")
    return ", ".join(parts)


def _person(anonymous: bool) -> str:
    account = "concat(coalesce(nullif(username, ''), 'unknown'), '@', hostname)"
    if anonymous:
        account = f"substring(sha256({account}), 1, 16)"
    return f"coalesce(nullif(trim(explicit_user_id), ''), {account})"


_PROJECT = """CASE WHEN coalesce(project_dir, '') = '' THEN 'unknown'
 ELSE list_extract(string_split(replace(rtrim(project_dir, '/' || chr(92)), chr(92), '/'), '/'), -1) END"""

_DOCS = f"docs AS (SELECT concat('doc-', doc_id) AS path, {td.DOCUMENT_TEXT} AS value FROM documents)"


def _doc_stop(lines: int) -> str:
    # Line ends in the documents are LF or CR LF; one final line end is dropped.
    parts = ("string_split(regexp_replace(replace(value, chr(13) || chr(10), chr(10)),"
             " '\\n$', ''), chr(10))")
    tail = f"array_to_string(list_slice({parts}, greatest(len({parts}) - {lines - 1}, 1), len({parts})), ' ')"
    return f"SELECT path, CASE WHEN {_has_phrase(tail)} THEN 'usage_limit' ELSE 'normal' END AS stop_reason FROM docs"


# Members of the document that a hook reads, in its order; absent ones are left out.
_STDIN = ", ".join(f"'{name}', {name}" for name in HOOK_INPUT)


def _hooks_payload() -> str:
    tool = "event_type IN ('PreToolUse', 'PostToolUse', 'PostToolUseFailure')"
    agent = "event_type IN ('SubagentStart', 'SubagentStop')"

    def only(condition: str, value: str, alias: str) -> str:
        return f"CASE WHEN {condition} THEN {value} END AS {alias}"

    def text(name: str, default: str = "") -> str:
        return f"coalesce({name}, '{default}')"

    def kind(name: str) -> str:
        return f"event_type = '{name}'"

    stops = "event_type IN ('SubagentStop', 'Stop')"
    cols = [
        "event_id", "event_type", f"strftime(ts, {_ISO}) AS timestamp",
        f"{_person(False)} AS user_id", f"'{td.TEAM}' AS team_id", f"{_PROJECT} AS project",
        f"{text('session_id')} AS session_id", f"{text('transcript_path')} AS transcript_path",
        "cwd", f"{text('permission_mode')} AS permission_mode",
        "coalesce(hook_event_name, event_type) AS hook_event_name",
        f"CAST(json_merge_patch('{{}}', json_object({_STDIN})) AS VARCHAR) AS raw_input",
        only(tool, text("tool_name", "unknown"), "tool_name"),
        only(tool, text("tool_use_id"), "tool_use_id"),
        only(tool, text("tool_input", "{}"), "tool_input"),
        only(kind("PostToolUse"), text("tool_response"), "tool_response"),
        only(kind("PostToolUse"), f"CAST(length({text('tool_response')}) AS BIGINT)", "output_length"),
        "CASE event_type WHEN 'PostToolUse' THEN true WHEN 'PostToolUseFailure' THEN false END AS success",
        only(kind("PostToolUseFailure"), text("error"), "error"),
        only(kind("PostToolUseFailure"), "coalesce(is_interrupt, false)", "is_interrupt"),
        only(kind("UserPromptSubmit"), text("prompt"), "prompt"),
        only(kind("UserPromptSubmit"), f"CAST(length({text('prompt')}) AS BIGINT)", "prompt_length"),
        only(kind("SessionStart"), text("source", "unknown"), "source"),
        only(kind("SessionStart"), text("model", "unknown"), "model"),
        only("event_type IN ('SessionStart', 'SubagentStart', 'SubagentStop')",
             text("agent_type"), "agent_type"),
        only(kind("SessionEnd"), text("reason", "other"), "reason"),
        only(agent, text("agent_id"), "agent_id"),
        only(kind("SubagentStop"), text("agent_transcript_path"), "agent_transcript_path"),
        only(stops, "coalesce(stop_hook_active, false)", "stop_hook_active"),
        only(stops, text("last_assistant_message"), "last_assistant_message"),
        only(kind("Notification"), text("message"), "message"),
        only(kind("Notification"), text("title"), "title"),
        only(kind("Notification"), text("notification_type"), "notification_type"),
        only(kind("Notification"),
             f"{_has_phrase(text('message'))} OR {_has_phrase(text('title'))}", "is_usage_limit"),
        only(kind("PreCompact"), text("trigger"), "trigger"),
        only(kind("PreCompact"), text("custom_instructions"), "custom_instructions"),
        only(kind("Stop"), "coalesce(s.stop_reason, 'unknown')", "stop_reason"),
        _flags("coalesce(tool_name, 'unknown')", "coalesce(tool_input, '{}')", "cat_", tool, agent),
    ]
    return f"""WITH {_HOOKS}, {_DOCS}, st AS ({_doc_stop(30)})
SELECT {", ".join(cols)} FROM hk LEFT JOIN st s ON s.path = hk.transcript_path"""


# --- admin ------------------------------------------------------------------

_REMAP = ("CASE user_id WHEN 'user0' THEN 'user1@example.com'"
          " WHEN 'user8@example.com' THEN 'user8b@example.com'"
          " WHEN 'user9@example.com' THEN 'user8b@example.com' ELSE user_id END")
_MART_NAMES = ["total_events", "message_count", "session_count", "tool_execution_count", "mcp_count",
               "subagent_count", "command_count", "skill_count", "limit_hit_count"]


_SESSIONS = (
    "SELECT session_id, user_id, team_id, min(event_timestamp) AS session_start,"
    " max(event_timestamp) AS session_end,"
    " date_diff('minute', min(event_timestamp), max(event_timestamp)) AS duration_min,"
    f" count(*) AS event_count, {_n(_MSG, 'message_count')},"
    f" {_n('tool_name IS NOT NULL', 'tool_count')} FROM ev GROUP BY 1, 2, 3")


def _counts_of(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
                              for name, source in tables.items())


def _quarantine() -> str:
    whens = " ".join(f"WHEN {cond} THEN '{reason}'" for reason, cond in DEFECTS.items())
    return (f"SELECT CASE {whens} ELSE 'accepted' END AS reject_reason, count(*) AS line_count"
            " FROM events GROUP BY 1")


_EVENT_ROWS = f"SELECT {', '.join(td.EVENT_COLUMNS)} FROM ev"
_DAY_COUNTS = ", ".join([
    "count(*) AS total_events", _n(_MSG, "message_count"), _n(_START, "session_count"),
    _n("tool_name IS NOT NULL", "tool_count"), _n("is_mcp", "mcp_count"),
    _n("is_subagent", "subagent_count"), _n("is_command", "command_count"),
    _n("is_skill", "skill_count"), _n("is_usage_limit", "limit_hit_count"),
])
_TOOL_DAY = f"""team_id, tool_name, event_date, count(*) AS execution_count,
 {_n("tool_success = true", "success_count")}, {_n("tool_success = false", "failure_count")},
 {_pct("count(*) FILTER (WHERE tool_success = true)", "count(*)")} AS success_rate"""


def _validated() -> str:
    bad = {
        "event_type": "CASE event_id % 11 WHEN 0 THEN 'event_type_not_text' WHEN 1 THEN 'missing_event_type' END",
        "timestamp": "CASE WHEN event_id % 17 = 3 THEN 'timestamp_not_text' END",
        "user_id": "CASE WHEN event_id % 13 = 0 THEN 'missing_user_id' END",
        "team_id": "CASE WHEN event_id % 19 = 4 THEN 'team_id_not_text' END",
        "categories": "CASE WHEN event_id % 8 IN (2, 3) THEN 'categories_not_flags' END",
        "success": "CASE WHEN event_id % 7 = 3 THEN 'success_not_flag' END",
        "output_length": "CASE WHEN event_id % 6 = 3 THEN 'output_length_not_number' END",
        "error": "CASE WHEN event_id % 23 = 5 THEN 'error_not_text' END",
        "metadata": "CASE WHEN event_id % 29 = 6 THEN 'metadata_not_object' END",
    }
    return f"""SELECT event_id, r AS reject_reasons,
 CASE WHEN r IS NULL THEN 'Stop' END AS event_type,
 CASE WHEN r IS NULL THEN CASE WHEN event_id % 5 = 3 THEN 'web' ELSE '' END END AS project,
 CASE WHEN r IS NULL THEN CASE event_id % 7 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false
   WHEN 5 THEN true WHEN 6 THEN false END END AS success,
 CASE WHEN r IS NULL THEN CAST(CASE event_id % 6 WHEN 0 THEN 12 WHEN 1 THEN 34 WHEN 2 THEN 5 WHEN 4 THEN 1
   ELSE -7 END AS BIGINT) END AS output_length,
 CASE WHEN r IS NULL THEN CASE event_id % 8 WHEN 0 THEN 'mcp' WHEN 4 THEN 'mcp' WHEN 6 THEN ''
   WHEN 7 THEN 'command,mcp' END END AS flags
FROM (SELECT event_id, CASE WHEN event_id % 31 IN (7, 8) THEN 'not_an_object'
  ELSE nullif(concat_ws(',', {", ".join(bad.values())}), '') END AS r FROM events)"""


def _file_stop_reasons() -> str:
    return f"""WITH d AS (SELECT doc_id % {td.FILES} AS file, doc_id,
  regexp_replace({td.FILE_TEXT}, '\\r\\n?|[\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]',
    chr(10), 'g') AS t FROM documents),
l AS (SELECT file, doc_id, unnest(string_split(t, chr(10))) AS line,
  generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
b AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY doc_id DESC, pos DESC) AS back FROM l),
tails AS (SELECT file, string_agg(line, ' ' ORDER BY back DESC) AS tail FROM b WHERE back <= 30 GROUP BY file)
SELECT file, CASE WHEN {_has_phrase("tail")} THEN 'usage_limit' ELSE 'normal' END AS stop_reason FROM tails"""


def _listed_files() -> str:
    iso = f"strftime({_UTC}, {_ISO})"
    line = td.PLAIN_LINE.replace("{iso}", iso)
    return f"""f AS (SELECT event_date AS log_date, sum(strlen({line}) + 1) AS size, count(*) AS event_count,
  event_date <= DATE '2024-01-20' AS loaded FROM ev GROUP BY 1
  UNION ALL SELECT DATE '2024-03-01', 0, 0, true)"""


def _view_counts() -> dict[str, str]:
    """Rows of each view: distinct keys of the events it groups."""
    keys = {
        "v_kpi_metrics": "team_id, event_date", "v_user_ranking": "user_id, team_id",
        "v_tool_ranking": "team_id, tool_name, event_date", "v_overview_daily": "team_id, event_date",
        "v_user_stats": "user_id, team_id", "v_tool_stats": "team_id, tool_name, event_date",
        "v_session_stats": "session_id, user_id, team_id",
        "v_project_stats": f"team_id, coalesce(nullif(project_name, ''), '{NO_PROJECT}')",
        "v_monthly_active": "team_id, date_trunc('month', event_timestamp)",
        "v_feature_adoption": "team_id, event_date",
    }
    return {name: f"(SELECT DISTINCT {columns} FROM ev"
                  f"{' WHERE tool_name IS NOT NULL' if 'tool' in name else ''})"
            for name, columns in keys.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "daily_summary": _mart("SELECT * FROM daily"),
        "user_summary": _mart("SELECT * FROM usr"),
        "tool_summary": _mart("SELECT * FROM tls"),
        # views
        "v_kpi_metrics": _ev(f"SELECT team_id, event_date, {_DAY_COUNTS},"
                             " count(DISTINCT user_id) AS active_users FROM ev GROUP BY 1, 2"),
        "v_overview_daily": _ev(
            f"SELECT team_id, event_date, {_DAY_COUNTS}, {_n('is_file_operation', 'file_op_count')},"
            " count(DISTINCT user_id) AS active_users FROM ev GROUP BY 1, 2"),
        "v_user_ranking": _ev(
            "SELECT user_id, team_id, split_part(user_id, '@', 1) AS display_name,"
            f" count(*) AS total_count, {_n(_MSG, 'message_count')}, {_n('is_skill', 'skill_count')},"
            f" {_n('is_subagent', 'subagent_count')}, {_n('is_mcp', 'mcp_count')},"
            f" {_n('is_command', 'command_count')}, {_n('is_usage_limit', 'limit_hit_count')},"
            " max(event_timestamp) AS last_active_at FROM ev GROUP BY 1, 2"),
        "v_user_stats": _ev(
            f"SELECT user_id, team_id, count(*) AS total_count, {_n(_MSG, 'message_count')},"
            f" {_n(_START, 'session_count')}, {_n('is_skill', 'skill_count')},"
            f" {_n('is_subagent', 'subagent_count')}, {_n('is_mcp', 'mcp_count')},"
            f" {_n('is_command', 'command_count')}, {_n('is_file_operation', 'file_op_count')},"
            f" {_n('is_usage_limit', 'limit_hit_count')}, max(event_timestamp) AS last_active_at,"
            " min(event_date) AS first_active_date FROM ev GROUP BY 1, 2"),
        "v_tool_ranking": _ev(f"SELECT {_TOOL_DAY} FROM ev WHERE tool_name IS NOT NULL GROUP BY 1, 2, 3"),
        "v_tool_stats": _ev(f"SELECT {_TOOL_DAY}, avg(output_length) AS avg_output_length"
                            " FROM ev WHERE tool_name IS NOT NULL GROUP BY 1, 2, 3"),
        "v_session_stats": _ev(_SESSIONS),
        "v_project_stats": _ev(
            f"SELECT team_id, coalesce(nullif(project_name, ''), '{NO_PROJECT}') AS project_name,"
            f" count(*) AS event_count, count(DISTINCT user_id) AS user_count, {_n(_MSG, 'msg_count')},"
            f" {_n(_START, 'session_count')}, {_n('is_skill', 'skill_count')},"
            f" {_n('is_mcp', 'mcp_count')}, {_n('is_command', 'command_count')},"
            " max(event_timestamp) AS last_active_at FROM ev GROUP BY 1, 2"),
        "v_monthly_active": _ev(
            "SELECT team_id, CAST(date_trunc('month', event_timestamp) AS DATE) AS month,"
            " count(DISTINCT user_id) AS active_users, count(DISTINCT session_id) AS sessions,"
            f" {_n(_MSG, 'messages')}, count(*) AS total_events FROM ev GROUP BY 1, 2"),
        "v_feature_adoption": _ev(
            "SELECT team_id, event_date, count(DISTINCT user_id) AS total_users, "
            + ", ".join(f"count(DISTINCT CASE WHEN is_{f} THEN user_id END) AS {f}_users"
                        for f in ("skill", "mcp", "subagent", "command"))
            + " FROM ev GROUP BY 1, 2"),
        # dashboard queries
        "kpi_overview": _mart(_KPI),
        "timeline": _mart(
            "SELECT summary_date AS event_date, message_count AS messages,"
            " tool_execution_count AS tools, session_count AS sessions,"
            f" limit_hit_count AS limit_hits FROM daily WHERE {_TEAM} AND {_CUR_D}"),
        "heatmap": _ev(_HEATMAP),
        "user_leaderboard": _mart(_LEADERBOARD),
        "user_timeline": _mart(
            "SELECT summary_date AS event_date, message_count AS messages, session_count AS sessions,"
            f" limit_hit_count AS limit_hits FROM usr WHERE {_TEAM} AND {_CUR_D}"
            f" AND user_id = '{td.USER}'"),
        "user_top_tools": _ev(
            f"SELECT tool_name, count(*) AS cnt FROM ev WHERE {_TEAM} AND user_id = '{td.USER}'"
            f" AND tool_name IS NOT NULL AND {_CUR_E} GROUP BY 1 ORDER BY cnt DESC, 1 LIMIT 10"),
        "tool_leaderboard": _mart(_TOOLS),
        "tool_trend": _mart(
            "SELECT summary_date AS event_date, tool_name, execution_count AS cnt FROM tls"
            f" WHERE {_TEAM} AND {_CUR_D} AND tool_name IN (SELECT tool_name FROM tls"
            f" WHERE {_TEAM} AND {_CUR_D} GROUP BY tool_name"
            " ORDER BY sum(execution_count) DESC, tool_name LIMIT 5)"),
        "session_kpi": _ev(_SESSION_KPI),
        "stop_reasons": _ev(_STOPS),
        "limit_hits_by_hour": _ev(_LIMIT_HOURS),
        "project_ranking": _ev(_PROJECTS),
        "monthly_active": _mart(
            "SELECT u.month, u.active_users, c.sessions, c.messages FROM (SELECT"
            " CAST(date_trunc('month', summary_date) AS DATE) AS month,"
            f" count(DISTINCT user_id) AS active_users FROM usr WHERE {_TEAM} GROUP BY 1) u"
            " JOIN (SELECT CAST(date_trunc('month', summary_date) AS DATE) AS month,"
            f" {_sum('session_count', 'sessions')}, {_sum('message_count', 'messages')}"
            f" FROM daily WHERE {_TEAM} GROUP BY 1) c ON u.month = c.month"),
        "feature_adoption": _mart(_ADOPTION),
        "roi_kpi": _mart(_roi()),
        "productivity_trend": _mart(
            "SELECT t.summary_date AS event_date, tool_execs, messages, sessions, active_users,"
            " round(CAST(tool_execs AS DOUBLE) / nullif(active_users, 0), 1) AS tools_per_user,"
            " round(CAST(messages AS DOUBLE) / nullif(active_users, 0), 1) AS msgs_per_user"
            f" FROM (SELECT summary_date, {_sum('tool_execution_count', 'tool_execs')},"
            f" {_sum('message_count', 'messages')}, {_sum('session_count', 'sessions')}"
            f" FROM daily WHERE {_TEAM} AND {_CUR_D} GROUP BY 1) t"
            " LEFT JOIN (SELECT summary_date, count(DISTINCT user_id) AS active_users"
            f" FROM usr WHERE {_TEAM} AND {_CUR_D} GROUP BY 1) u ON t.summary_date = u.summary_date"),
        "user_efficiency": _mart(_efficiency()),
        "weekly_feature_mix": _mart(_WEEKLY),
        # service, command line and admin statistics
        "api_stats": _ev(_api_stats()),
        "api_users": _ev(
            "SELECT user_id, split_part(user_id, '@', 1) AS display_name,"
            f" {_n('is_skill', 'skill_count')}, {_subagent_stops()}, {_n('is_mcp', 'mcp_count')},"
            f" {_n('is_command', 'command_count')}, {_n(_MSG, 'message_count')},"
            f" count(*) AS total_count, strftime(max({_UTC}), {_ISO}) AS last_active"
            f" FROM ev WHERE {_TEAM} AND {_CUR_E} GROUP BY 1, 2"
            " ORDER BY total_count DESC, user_id LIMIT 20"),
        "api_tools": _ev(
            "SELECT coalesce(tool_name, 'unknown') AS name, count(*) AS count,"
            " CAST(sum(count(*)) OVER () AS BIGINT) AS total"
            f" FROM ev WHERE {_TEAM} AND {_CUR_E} AND {_CALL} GROUP BY 1"),
        "api_timeline": _ev(
            f"SELECT CAST({_UTC} AS DATE) AS date, {_n(_MSG, 'messages')}, {_n(_CALL, 'tools')},"
            f" {_n(_START, 'sessions')} FROM ev WHERE {_TEAM} AND {_CUR_E}"
            f" AND ({_MSG} OR {_START} OR {_CALL}) GROUP BY 1"),
        "personal_stats": _ev(
            f"SELECT {_n(_MSG, 'messages')}, {_n(_START, 'sessions')}, {_n(_CALL, 'tool_calls')},"
            f" {_n(_CALL + ' AND is_mcp', 'mcp')}, {_n(_CALL + ' AND is_subagent', 'subagent')}"
            f" FROM ev WHERE {_PERSONAL}"),
        "personal_daily": _ev(
            "SELECT date, count, CAST(floor(CAST(count AS DOUBLE) / max(count) OVER () * 20) AS BIGINT)"
            f" AS bar_length FROM (SELECT CAST({_UTC} AS DATE) AS date, count(*) AS count FROM ev"
            f" WHERE {_PERSONAL} GROUP BY 1)"),
        "personal_top_tools": _ev(
            "SELECT tool_name, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, tool_name) AS INT)"
            " AS rank FROM (SELECT coalesce(tool_name, 'unknown') AS tool_name, count(*) AS cnt"
            f" FROM ev WHERE {_PERSONAL} AND {_CALL} GROUP BY 1) ORDER BY cnt DESC, tool_name LIMIT 5"),
        "user_activity": _ev(
            "SELECT user_id, count(*) AS events, min(event_timestamp) AS first_active,"
            " max(event_timestamp) AS last_active FROM ev GROUP BY 1"),
        "layer_row_counts": _mart(_counts_of({
            "raw_events": "events", "events": "ev", "daily_summary": "daily",
            "user_summary": "usr", "tool_summary": "tls"})),
        # derived figures
        "overview_cards": _mart(_cards()),
        "insights": _mart(_insights()),
        "adoption_long": _mart(_adoption_long()),
        "session_cards": _ev(
            "SELECT total_sessions, coalesce(avg_duration_min, 0.0::DOUBLE) AS avg_duration_min,"
            " normal_stopped, coalesce(limit_stopped, 0) AS limit_stopped, CASE WHEN total_sessions > 0"
            f" THEN {_exact('CAST(limit_stopped AS DOUBLE) / total_sessions * 100')} ELSE 0.0::DOUBLE END"
            " AS limit_stop_pct"
            f" FROM ({_SESSION_KPI})"),
        "roi_summary": _mart(_roi_summary()),
        "tool_tiers": _mart(
            "SELECT tool_name, total_count, success_rate, CASE WHEN success_rate IS NULL THEN 'none'"
            " WHEN success_rate >= 90 THEN 'good' WHEN success_rate >= 70 THEN 'warn' ELSE 'bad' END"
            f" AS tier FROM ({_TOOLS}) ORDER BY total_count DESC, tool_name LIMIT 10"),
        "user_ranked": _mart(
            "SELECT CAST(row_number() OVER (ORDER BY total_count DESC, user_id) AS INT) AS rank,"
            f" user_id, display_name, {_time_ago()} AS last_seen,"
            " concat_ws(',', CASE WHEN skill_count > 0 THEN 'skill' END,"
            " CASE WHEN subagent_count > 0 THEN 'agent' END, CASE WHEN mcp_count > 0 THEN 'mcp' END)"
            " AS tags, message_count, session_count, skill_count, mcp_count, limit_hits, total_count"
            f" FROM ({_LEADERBOARD})"),
        "weekly_mix_share": _mart(
            "SELECT week_start, " + ", ".join(
                f"CAST({p} AS DOUBLE) * 100 / nullif(basic_tools + messages + skills + mcp, 0) AS {p}_pct"
                for p in ("basic_tools", "messages", "skills", "mcp"))
            + f" FROM ({_WEEKLY})"),
        "user_bubble": _mart(
            "SELECT *, sessions / CAST(greatest(max(sessions) OVER (), 1) AS DOUBLE) * 30 + 8"
            f" AS marker_size FROM ({_efficiency()})"),
        "limit_hours_dense": _ev(
            "SELECT h.hour_of_day, coalesce(c.limit_hits, 0) AS limit_hits"
            " FROM (SELECT CAST(unnest(range(24)) AS INT) AS hour_of_day) h"
            f" LEFT JOIN ({_LIMIT_HOURS}) c ON c.hour_of_day = h.hour_of_day"),
        "heatmap_dense": _ev(_HEATMAP_DENSE),
        "heatmap_pivot": _ev(
            "SELECT day_order, weekday, " + ", ".join(
                f"CAST(sum(event_count) FILTER (WHERE hour_of_day = {h}) AS BIGINT) AS h{h:02d}"
                for h in range(24))
            + f" FROM ({_HEATMAP_DENSE}) GROUP BY 1, 2"),
        "stop_reason_labels": _ev(
            f"SELECT stop_reason, {_case_map('stop_reason', STOP_LABELS)} AS label, session_count"
            f" FROM ({_STOPS})"),
        "project_table": _ev(
            "SELECT *, list_extract(string_split(project_name, '/'), -1) AS short_name"
            f" FROM ({_PROJECTS})"),
        # normalisation
        "classify_tools": f"WITH {_HOOKS} SELECT event_id, tool_name,"
                          f" {_flags('tool_name', 'tool_input')} FROM"
                          " (SELECT * REPLACE (coalesce(tool_name, 'unknown') AS tool_name) FROM hk)",
        "limit_phrases": f"WITH {_DOCS} SELECT path, {_has_phrase('value')} AS is_usage_limit FROM docs",
        "stop_reason_tail": (
            f"WITH l AS (SELECT conv_id, turn, {td.TURN_LINE} AS line, row_number() OVER"
            " (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),"
            " t AS (SELECT conv_id, string_agg(line, ' ' ORDER BY turn) AS tail FROM l"
            f" WHERE back <= 30 GROUP BY 1) SELECT conv_id, CASE WHEN {_has_phrase('tail')}"
            " THEN 'usage_limit' ELSE 'normal' END AS stop_reason FROM t"),
        "stop_reason_text": f"WITH {_DOCS} {_doc_stop(30)}",
        "pseudonymize": f"WITH {_HOOKS} SELECT event_id, {_person(False)} AS user_id,"
                        f" {_person(True)} AS anonymous_id FROM hk",
        "normalize_hooks": _hooks_payload(),
        "project_names": f"WITH {_HOOKS} SELECT event_id, {_PROJECT} AS project FROM hk",
        "redact": f"SELECT * EXCLUDE ({', '.join(PRIVATE_COLUMNS)}) FROM ({_hooks_payload()})",
        "validate_events": _ev(
            "SELECT event_id, CASE WHEN r IS NULL THEN coalesce(project_name, '') ELSE project_name END"
            " AS project, r AS reject_reason FROM (SELECT *, CASE WHEN event_id % 5 = 0"
            " THEN 'missing_event_type' WHEN event_id % 7 = 0 THEN 'missing_timestamp'"
            " WHEN event_id % 11 = 0 THEN 'missing_user_id' WHEN event_id % 13 = 0"
            " THEN 'missing_team_id' END AS r FROM ev)"),
        # ingest, sources and sinks
        "ingest_clean": _ev(_EVENT_ROWS),
        "ingest_quarantine": _quarantine(),
        "ingest_dedup": _ev(_EVENT_ROWS),
        "ingest_forced_reload": _mart(_counts_of({
            "raw_events": "(SELECT event_id FROM events UNION ALL SELECT event_id FROM events)",
            "events": "ev", "daily_summary": "daily", "user_summary": "usr", "tool_summary": "tls"})),
        "ingest_upsert": _mart("SELECT * FROM daily"),
        "ingest_tool_mart": _mart("SELECT * FROM tls"),
        "user_remap_stored": (
            f"WITH {_EV}, moved AS (SELECT * REPLACE (CASE WHEN event_id % 3 > 0 THEN"
            f" {_case_map('user_id', RENAMES)} ELSE user_id END AS user_id) FROM ev)"
            f" SELECT event_date AS summary_date, user_id, team_id, {_MART_COUNTS},"
            " max(event_timestamp) AS last_active_at FROM moved GROUP BY ALL"),
        "export_csv": _ev(
            "SELECT user_id, concat('  a \"q\", b', chr(10), session_id) AS session_id,"
            " coalesce(tool_name, '') AS tool_name,"
            f" strftime(event_timestamp - INTERVAL 9 HOUR, {_ISO}) AS timestamp FROM ev"),
        "ingest_late_data": _mart("SELECT * FROM usr"),
        "ingest_stage_retry": _mart("SELECT * FROM usr"),
        "ingest_heal": _mart("SELECT * FROM daily"),
        "stored_kpi_overview": _mart(_KPI),
        "stored_roi_kpi": _mart(_roi()),
        "stored_api_stats": _ev(_api_stats()),
        "stored_sessions": _ev(_SESSIONS),
        "stored_session_kpi": _ev(_SESSION_KPI.replace(
            "TIMESTAMP '2024-01-24 00:00:00'", "TIMESTAMP '2024-01-24 13:30:00'")),
        "warehouse_row_counts": _mart(_counts_of({
            "raw_events": "events", "events": "ev", "daily_summary": "daily", "user_summary": "usr",
            "tool_summary": "tls", **_view_counts()})),
        "file_listing": (
            f"WITH {_EV}, {_listed_files()} SELECT log_date, CAST(1 AS BIGINT) AS files,"
            f" {_exact('size / 1024.0::DOUBLE')} AS size_kb, event_count, loaded FROM f"
            f" UNION ALL SELECT NULL, count(*), {_exact('CAST(sum(size) AS DOUBLE) / 1024')},"
            " CAST(sum(event_count) AS BIGINT), NULL FROM f"),
        "file_ledger": f"WITH {_EV}, {_listed_files()} SELECT log_date, NOT loaded AS is_new FROM f",
        "export_json_order": _ev(
            "SELECT event_id, CAST(row_number() OVER (ORDER BY event_date, event_id) AS INT)"
            " AS line_number FROM ev"),
        "stop_reason_files": _file_stop_reasons(),
        "validate_types": _validated(),
        "file_inventory": _ev(
            "SELECT event_date AS log_date, CAST(count(*) AS BIGINT) AS event_count,"
            " event_date <= DATE '2024-01-20' AS loaded, true AS has_size FROM ev GROUP BY 1"),
        "path_provenance": _ev(
            "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN user_id END AS uploader,"
            " event_date AS log_date FROM ev"),
        "jsonl_by_day": _ev("SELECT event_date, event_type, count(*) AS n FROM ev GROUP BY 1, 2"),
        "export_json": _ev("SELECT event_id, event_type, user_id, tool_name, tool_success AS success"
                           " FROM ev WHERE event_type <> 'Stop'"),
        "export_flat": _ev(
            f"SELECT event_id, strftime({_UTC}, {_ISO}) AS timestamp, event_type, user_id,"
            f" CASE WHEN {_TEAM} THEN '' ELSE team_id END AS team_id,"
            " coalesce(project_name, '') AS project, session_id, coalesce(tool_name, '') AS tool_name,"
            " coalesce(CAST(tool_success AS VARCHAR), '') AS success, is_mcp, is_subagent, is_command"
            " FROM ev"),
        "user_remap": _mart(
            f"SELECT summary_date, {_REMAP} AS user_id, team_id, "
            + ", ".join(_sum(name) for name in _MART_NAMES)
            + ", max(last_active_at) AS last_active_at FROM usr GROUP BY 1, 2, 3"),
        "user_remap_events": _ev(
            "SELECT CASE WHEN contains(user_id, '@') THEN user_id"
            " ELSE concat(user_id, '@example.com') END AS user_id, count(*) AS events,"
            " min(event_timestamp) AS first_active, max(event_timestamp) AS last_active"
            " FROM ev GROUP BY 1"),
    }


def _efficiency() -> str:
    return f"""SELECT user_id, split_part(user_id, '@', 1) AS display_name,
 {_sum("message_count", "messages")}, {_sum("session_count", "sessions")}, {_sum("total_events")},
 CAST(sum(skill_count) + sum(mcp_count) + sum(subagent_count) AS BIGINT) AS advanced_features
 FROM usr WHERE {_TEAM} AND {_CUR_D} GROUP BY user_id HAVING sum(message_count) > 0"""


def _subagent_stops() -> str:
    return _n("event_type = 'SubagentStop'", "subagent_count")
