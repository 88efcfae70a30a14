"""Hook records to event payloads."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.clock import iso_utc
from eventloom.functions.text import (
    blank_to_null,
    is_usage_limit,
    last_lines,
    project_name,
    stop_reason_of,
    tool_flags,
    user_identifier,
)
from eventloom.schema import (
    DEFAULT_TEAM,
    HOOK_INPUT,
    LIMIT_PHRASES,
    PRIVATE_COLUMNS,
    TRANSCRIPT_TAIL_LINES,
)

# Payload columns that hold JSON documents.
_DOCUMENTS = ("tool_input", "tool_response", "raw_input")


def classify_tool(df: DataFrame, name_col: str, input_col: str) -> DataFrame:
    """Add the ``categories`` struct of five tool flags."""
    return df.withColumn("categories", tool_flags(F.col(name_col), F.col(input_col)))


# --- stop reasons -----------------------------------------------------------


def stop_reason(transcripts: DataFrame, lines: int = TRANSCRIPT_TAIL_LINES,
                phrases: Iterable[str] = LIMIT_PHRASES) -> DataFrame:
    """Stop reason per whole transcript (path, value)."""
    tails = transcripts.select("path", last_lines(F.col("value"), lines).alias("tail"))
    return tails.select("path", stop_reason_of(F.col("tail"), phrases).alias("stop_reason"))


def stop_reason_by_line(lines: DataFrame, key: str, order: Sequence[str], text: str,
                        tail: int = TRANSCRIPT_TAIL_LINES,
                        phrases: Iterable[str] = LIMIT_PHRASES) -> DataFrame:
    """Stop reason per transcript stored as one row per line.

    The row-number filter is applied within every input partition before the
    shuffle, so a transcript of any length sends at most ``tail`` lines per
    partition; only the last ``tail`` lines are gathered.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    last = (
        lines.select(key, *order, text)
        .withColumn("back", F.row_number().over(newest))
        .filter(F.col("back") <= tail)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("pos"),
                                                  F.coalesce(text, F.lit("")).alias("line"))))
             .alias("tail"))
    )
    joined = last.select(key, F.array_join(F.col("tail.line"), " ").alias("tail"))
    return joined.select(key, stop_reason_of(F.col("tail"), phrases).alias("stop_reason"))


# --- payloads ---------------------------------------------------------------


def _text(name: str, default: str = "") -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _with_stop_reason(hooks: DataFrame, transcripts: DataFrame | None) -> DataFrame:
    """Stop reason per Stop record; other records get none.

    Only Stop records with a transcript path are joined, so neither the rest
    of the records nor the blank paths are shuffled.
    """
    unknown = hooks.withColumn(
        "stop_reason", F.when(F.col("event_type") == "Stop", F.lit("unknown"))
    )
    if transcripts is None:
        return unknown
    joinable = (F.col("event_type") == "Stop") & blank_to_null(F.col("transcript_path")).isNotNull()
    paths = hooks.filter(joinable).select(F.col("transcript_path").alias("path")).distinct()
    # Only transcripts that a record names are searched; one listed twice counts once.
    named = transcripts.join(paths, "path", "left_semi")
    limited = F.max(F.col("stop_reason") == "usage_limit")
    reasons = stop_reason(named).groupBy(F.col("path").alias("transcript_path")).agg(
        F.when(limited, "usage_limit").otherwise("normal").alias("stop_reason"))
    stops = (
        hooks.filter(joinable)
        .join(reasons, "transcript_path", "left")
        .withColumn("stop_reason", F.coalesce("stop_reason", F.lit("unknown")))
    )
    rest = unknown.filter(~F.coalesce(joinable, F.lit(False)))
    return rest.unionByName(stops)


def normalize_hooks(hooks: DataFrame, transcripts: DataFrame | None = None,
                    team_id: str = DEFAULT_TEAM, anonymize: bool = False) -> DataFrame:
    """Payload columns of hook records; fields of other event types are NULL."""
    kind = F.col("event_type")
    df = _with_stop_reason(hooks, transcripts)

    def only(types: Sequence[str], value: Column) -> Column:
        return F.when(kind.isin(*types), value)

    tool = ("PreToolUse", "PostToolUse", "PostToolUseFailure")
    agent = ("SubagentStart", "SubagentStop")
    stops = ("SubagentStop", "Stop")
    none = F.lit(None).cast("boolean")
    agent_flags = F.struct(
        none.alias("skill"), F.lit(True).alias("subagent"), none.alias("mcp"),
        none.alias("command"), none.alias("file_operation"),
    )
    prompt = _text("prompt")
    response = _text("tool_response")
    tool_name, tool_input = _text("tool_name", "unknown"), _text("tool_input", "{}")
    carried = [c for c in hooks.columns if c == "event_id"]
    return df.select(
        *carried,
        "event_type",
        iso_utc(F.col("ts")).alias("timestamp"),
        user_identifier(
            F.col("explicit_user_id"), F.col("username"), F.col("hostname"), anonymize
        ).alias("user_id"),
        F.lit(team_id).alias("team_id"),
        project_name(F.col("project_dir")).alias("project"),
        _text("session_id").alias("session_id"),
        _text("transcript_path").alias("transcript_path"),
        _text("cwd").alias("cwd"),
        _text("permission_mode").alias("permission_mode"),
        F.coalesce("hook_event_name", "event_type").alias("hook_event_name"),
        F.to_json(F.struct(*[c for c in HOOK_INPUT if c in hooks.columns])).alias("raw_input"),
        only(tool, tool_name).alias("tool_name"),
        only(tool, _text("tool_use_id")).alias("tool_use_id"),
        only(tool, tool_input).alias("tool_input"),
        only(["PostToolUse"], response).alias("tool_response"),
        only(["PostToolUse"], F.length(response).cast("bigint")).alias("output_length"),
        F.when(kind == "PostToolUse", F.lit(True))
        .when(kind == "PostToolUseFailure", F.lit(False)).alias("success"),
        only(["PostToolUseFailure"], _text("error")).alias("error"),
        only(["PostToolUseFailure"], _flag("is_interrupt")).alias("is_interrupt"),
        only(["UserPromptSubmit"], prompt).alias("prompt"),
        only(["UserPromptSubmit"], F.length(prompt).cast("bigint")).alias("prompt_length"),
        only(["SessionStart"], _text("source", "unknown")).alias("source"),
        only(["SessionStart"], _text("model", "unknown")).alias("model"),
        only(["SessionStart", *agent], _text("agent_type")).alias("agent_type"),
        only(["SessionEnd"], _text("reason", "other")).alias("reason"),
        only(agent, _text("agent_id")).alias("agent_id"),
        only(["SubagentStop"], _text("agent_transcript_path")).alias("agent_transcript_path"),
        only(stops, _flag("stop_hook_active")).alias("stop_hook_active"),
        only(stops, _text("last_assistant_message")).alias("last_assistant_message"),
        only(["Notification"], _text("message")).alias("message"),
        only(["Notification"], _text("title")).alias("title"),
        only(["Notification"], _text("notification_type")).alias("notification_type"),
        only(["Notification"],
             is_usage_limit(F.col("message")) | is_usage_limit(F.col("title")))
        .alias("is_usage_limit"),
        only(["PreCompact"], _text("trigger")).alias("trigger"),
        only(["PreCompact"], _text("custom_instructions")).alias("custom_instructions"),
        "stop_reason",
        F.when(kind.isin(*tool), tool_flags(tool_name, tool_input))
        .when(kind.isin(*agent), agent_flags).alias("categories"),
    )


def to_jsonl(payloads: DataFrame) -> DataFrame:
    """One JSON text per payload; absent fields are left out, documents are nested."""

    def nested(name: str) -> Column:
        document = F.coalesce(F.try_parse_json(F.col(name)), F.col(name).cast("variant"))
        return document.alias(name)

    columns = [nested(c) if c in _DOCUMENTS else F.col(c)
               for c in payloads.columns if c != "event_id"]
    return payloads.select(F.to_json(F.struct(*columns)).alias("value"))


def redact(payloads: DataFrame) -> DataFrame:
    """Drop free text and paths; the recorded lengths stay."""
    return payloads.drop(*PRIVATE_COLUMNS)


# --- validation -------------------------------------------------------------


def missing_field(required: Sequence[str] = ("event_type", "timestamp", "user_id", "team_id")) -> Column:
    """Name of the first required field that is missing; NULL when complete."""
    return F.coalesce(*[F.when(F.col(name).isNull(), F.lit(f"missing_{name}")) for name in required])


def validate_events(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete payloads with optional defaults, and rejected ones with a reason."""
    checked = payloads.withColumn("reject_reason", missing_field())
    ok = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    defaults = {name: _text(name) for name in ("project", "session_id") if name in payloads.columns}
    return ok.withColumns(defaults), checked.filter(F.col("reject_reason").isNotNull())


# Fields of an event document: kind, and whether it must be there.
EVENT_FIELDS = {
    "event_type": ("text", True), "timestamp": ("text", True),
    "user_id": ("text", True), "team_id": ("text", True),
    "project": ("text", False), "session_id": ("text", False), "tool_name": ("text", False),
    "categories": ("flags", False), "success": ("flag", False),
    "output_length": ("number", False), "prompt_length": ("number", False),
    "error": ("text", False), "metadata": ("object", False),
}
_YES = ("1", "true", "t", "yes", "y", "on")
_NO = ("0", "false", "f", "no", "n", "off")
_BLANK_DEFAULT = ("project", "session_id")
_NUMBER = "^(BIGINT|DECIMAL|DOUBLE)"


def _flag_of(kind: Column, text: Column) -> Column:
    """Truth value of a flag, of 0 or 1, or of one of twelve words; NULL for anything else."""
    word = F.lower(text)
    number = text.try_cast("double")
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when((kind == "STRING") & word.isin(*_YES), True).when((kind == "STRING") & word.isin(*_NO), False)
        .when(kind.rlike(_NUMBER) & number.isin(0.0, 1.0), number == 1.0)
    )


def _whole_of(kind: Column, text: Column) -> Column:
    """Whole number of a number without fraction, of a text of one, or of a flag."""
    plain = F.when(kind != "STRING", text).when(text.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"), F.trim(text))
    exact = plain.try_cast("decimal(38,10)")
    return F.when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast("bigint")).when(
        (kind == "STRING") | kind.rlike(_NUMBER), F.when(exact == F.floor(exact), exact.try_cast("bigint")))


def _entries(document: Column) -> Column:
    return F.try_variant_get(document, "$", "map<string, variant>")


def _kinds(entries: Column) -> Column:
    """Schema names of a map's values; VOID for a JSON null."""
    return F.transform_values(entries, lambda _, v: F.coalesce(F.schema_of_variant(v), F.lit("VOID")))


def _texts(entries: Column) -> Column:
    """Plain values of a map as text; objects and arrays as JSON."""

    def text(value: Column) -> Column:
        nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
        return F.when(nested, F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))

    return F.transform_values(entries, lambda _, v: text(v))


def validate_documents(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed events of JSON documents, and rejected lines with all their reasons.

    A line must hold one JSON object.  Required fields must be there and not
    null; a field of the wrong kind gives the reason ``<field>_not_<kind>``, one
    that is missing ``missing_<field>``.  Optional fields may be null; a missing
    project or session is blank.  A document is opened once, into the kinds and
    the texts of its fields, from which everything else is read.
    """
    rest = [c for c in lines.columns if c != value]
    doc = F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]")))
    opened = lines.select(*lines.columns, doc.alias("doc"))
    one = F.try_variant_get("doc", "$[1]", "variant").isNull()
    whole = F.when(one, F.try_variant_get("doc", "$[0]", "variant"))
    mapped = opened.select(*lines.columns, _entries(whole).alias("entries"))
    flags = F.try_variant_get(F.col("entries")["categories"], "$", "map<string, variant>")
    told = mapped.select(
        *lines.columns, F.col("entries").isNull().alias("unread"), _kinds(F.col("entries")).alias("kinds"),
        _texts(F.col("entries")).alias("texts"), _kinds(flags).alias("flag_kinds"), _texts(flags).alias("flag_texts"))

    def read(name: str, kind: str) -> Column:
        has, text = F.col("kinds")[name], F.col("texts")[name]
        if kind == "text":
            return F.when(has == "STRING", text)
        if kind == "flag":
            return _flag_of(has, text)
        if kind == "number":
            return _whole_of(has, text)
        if kind == "object":
            return F.when(has.startswith("OBJECT"), text)
        truths = F.map_zip_with("flag_kinds", "flag_texts", lambda _, k, t: _flag_of(k, t))
        return F.when(has.startswith("OBJECT") & F.forall(F.map_values(truths), lambda v: v.isNotNull()), truths)

    # A generator ends here what a filter on the reasons could pull down and repeat.
    fields = F.struct("unread", "kinds", *[
        read(n, kind).alias(f"is_{n}") for n, (kind, _) in EVENT_FIELDS.items()])
    typed = told.select(*lines.columns, F.inline(F.array(fields)))

    def reason(name: str, kind: str, required: bool) -> Column:
        none = F.coalesce(F.col("kinds")[name], F.lit("VOID")) == "VOID"
        wrong = F.when(~none & F.col(f"is_{name}").isNull(), F.lit(f"{name}_not_{kind}"))
        return F.when(none, F.lit(f"missing_{name}")).otherwise(wrong) if required else wrong

    reasons = F.when(F.col("unread"), F.array(F.lit("not_an_object"))).otherwise(
        F.array_compact(F.array(*[reason(n, *spec) for n, spec in EVENT_FIELDS.items()])))
    judged = typed.select(*lines.columns, F.inline(F.array(F.struct(
        reasons.alias("reject_reasons"), *[f"is_{n}" for n in EVENT_FIELDS]))))
    ok = judged.filter(F.size("reject_reasons") == 0).select(*rest, *[
        (F.coalesce(f"is_{n}", F.lit("")) if n in _BLANK_DEFAULT else F.col(f"is_{n}")).alias(n)
        for n in EVENT_FIELDS])
    return ok, judged.filter(F.size("reject_reasons") > 0).select(*lines.columns, "reject_reasons")
