"""Raw JSON lines to typed, defaulted, validated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.clock import event_time
from eventloom.functions.counters import sums
from eventloom.schema import DEFAULT_TEAM, EVENTS_SCHEMA, FLAGS, MART_COUNTERS

# A mapping of more users than this is joined instead of written into the plan.
_MOST_LITERALS = 500

# All columns of an event but the load that brought it, which only the load knows.
CLEAN_COLUMNS = tuple(name for name in EVENTS_SCHEMA.fieldNames() if name != "load_id")

# Every field is read as text and cast afterwards, so one value of the wrong
# kind becomes NULL and leaves the rest of its event alone.
_HEAD = "event_type STRING, timestamp STRING, user_id STRING, team_id STRING"
_EVENT = (
    f"{_HEAD}, session_id STRING, project STRING, tool_name STRING,"
    " success STRING, output_length STRING, error STRING, prompt_length STRING,"
    " is_usage_limit STRING, stop_reason STRING, categories STRUCT<skill: STRING,"
    " subagent: STRING, mcp: STRING, command: STRING, file_operation: STRING>"
)


def document_of(value: Column) -> Column:
    """The line as a one-element JSON list; NULL when it is not JSON.

    Inside brackets a second document or stray text after the first is an
    error or a second element, which a plain parse would pass over.
    """
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))


def with_canonical(lines: DataFrame) -> DataFrame:
    """Lines plus ``canonical``: the document with sorted keys and no spacing.

    NULL unless ``value`` is exactly one document.  The list and its text are
    columns of their own so that neither is computed twice.
    """
    listed = lines.withColumn("doc", document_of(F.col("value"))).select(
        *lines.columns,
        F.to_json("doc").alias("listed"),
        F.try_variant_get("doc", "$[1]", "variant").isNull().alias("single"),
    )
    text = F.col("listed")
    one = F.col("single") & (F.length(text) > 2)
    return listed.select(
        *lines.columns,
        F.when(one, F.substring(text, F.lit(2), F.length(text) - 2)).alias("canonical"),
    )


def event_hash(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def key_lines(lines: DataFrame) -> DataFrame:
    """Raw lines plus content hash, event date, place in a day's files and reject reason.

    Input has a ``value`` column.  ``raw`` is the canonical JSON of a readable
    line, which makes it a function of the hash, and the original text of an
    unreadable one.  Time and team are kept with it, so that events can be put
    in order before they are typed.  Parsed forms are columns of their own, so
    each is computed once per line.
    """
    rest = [c for c in lines.columns if c != "value"]
    parsed = (
        with_canonical(lines)
        .withColumn("head", F.from_json("canonical", _HEAD))
        .select("value", *rest, "canonical", "head.event_type", "head.user_id", "head.team_id",
                event_time(F.col("head.timestamp")).alias("stamp"))
    )
    reason = (
        F.when(F.trim("value") == "", "blank_line")
        .when(F.col("canonical").isNull(), "malformed_json")
        .when(F.col("event_type").isNull(), "missing_event_type")
        .when(F.col("stamp").isNull(), "bad_timestamp")
        .when(F.col("user_id").isNull(), "missing_user")
    )
    good = F.col("event_type").isNotNull() & F.col("user_id").isNotNull()
    return parsed.select(
        F.coalesce("canonical", "value").alias("raw"),
        event_hash(F.col("canonical")).alias("event_hash"),
        F.when(good, F.to_date("stamp")).alias("event_date"),
        F.when(good, F.col("stamp")).alias("event_timestamp"),
        F.when(good, F.coalesce("team_id", F.lit(DEFAULT_TEAM))).alias("team_id"),
        reason.alias("reject_reason"),
        *rest,
    )


def split_bad(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good lines and quarantined lines of a keyed raw frame."""
    return (
        keyed.filter(F.col("reject_reason").isNull()),
        keyed.filter(F.col("reject_reason").isNotNull()),
    )


def has_type(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isNotNull())


def with_defaults(events: DataFrame) -> DataFrame:
    """Default team and false flags where a value is missing."""
    return events.withColumns(
        {
            "team_id": F.coalesce("team_id", F.lit(DEFAULT_TEAM)),
            **{flag: F.coalesce(flag, F.lit(False)) for flag in FLAGS},
        }
    )


def typed_events(raw: DataFrame) -> DataFrame:
    """Typed and defaulted columns of keyed lines (``raw``, ``event_hash``).

    A day, time and team that the lines carry are taken over, so the order of
    the rows by them is still known.
    """
    carried = {name: F.col(name) for name in ("event_timestamp", "team_id", "event_date") if name in raw.columns}

    def cast(path: str, kind: str, name: str) -> Column:
        return F.col(f"doc.{path}").try_cast(kind).alias(name)

    typed = raw.withColumn("doc", F.from_json("raw", _EVENT)).select(
        "event_hash",
        "doc.event_type",
        carried.get("event_timestamp", event_time(F.col("doc.timestamp"))).alias("event_timestamp"),
        F.current_timestamp().alias("received_at"),
        "doc.user_id",
        carried.get("team_id", F.col("doc.team_id")).alias("team_id"),
        "doc.session_id",
        F.col("doc.project").alias("project_name"),
        "doc.tool_name",
        cast("success", "boolean", "tool_success"),
        cast("output_length", "bigint", "output_length"),
        F.col("doc.error").alias("error_message"),
        cast("prompt_length", "bigint", "prompt_length"),
        cast("categories.skill", "boolean", "is_skill"),
        cast("categories.subagent", "boolean", "is_subagent"),
        cast("categories.mcp", "boolean", "is_mcp"),
        cast("categories.command", "boolean", "is_command"),
        cast("categories.file_operation", "boolean", "is_file_operation"),
        cast("is_usage_limit", "boolean", "is_usage_limit"),
        "doc.stop_reason",
        F.col("raw").alias("raw_data"),
        carried.get("event_date", F.lit(None).cast("date")).alias("event_date"),
    )
    typed = with_defaults(typed)
    if "event_date" not in carried:
        typed = typed.withColumn("event_date", F.to_date("event_timestamp"))
    return typed.select(*CLEAN_COLUMNS)


def clean(raw: DataFrame) -> DataFrame:
    """Typed events of keyed lines, without those lacking type, time or user.

    Lines that passed :func:`split_bad` need only :func:`typed_events`.
    """
    return has_type(typed_events(raw)).filter(
        F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull()
    )


def remap_users(events: DataFrame, mapping: dict[str, str] | DataFrame) -> DataFrame:
    """Replace user ids.

    A small dict becomes one literal map, a large one a frame.  A frame
    (old_id, new_id) is joined with no broadcast hint, so its measured size and
    AQE decide the join.  An id with two targets raises when the rows are read.
    """
    columns = events.columns
    if isinstance(mapping, dict):
        if not mapping:
            return events
        if len(mapping) > _MOST_LITERALS:
            frame = events.sparkSession.createDataFrame(
                list(mapping.items()), "old_id string, new_id string")
            return remap_users(events, frame)
        pairs = [F.lit(item) for pair in mapping.items() for item in pair]
        new_id = F.coalesce(F.create_map(*pairs)[F.col("user_id")], F.col("user_id"))
        return events.withColumn("user_id", new_id).select(*columns)
    target = F.when(
        F.min("new_id") != F.max("new_id"),
        F.raise_error(F.concat(F.lit("two targets for user "), F.first("old_id")))
    ).otherwise(F.min("new_id"))
    renames = mapping.groupBy(F.col("old_id").alias("user_id")).agg(target.alias("new_id"))
    joined = events.join(renames, "user_id", "left")
    return joined.withColumn("user_id", F.coalesce("new_id", "user_id")).select(*columns)


def remap_user_summary(user_sum: DataFrame, mapping: dict[str, str] | DataFrame) -> DataFrame:
    """Remap a user mart and add up the rows that now share a key."""
    return (
        remap_users(user_sum, mapping)
        .groupBy("summary_date", "user_id", "team_id")
        .agg(*sums(MART_COUNTERS), F.max("last_active_at").alias("last_active_at"))
    )
