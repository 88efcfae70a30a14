"""Export sinks: JSON lines and flat CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.sources.raw_logs import LINE_ORDER
from eventloom.sources.tables import clustered

_FLAT_TEXT = (
    "timestamp", "event_type", "user_id", "team_id", "project", "session_id", "tool_name", "success",
)
_FLAT = ", ".join(
    [*[f"{name}: STRING" for name in _FLAT_TEXT],
     "categories: STRUCT<mcp: STRING, subagent: STRING, command: STRING>"]
)


def write_jsonl_by_day(df: DataFrame, path: str, day: str = "event_date") -> None:
    """Append JSON lines to one folder per day."""
    clustered(df, day).write.mode("append").partitionBy(day).json(path)


def _listed(kind: str) -> Column:
    """The line read once as a list of documents; NULL when it is not JSON."""
    text = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    return F.from_json(text, f"ARRAY<{kind}>", {"allowSingleQuotes": "false"}).alias("docs")


def valid_lines(raw: DataFrame) -> DataFrame:
    """Lines (``value``) that hold exactly one JSON document.

    A generator drops the others; a filter would be pushed below the parse and
    repeat it.
    """
    one = F.when(F.size("docs") == 1, F.array("value"))
    return raw.select("value", _listed("STRING")).select(F.explode(one).alias("value"))


def export_json(raw: DataFrame, path: str) -> None:
    """Write every readable event as one JSON line.

    Lines that carry their place (``read_raw_in_order``) are written in the
    order of their files' names and of the lines in each file; with only a file
    name, in the order of the names.
    """
    order = [c for c in LINE_ORDER if c in raw.columns]
    if not order:
        valid_lines(raw).write.mode("overwrite").text(path)
        return
    # Range partitions are numbered in order, and so are the files written from them.
    valid_lines(raw.orderBy(*order)).write.mode("overwrite").text(path)


def export_flat(raw: DataFrame, *carry: str) -> DataFrame:
    """Eleven flat columns per readable event; blanks for missing values.

    Each line is read once as a one-element list, and a generator turns the
    list into a row or, for an unreadable line, into none.
    """
    docs = F.col("docs")
    readable = (F.size(docs) == 1) & F.get(docs, F.lit(0)).isNotNull()
    rows = raw.select(*carry, _listed(f"STRUCT<{_FLAT}>")).select(
        *carry, F.inline(F.when(readable, docs))
    )

    def flag(name: str):
        value = F.col(f"categories.{name}").try_cast("boolean")
        return F.coalesce(value, F.lit(False)).alias(f"is_{name}")

    return rows.select(
        *carry,
        *[F.coalesce(name, F.lit("")).alias(name) for name in _FLAT_TEXT],
        flag("mcp"), flag("subagent"), flag("command"),
    )


def export_csv(raw: DataFrame, path: str) -> None:
    """Write the flat columns as CSV that standard readers read back unchanged.

    Quotes are doubled and blanks at the edges of a value stay.
    """
    (
        export_flat(raw).write.mode("overwrite")
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, header=True, emptyValue="")
    )
