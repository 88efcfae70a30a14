"""Parquet tables of the warehouse layers: reads, appends, partition overwrites."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.sources.workdir import fresh_folder


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for what is run inside; the old ones return afterwards."""
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Parsing a line costs far more than reading it, so tasks take at most so many bytes of lines.
_LINE_BYTES = 32 << 20
_BLOCK = "spark.sql.files.maxPartitionBytes"
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def size_of(text: str) -> int:
    """A size setting such as 64m or 128MB in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgt]?)b?", text.lower()).groups()
    return int(number) * _UNITS[unit]


def block_bytes(spark: SparkSession) -> int:
    """The most bytes that a task reads of files."""
    return size_of(spark.conf.get(_BLOCK))


def line_blocks(spark: SparkSession):
    """Settings under which a task reads at most ``_LINE_BYTES`` of lines."""
    return settings(spark, {_BLOCK: str(min(block_bytes(spark), _LINE_BYTES))})


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               base_path: str | None = None, required: bool = False) -> DataFrame:
    """A parquet table; empty while nothing has been written yet, unless ``required``."""
    try:
        return spark.read.schema(schema).option("basePath", base_path or path).parquet(path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def clustered(df: DataFrame, partition: str, *order: str) -> DataFrame:
    """Rows gathered by partition value and sorted inside each task.

    The rebalance hint lets AQE split a large partition value over several
    tasks and merge small ones, so no single task has to write a whole day.
    """
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *order)


def append_raw(keyed: DataFrame, path: str, load_id: str) -> None:
    """Store a load of keyed lines in its own folder; repeating it replaces it.

    Writing the folder itself needs no sort by a partition column.
    """
    stamped = keyed.withColumn("received_at", F.current_timestamp())
    with line_blocks(keyed.sparkSession):
        stamped.write.mode("overwrite").parquet(f"{path}/load_id={load_id}")


# Bytes of an event in a shuffle, about, with its raw line.
_EVENT_BYTES = 400
_LEAST_BYTES = 4 << 20


def _target_bytes(spark: SparkSession) -> int:
    """The size that the session advises for a task."""
    return size_of(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))


def ranged(events: DataFrame, rows: int | None = None) -> DataFrame:
    """Events in files that each hold one stretch of (day, team, time).

    Range partitioning cuts a team that fills much of a day by time, and events
    of one moment by hash, so no task writes them alone; the statistics of a file
    rule it out for other teams.  The number of rows (counted if not given)
    sets the number of tasks, so that each gets about the advised size, or less
    while cores would idle and a task still has ``_LEAST_BYTES``.
    """
    spark = events.sparkSession
    order = [c for c in ("event_date", "team_id", "event_timestamp", "event_hash") if c in events.columns]
    size = (events.count() if rows is None else rows) * _EVENT_BYTES
    busy = min(spark.sparkContext.defaultParallelism, size // _LEAST_BYTES)
    tasks = max(1, busy, -(-size // _target_bytes(spark)))
    return events.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


# Row groups without a wanted hash are skipped by these filters.
_HASH_FILTER = {
    "parquet.bloom.filter.enabled#event_hash": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def write_events(events: DataFrame, path: str, rows: int | None = None,
                 finish: Callable[[DataFrame], DataFrame] = lambda placed: placed) -> None:
    """Append clean events, at most ``rows`` if given, by day and clustered by team and time.

    ``finish`` completes the rows once they are in place: cutting ranges
    evaluates what comes before it twice, what comes after it once.
    """
    (
        finish(ranged(events, rows)).write.mode("append").options(**_HASH_FILTER)
        .partitionBy("event_date")
        .parquet(path)
    )


def rewrite_events(events: DataFrame, path: str) -> None:
    """Replace the dates that occur in ``events``, few large files to a day.

    The rows are written beside the table first, since they are usually read
    from the dates they replace.
    """
    spark = events.sparkSession
    aside = fresh_folder(spark, "rewrite")
    clustered(events, "event_date", "team_id").write.partitionBy("event_date").parquet(aside)
    (
        ranged(read_table(spark, aside, events.schema, required=True))
        .write.mode("overwrite").options(**_HASH_FILTER)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def write_days(rows: DataFrame, path: str, day: str, *order: str) -> None:
    """Replace the dates that occur in ``rows``; other dates stay.

    Rows may be read from the dates they replace: old files go when all new
    ones are written.
    """
    (
        clustered(rows, day, *order).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def write_mart(mart: DataFrame, path: str) -> None:
    """Replace the dates that occur in ``mart``; other dates stay."""
    stamped = mart.withColumn("updated_at", F.current_timestamp())
    write_days(stamped, path, "summary_date", "team_id")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends here."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dates_of(rows: DataFrame, column: str) -> DataFrame:
    """The distinct dates of a column, without null."""
    return rows.select(F.col(column)).filter(F.col(column).isNotNull()).distinct()


def on_dates(rows: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    """Rows on any of ``dates``.

    A semi join on the partition column: Spark prunes the partitions by the
    dates when it runs, however many they are, and none reach the driver here.
    """
    return rows.join(dates, column, "left_semi").select(*rows.columns)
