"""JSONL event logs: scans, provenance, file inventory."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.metrics import exact_round

# Log file layouts, newest first.
_DASHED_DATE = "(\\d{4}-\\d{2}-\\d{2})[^/]*(?:/[^/]*)?$"
_COMPACT_DATE = "(\\d{8})\\.jsonl[^/]*$"


def _lines(reader, path: str, glob: str | None) -> DataFrame:
    reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_raw(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All lines below a folder with their file name."""
    return _lines(spark.read.format("text"), path, glob)


def read_raw_in_order(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The lines with their place: file, start of the block in it, running number in the scan.

    A line belongs to the block it starts in and a task reads a block from its
    start to its end, so the three order the lines of a file however it is split.
    """
    reader = spark.read.format("text").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "value", F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_place"))


# Columns that put the lines of many files in order.
LINE_ORDER = ("source_file", "block_start", "line_place")


def read_raw_stream(spark: SparkSession, path: str, glob: str | None = None,
                    max_files: int | None = None) -> DataFrame:
    """The same lines as a stream of newly arrived files."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader, path, glob)


# --- provenance -------------------------------------------------------------


def uploader_of(path: Column) -> Column:
    """Uploader: the folder above events-DATE.jsonl, or the file-name prefix."""
    prefix = F.regexp_extract(path, "/([^/]+)-events-\\d{8}\\.jsonl[^/]*$", 1)
    folder = F.regexp_extract(path, "/([^/]+)/events-\\d{4}-\\d{2}-\\d{2}\\.jsonl[^/]*$", 1)
    return F.nullif(F.when(prefix != "", prefix).otherwise(folder), F.lit(""))


def log_date_of(path: Column) -> Column:
    """Log date in the file name or, for a date-partitioned sink, its folder."""
    dashed = F.try_to_timestamp(F.regexp_extract(path, _DASHED_DATE, 1), F.lit("yyyy-MM-dd"))
    compact = F.try_to_timestamp(F.regexp_extract(path, _COMPACT_DATE, 1), F.lit("yyyyMMdd"))
    return F.coalesce(dashed, compact).cast("date")


def with_provenance(df: DataFrame, path_col: str = "source_file") -> DataFrame:
    return df.withColumns({
        "uploader": uploader_of(F.col(path_col)),
        "log_date": log_date_of(F.col(path_col)),
    })


# --- inventory --------------------------------------------------------------


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All files below a folder with their size; no content is read.

    Spark's file index lists the folders, in parallel once there are many, and
    knows every file; its scans pass over zero-byte files, which are added here.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path)
    sized = found.select(F.col("_metadata.file_path").alias("source_file"), "length")
    # The index writes local paths with three slashes, a scan with one.
    paths = [(re.sub("^file:/+", "file:/", name),) for name in found.inputFiles()]
    names = spark.createDataFrame(paths, "source_file string")
    return names.join(sized, "source_file", "left").select(
        "source_file", F.coalesce("length", F.lit(0).cast("bigint")).alias("size_bytes"))


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold."""
    return listing.join(ledger.select("source_file"), "source_file", "left_anti")


def merge_ledger(ledger: DataFrame, loaded: DataFrame) -> DataFrame:
    """Union of the ledger and newly loaded files."""
    return ledger.select("source_file").union(loaded.select("source_file")).distinct()


def file_inventory(listing: DataFrame, lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per file: size, lines, and whether it has been loaded."""
    events = lines.groupBy("source_file").agg(F.count(F.lit(1)).alias("event_count"))
    loaded = ledger.select("source_file").distinct().withColumn("loaded", F.lit(True))
    return (
        listing.join(events, "source_file", "left")
        .join(loaded, "source_file", "left")
        .select(
            "source_file",
            "size_bytes",
            exact_round(F.col("size_bytes") / 1024).alias("size_kb"),
            F.coalesce("event_count", F.lit(0)).alias("event_count"),
            F.coalesce("loaded", F.lit(False)).alias("loaded"),
        )
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """One row: files, size and lines in all."""
    return inventory.agg(
        F.count(F.lit(1)).alias("files"),
        exact_round(F.sum("size_bytes") / 1024).alias("size_kb"),
        F.sum("event_count").alias("event_count"),
    )
