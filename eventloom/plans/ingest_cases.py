"""End-to-end loads of the bundled events through fresh warehouses."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.operators import dashboard, normalize, service_stats, sessions, views
from eventloom.operators.service_stats import layer_row_counts
from eventloom.plans.pipeline import Warehouse, apply_remap, compact_events, heal, ingest_batch
from eventloom.sources import exports, testdata
from eventloom.sources.raw_logs import (
    file_inventory,
    inventory_totals,
    list_files,
    log_date_of,
    merge_ledger,
    new_files,
    read_raw,
    read_raw_in_order,
)
from eventloom.sources.tables import block_bytes, clustered, dates_of, settings
from eventloom.sources.testdata import AS_OF, DAYS, TEAM
from eventloom.sources.transcripts import read_transcripts
from eventloom.sources.workdir import fresh_folder
from eventloom.streaming.ingest import ingest_stream

# Columns of a loaded event that do not depend on the clock or the hash.
_RESULT = [name for name in testdata.EVENT_COLUMNS if name != "event_id"]

# How the quarantine case spoils a line, by event id.
DEFECTS = {
    "blank_line": "event_id % 29 = 0",
    "malformed_json": "event_id % 23 = 0",
    "missing_event_type": "event_id % 19 = 0",
    "bad_timestamp": "event_id % 17 = 0",
    "missing_user": "event_id % 13 = 0",
}


# Users renamed in a warehouse.
RENAMES = {"user1@example.com": "user2@example.com", "user3@example.com": "renamed"}

# JSON text of a value with quotes, a comma, a line break and blanks at its start.
HARD_TEXT = '  a \\\\"q\\\\", b\\\\n'


class LoadCase:
    """A source folder, a warehouse and a checkpoint below one new folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = fresh_folder(spark, name)
        self.source = f"{root}/logs"
        self.checkpoint = f"{root}/checkpoint"
        self.warehouse = Warehouse(f"{root}/warehouse")

    def deliver(self, lines: DataFrame, copies: int = 1) -> None:
        """Add files with these lines, one folder per day, to the source.

        Each line comes ``copies`` times in its file: it is repeated once it is in place.
        """
        placed = clustered(lines.select("value", "event_date"), "event_date")
        if copies > 1:
            placed = placed.select(F.explode(F.array_repeat("value", copies)).alias("value"), "event_date")
        placed.write.mode("append").partitionBy("event_date").text(self.source)

    def deliver_by_day(self, lines: DataFrame) -> None:
        """Add one file per day, its lines in the order of their event ids."""
        (
            lines.select("value", "event_id", "event_date").repartition("event_date")
            .sortWithinPartitions("event_date", "event_id").drop("event_id")
            .write.mode("append").partitionBy("event_date").text(self.source)
        )

    def run(self) -> None:
        ingest_stream(self.spark, self.source, self.warehouse, self.checkpoint)

    def events(self) -> DataFrame:
        seq = F.get_json_object("raw_data", "$.seq").cast("bigint").alias("event_id")
        return self.warehouse.events(self.spark).select(seq, *_RESULT)

    def mart(self, name: str) -> DataFrame:
        return self.warehouse.mart(self.spark, name).drop("updated_at")


def event_lines(spark: SparkSession, sf: str, where: str = "true", reverse_keys: bool = False) -> DataFrame:
    events = testdata.usage_events(spark, sf).filter(where)
    return testdata.jsonl_lines(events, reverse_keys)


def ingest_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Every event through files, stream and cleaning, back to its row."""
    case = LoadCase(spark, "clean")
    case.deliver(event_lines(spark, sf))
    case.run()
    return case.events()


def _spoil(value: Column) -> Column:
    def without(key: str) -> Column:
        return F.regexp_replace(value, f'"{key}":"[^"]*",', "")

    broken = {
        "blank_line": F.lit(""),
        "malformed_json": F.expr("substring(value, 1, length(value) - 9)"),
        "missing_event_type": F.regexp_replace(value, '"event_type":"[^"]*"', '"event_type":null'),
        "bad_timestamp": F.regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"soon"'),
        "missing_user": without("user_id"),
    }
    spoiled = F
    for reason, condition in DEFECTS.items():
        spoiled = spoiled.when(F.expr(condition), broken[reason])
    return spoiled.otherwise(value)


def ingest_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per reject reason after loading spoiled files; good ones count too."""
    case = LoadCase(spark, "quarantine")
    case.deliver(event_lines(spark, sf).withColumn("value", _spoil(F.col("value"))))
    case.run()
    bad = case.warehouse.quarantine(spark).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("line_count")
    )
    good = case.warehouse.events(spark).agg(
        F.lit("accepted").alias("reject_reason"), F.count(F.lit(1)).alias("line_count")
    )
    return bad.unionByName(good)


def ingest_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Copies in one file, in another file, with other key order, in a later load."""
    case = LoadCase(spark, "dedup")
    case.deliver(event_lines(spark, sf), copies=2)
    case.deliver(event_lines(spark, sf))
    case.deliver(event_lines(spark, sf, reverse_keys=True))
    case.run()
    case.deliver(event_lines(spark, sf))
    case.run()
    return case.events()


def ingest_forced_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Layer sizes after a load and a forced reload of the same files."""
    case = LoadCase(spark, "reload")
    case.deliver(event_lines(spark, sf))
    case.run()
    ingest_batch(spark, case.source, case.warehouse)
    return layer_row_counts(case.warehouse.layers(spark))


def ingest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Daily mart after a morning and an evening load of every date."""
    case = LoadCase(spark, "upsert")
    case.deliver(event_lines(spark, sf, "hour(event_timestamp) < 12"))
    case.run()
    case.deliver(event_lines(spark, sf, "hour(event_timestamp) >= 12"))
    case.run()
    return case.mart("daily_summary")


def ingest_late_data(spark: SparkSession, sf: str) -> DataFrame:
    """User mart after newer dates first and older ones, in part known, later."""
    case = LoadCase(spark, "late")
    case.deliver(event_lines(spark, sf, "event_date >= date'2024-01-10'"))
    case.run()
    case.deliver(event_lines(spark, sf, "event_date < date'2024-01-12'"))
    case.run()
    return case.mart("user_summary")


def user_remap_stored(spark: SparkSession, sf: str) -> DataFrame:
    """User mart of a warehouse whose users were renamed between two loads."""
    case = LoadCase(spark, "remap")
    case.deliver(event_lines(spark, sf, "event_id % 3 > 0"))
    case.run()
    mapping = spark.createDataFrame(list(RENAMES.items()), "old_id string, new_id string")
    apply_remap(spark, case.warehouse, mapping)
    case.deliver(event_lines(spark, sf, "event_id % 3 = 0"))
    case.run()
    return case.mart("user_summary")


def ingest_tool_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Tool mart after two loads that share dates, and a compaction between."""
    case = LoadCase(spark, "tools")
    case.deliver(event_lines(spark, sf, "event_id % 2 = 0"))
    case.run()
    compact_events(spark, case.warehouse, dates_of(case.warehouse.events(spark), "event_date"))
    case.deliver(event_lines(spark, sf, "event_id % 2 = 1"))
    case.run()
    return case.mart("tool_summary")


def export_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events exported as CSV and read back, with values that CSV must quote."""
    path = fresh_folder(spark, "csv")
    hard = F.regexp_replace("value", '"session_id":"', f'"session_id":"{HARD_TEXT}')
    exports.export_csv(event_lines(spark, sf).select(hard.alias("value")), path)
    columns = ("timestamp", "event_type", "user_id", "team_id", "project", "session_id", "tool_name",
               "success", "is_mcp", "is_subagent", "is_command")
    read = spark.read.schema(", ".join(f"{c} STRING" for c in columns)).option("header", True).option(
        "escape", '"').option("multiLine", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("nullValue", "\u0000").csv(path)
    return read.select("user_id", "session_id", "tool_name", "timestamp").fillna("")


def file_inventory_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """File inventory before and after a second delivery, summed per log date."""
    case = LoadCase(spark, "inventory")
    case.deliver(event_lines(spark, sf, "event_date <= date'2024-01-20'"))
    case.run()
    case.deliver(event_lines(spark, sf, "event_date > date'2024-01-20'"))
    inventory = file_inventory(
        list_files(spark, case.source),
        read_raw(spark, case.source),
        case.warehouse.ledger(spark),
    )
    return inventory.groupBy(log_date_of(F.col("source_file")).alias("log_date")).agg(
        F.sum("event_count").alias("event_count"),
        F.min("loaded").alias("loaded"),
        (F.min("size_bytes") > 0).alias("has_size"),
    )


def jsonl_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per day folder after two appends."""
    path = fresh_folder(spark, "jsonl")
    events = testdata.usage_events(spark, sf)
    for part in ("tool_name IS NULL", "tool_name IS NOT NULL"):
        exports.write_jsonl_by_day(events.filter(part), path)
    written = spark.read.schema("event_id BIGINT, event_type STRING, event_date DATE").json(path)
    return written.groupBy("event_date", "event_type").agg(F.count("event_id").alias("n"))


def export_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Readable lines exported from files that hold broken ones too."""
    path = fresh_folder(spark, "export")
    cut = F.when(F.col("value").contains('"event_type":"Stop"'), F.expr("left(value, 40)"))
    exports.export_json(
        event_lines(spark, sf).withColumn("value", F.coalesce(cut, F.col("value"))), path
    )
    return spark.read.schema(
        "seq BIGINT, event_type STRING, user_id STRING, tool_name STRING, success BOOLEAN"
    ).json(path).withColumnRenamed("seq", "event_id")


# Blocks of so many bytes at least, so that the bundled files have several, and
# larger ones where a folder would have more blocks than this: every task of a
# scan sends its result to the driver.
LEAST_BLOCK = 16 << 10
BLOCKS = 400


def several_blocks(spark: SparkSession, folder: str) -> dict[str, str]:
    """Settings that cut the files of a folder into several blocks, up to the size that a scan takes anyway."""
    whole = list_files(spark, folder).agg(F.sum("size_bytes")).first()[0] or 0
    block = min(block_bytes(spark), max(LEAST_BLOCK, -(-whole // BLOCKS)))
    return {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "1k"}


def numbered_lines(back: DataFrame) -> DataFrame:
    """Lines with their place (``read_raw_in_order``) and ``line_number``, from 1 over all files.

    Blocks are numbered on their own; only their line counts are summed up over
    all files, so no task sees more lines than a block has.
    """
    block = ["source_file", "block_start"]
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = back.groupBy(*block).agg(F.count(F.lit(1)).alias("lines")).select(
        *block, F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("line_place"))
    return back.withColumn("inside", inside).join(blocks, block).withColumn(
        "line_number", (F.col("before") + F.col("inside")).cast("int")).drop("before", "inside")


def export_json_order(spark: SparkSession, sf: str) -> DataFrame:
    """Line number of every event in an export of files that are read in many blocks."""
    case, path = LoadCase(spark, "ordered"), fresh_folder(spark, "export")
    case.deliver_by_day(event_lines(spark, sf))
    with settings(spark, several_blocks(spark, case.source)):
        exports.export_json(read_raw_in_order(spark, case.source), path)
    with settings(spark, several_blocks(spark, path)):
        seq = F.get_json_object("value", "$.seq").cast("bigint").alias("event_id")
        back = read_raw_in_order(spark, path).select(seq, "source_file", "block_start", "line_place")
        folder = fresh_folder(spark, "numbers")
        numbered_lines(back).select("event_id", "line_number").write.parquet(folder)
    return spark.read.schema("event_id BIGINT, line_number INT").parquet(folder)


def stop_reason_files(spark: SparkSession, sf: str) -> DataFrame:
    """Stop reason of transcript files of many lines, each read in several blocks."""
    folder = fresh_folder(spark, "transcripts")
    (
        testdata.transcript_file_lines(spark, sf).repartition("file")
        .sortWithinPartitions("file", "doc_id", "pos").select("file", "value")
        .write.partitionBy("file").text(folder)
    )
    with settings(spark, several_blocks(spark, folder)):
        # The first look covers less than thirty lines of most files.
        tails = read_transcripts(spark, folder, tail_bytes=512)
    number = F.regexp_extract("path", "file=(\\d+)", 1).cast("bigint").alias("file")
    return normalize.stop_reason(tails).select(number, "stop_reason")


def _two_deliveries(spark: SparkSession, sf: str) -> LoadCase:
    """A loaded delivery with a zero-byte file, and one that is not loaded yet."""
    case = LoadCase(spark, "listing")
    events = testdata.usage_events(spark, sf)
    case.deliver_by_day(testdata.plain_lines(events.filter("event_date <= date'2024-01-20'")))
    events.select(F.lit("").alias("value")).limit(0).write.text(f"{case.source}/event_date=2024-03-01")
    ingest_batch(spark, case.source, case.warehouse)
    case.deliver_by_day(testdata.plain_lines(events.filter("event_date > date'2024-01-20'")))
    return case


def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Size, lines and state of every file, and a row of totals without a date."""
    case = _two_deliveries(spark, sf)
    inventory = file_inventory(
        list_files(spark, case.source), read_raw(spark, case.source), case.warehouse.ledger(spark))
    files = inventory.select(
        log_date_of(F.col("source_file")).alias("log_date"), F.lit(1).cast("bigint").alias("files"),
        "size_kb", "event_count", "loaded")
    return files.unionByName(inventory_totals(inventory), allowMissingColumns=True)


def file_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger after the new files of a second delivery are added, by log date."""
    case = _two_deliveries(spark, sf)
    before, listing = case.warehouse.ledger(spark), list_files(spark, case.source)
    fresh = new_files(listing, before).withColumn("is_new", F.lit(True))
    merged = merge_ledger(before, fresh).join(fresh.select("source_file", "is_new"), "source_file", "left")
    return merged.select(
        log_date_of(F.col("source_file")).alias("log_date"),
        F.coalesce("is_new", F.lit(False)).alias("is_new"))


class _BrokenMarts(Warehouse):
    """A warehouse whose user mart cannot be written."""

    def mart_path(self, name: str) -> str:
        return "no-such-store://x/y" if name == "user_summary" else super().mart_path(name)


def ingest_stage_retry(spark: SparkSession, sf: str) -> DataFrame:
    """User mart after a load whose marts failed, was recorded, and was run again with more events."""
    case = LoadCase(spark, "retry")
    case.deliver(event_lines(spark, sf, "event_id % 4 > 0"))
    ingest_batch(spark, case.source, _BrokenMarts(case.warehouse.root), strict=False)
    failed = case.warehouse.journal(spark).latest().filter("stage = 'marts' AND result = 'failed'")
    if failed.isEmpty():
        raise RuntimeError("the failed stage was not recorded")
    case.deliver(event_lines(spark, sf, "event_id % 4 = 0 AND event_date < date'2024-01-15'"))
    # Reloads every file: dates of the failed load are found stale and rebuilt.
    ingest_batch(spark, case.source, case.warehouse)
    case.deliver(event_lines(spark, sf, "event_id % 4 = 0 AND event_date >= date'2024-01-15'"))
    case.run()
    return case.mart("user_summary")


def ingest_heal(spark: SparkSession, sf: str) -> DataFrame:
    """Daily mart after a load whose marts failed, and a repair without a new load."""
    case = LoadCase(spark, "heal")
    case.deliver(event_lines(spark, sf, "event_date < date'2024-01-10'"))
    case.run()
    case.deliver(event_lines(spark, sf, "event_date >= date'2024-01-08'"))
    ingest_batch(spark, case.source, _BrokenMarts(case.warehouse.root), strict=False)
    heal(spark, case.warehouse)
    return case.mart("daily_summary")


@cache
def _loaded_root(application: str, sf: str) -> str:
    """Root of a warehouse after two loads that share every date and cut sessions.

    Even hours come first, odd ones later.  The reports on stored tables share
    it within one application.
    """
    spark = SparkSession.getActiveSession()
    case = LoadCase(spark, "stored")
    for rest in (0, 1):
        case.deliver(event_lines(spark, sf, f"hour(event_timestamp) % 2 = {rest}"))
        case.run()
    return case.warehouse.root


def loaded_twice(spark: SparkSession, sf: str) -> Warehouse:
    return Warehouse(_loaded_root(spark.sparkContext.applicationId, sf))


def stored_kpi_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Overview of a loaded warehouse, users counted from bitmaps."""
    house = loaded_twice(spark, sf)
    return dashboard.kpi_overview(
        house.mart(spark, "daily_summary"), None, TEAM, DAYS, AS_OF, house.user_days(spark))


def stored_roi_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Return on investment of a loaded warehouse, all users counted from bitmaps."""
    house = loaded_twice(spark, sf)
    marts = (house.mart(spark, m) for m in ("daily_summary", "user_summary", "tool_summary"))
    return dashboard.roi_kpi(*marts, TEAM, DAYS, AS_OF, house.user_days(spark))


def stored_api_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Service figures of a loaded warehouse, all users counted from bitmaps."""
    house = loaded_twice(spark, sf)
    return service_stats.api_stats(house.events(spark), house.user_days(spark), TEAM, DAYS, AS_OF)


def stored_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Every session of a warehouse, from session-days that two loads added to."""
    return sessions.session_stats(loaded_twice(spark, sf).session_days(spark))


# A moment that cuts a day.
CUT_AS_OF = "2024-01-31 13:30:00"


def stored_session_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a period that starts within a day."""
    house = loaded_twice(spark, sf)
    return sessions.session_kpi(house.session_days(spark), house.events(spark), TEAM, DAYS, CUT_AS_OF)


def warehouse_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the five layers, from file footers, and of the ten views of a loaded warehouse."""
    house = loaded_twice(spark, sf)
    return layer_row_counts({**house.layers(spark), **views.all_views(house.events(spark))})
