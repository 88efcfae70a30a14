"""Physical plans: what is pushed down, and what must not appear."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from eventloom.operators import dashboard as Q
from eventloom.operators import marts as A
from eventloom.operators import normalize as N
from eventloom.operators import service_stats as C
from eventloom.operators import views as V
from eventloom.operators.clean import key_lines, split_bad, typed_events
from eventloom.plans import pipeline as P
from eventloom.plans import registry as driver
from eventloom.plans.ingest_cases import LoadCase, event_lines
from eventloom.sources import tables
from eventloom.sources import testdata as td
from eventloom.sources.transcripts import tail_lines

SF = "/root/testdata/sf0.001"
AT = (td.TEAM, 7, td.AS_OF)
INGEST = {n for n in driver.queries() if n.startswith("ingest")} | {
    "file_inventory", "jsonl_by_day", "export_json", "file_listing", "file_ledger", "export_json_order",
    "stop_reason_files"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def house(spark):
    case = LoadCase(spark, "plans")
    case.deliver(event_lines(spark, SF))
    P.ingest_batch(spark, case.source, case.warehouse)
    return case.warehouse


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - INGEST))
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    banned = ["PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups",
              "CartesianProduct", "BroadcastNestedLoopJoin"]
    # One sorts only its small mapping, the others a team's bitmaps, whose type no hash table holds.
    if name not in ("user_remap_events", "stored_kpi_overview", "stored_roi_kpi", "stored_api_stats"):
        banned.append("SortAggregate")
    for node in banned:
        assert node not in text


def test_event_period_prunes_partitions_and_columns(spark, house):
    text = plan(Q.heatmap(house.events(spark), *AT))
    assert "PartitionFilters: [isnotnull(event_date" in text and ">= 2024-01-24" in text
    assert "ReadSchema: struct<event_timestamp:timestamp_ntz,team_id:string>" in text
    assert "EqualTo(team_id,default-team)" in text


def test_previous_period_prunes_marts(spark, house):
    marts = [house.mart(spark, n) for n in ("daily_summary", "user_summary", "tool_summary")]
    text = plan(Q.roi_kpi(*marts, *AT))
    assert text.count("FileScan") == 3  # one pass per mart
    assert text.count("PartitionFilters: [((summary_date") == 2


def test_marts_never_see_the_whole_history_on_a_load(spark, house):
    touched = tables.dates_of(house.events(spark).filter("event_date = date'2024-01-05'"), "event_date")
    text = plan(tables.on_dates(house.events(spark), touched, "event_date"))
    assert "dynamicpruning" in text or text.count("2024-01-05") >= 2


@pytest.mark.parametrize("build", [
    V.kpi_metrics, V.tool_ranking, V.overview_daily, V.tool_stats_daily, V.feature_adoption_daily,
    A.daily_summary, A.user_summary, A.tool_summary])
def test_views_and_marts_prune_by_their_date(spark, house, build):
    frame = build(house.events(spark))
    day = "event_date" if "event_date" in frame.columns else "summary_date"
    text = plan(frame.filter(f"{day} = date'2024-01-05'"))
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_service_figures_read_two_periods(spark, house):
    text = plan(C.api_stats(house.events(spark), house.mart(spark, "user_summary"), *AT))
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_each_line_is_parsed_once(spark, house):
    lines = spark.createDataFrame([("{}", "f")], "value string, source_file string")
    assert plan(key_lines(lines)).count("parseJson") == 1
    good, _ = split_bad(house.raw(spark))
    text = plan(typed_events(P.insert_new(house.events(spark), good)))
    assert text.count("from_json(") <= 1 and "parseJson" not in text
    assert "LeftAnti" in text


def test_text_is_shuffled_once_and_copies_combine_before(spark, house):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        good, _ = split_bad(house.raw(spark))
        text = plan(P.insert_new(house.events(spark), good))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Bottom up: partial aggregate, shuffle, aggregate, then the anti join on the same key.
    assert text.index("LeftAnti") < text.index("SortAggregate")
    assert text.count("SortAggregate") == 2 and "HashAggregate" not in text
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(event_date" in line]
    assert len(shuffles) == 2
    # Of the two sides only one carries the text.
    batch = text[text.index("SortAggregate"):]
    assert batch.count("Exchange hashpartitioning") == 2 and "partial_first(raw" in batch


def test_a_small_load_skips_row_groups_by_hash(spark, tmp_path):
    path = str(tmp_path / "events")
    day = F.lit("2024-01-01").cast("date")
    rows = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_hash"), F.lit("t").alias("team_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("event_timestamp"), day.alias("event_date"))
    tables.ranged(rows).write.options(**tables._HASH_FILTER, **{"parquet.block.size": str(1 << 17)}).partitionBy(
        "event_date").parquet(path)
    events, wanted = spark.read.parquet(path), hashlib.sha256(b"77").hexdigest()
    batch = rows.filter(F.col("event_hash") == wanted)
    known = P.known_keys(events, batch, spark.createDataFrame([(dt.date(2024, 1, 1),)], "event_date date"))
    assert [r.event_hash for r in known.collect()] == [wanted]
    assert "PushedFilters" in plan(known) and "event_hash" in plan(known).split("PushedFilters")[1].split("\n")[0]
    assert rows_read(known) < 30_000


def rows_read(df):
    """Rows that the file scans of a frame return."""
    df.collect()

    def walk(node):
        children = node.children()
        own = node.metrics().apply("numOutputRows").value() if node.nodeName().startswith("Scan parquet") else 0
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_one_team_opens_a_part_of_a_days_files(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.range(40_000, numPartitions=8).select(
        F.lit("2024-01-01").cast("date").alias("event_date"),
        F.concat(F.lit("team-"), F.when(F.col("id") % 10 < 6, 0).otherwise(F.col("id") % 10)).alias("team_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("event_timestamp"),
        F.sha2(F.col("id").cast("string"), 256).alias("event_hash"))
    with tables.settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        tables.write_events(rows, path)
    events = spark.read.parquet(path)
    whole = rows_read(events.filter("event_hash <> ''"))
    assert whole == 40_000
    assert rows_read(events.filter("team_id = 'team-8' AND event_hash <> ''")) < whole / 2
    # The team that fills most of the day is cut by time: its files follow each other.
    hot = events.filter("team_id = 'team-0'").groupBy(F.input_file_name()).agg(
        F.min("event_timestamp").alias("low"), F.max("event_timestamp").alias("high")).orderBy("low").collect()
    assert len(hot) >= 4 and all(a.high < b.low for a, b in zip(hot, hot[1:]))


def test_delta_marts_do_not_read_old_events(spark, house):
    dates = spark.createDataFrame([(dt.date(2024, 1, 5),)], "event_date date")
    inserted = tables.on_dates(house.events(spark).filter("load_id = 'x'"), dates, "event_date")
    for state in P.STATES:
        text = plan(state.build(inserted))
        assert "EqualTo(load_id,x)" in text
    # Deciding what a date needs reads no column of its events.
    text = plan(P.date_actions(spark, house, dates, "x"))
    assert "ReadSchema: struct<>" in text


def test_counts_come_from_footers(spark, house):
    text = plan(C.layer_row_counts(house.layers(spark)))
    assert text.count("ReadSchema: struct<>") == 5


def test_transcript_files_are_read_in_blocks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n" * 50)
    text = plan(tail_lines(spark, str(tmp_path), 30, 1 << 20))
    assert "wholetext" not in text.lower() and "file_block_start" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_months_prune_days(spark, house):
    text = plan(V.monthly_active_events(house.events(spark), dt.date(2024, 1, 1), dt.date(2024, 1, 1)))
    assert "PartitionFilters: [isnotnull(event_date" in text and "2024-02-01" in text


def test_transcript_tails_are_cut_before_the_shuffle(spark):
    text = plan(N.stop_reason_by_line(td.transcript_turns(spark, SF), "conv_id", ["turn"], "line", 3))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_tool_total_shares_the_event_scan(spark, house):
    df = C.api_tools(house.events(spark), *AT)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_mart_writes_rebalance_by_date(spark, house):
    text = plan(tables.clustered(house.mart(spark, "user_summary"), "summary_date", "team_id"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
