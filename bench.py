"""Headline timings: prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local cores.  Operators
over the stored warehouse run once to warm up and then BENCH_RUNS times; the
median counts.  Every other registered query, from the raw tables on, is timed
once after one run to warm up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventloom.operators import dashboard as Q
from eventloom.operators import marts as A
from eventloom.operators import normalize as N
from eventloom.operators import service_stats as C
from eventloom.operators import sessions as S
from eventloom.operators import views as V
from eventloom.plans import registry
from eventloom.plans.ingest_cases import LoadCase, event_lines
from eventloom.plans.pipeline import rebuild_marts
from eventloom.sources import testdata as td
from eventloom.sources.exports import export_flat
from eventloom.sources.tables import read_table
from eventloom.sources.workdir import fresh_folder


# Whole loads and exports; the three load figures stand for them.
LOADS = {
    *(n for n in registry.queries() if n.startswith("ingest_")), "user_remap_stored", "file_inventory",
    "jsonl_by_day", "export_json", "export_csv", "export_json_order", "file_listing", "file_ledger",
    "stop_reason_files",
}


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int) -> float:
    action()
    laps = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        laps.append(time.perf_counter() - start)
    return round(statistics.median(laps), 4)


def load(spark: SparkSession, sf: str) -> tuple[dict[str, float], LoadCase]:
    """First load, a small second load over known dates, and a full rebuild."""
    times: dict[str, float] = {}
    case = LoadCase(spark, "bench")

    def lap(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 4)

    case.deliver(event_lines(spark, sf, "event_date < date'2024-01-30'"))
    lap("ingest_first_load", case.run)
    case.deliver(event_lines(spark, sf, "event_date >= date'2024-01-30'"))
    lap("ingest_upsert", case.run)
    lap("ingest_full_rebuild", lambda: rebuild_marts(spark, case.warehouse))
    return times, case


def stored(spark: SparkSession, df: DataFrame, name: str, tasks: int) -> DataFrame:
    """An adapter frame written once, so that only the operator is timed."""
    path = fresh_folder(spark, name)
    df.repartition(tasks).write.parquet(path)
    return read_table(spark, path, df.schema)


def actions(spark: SparkSession, sf: str, case: LoadCase, tasks: int) -> dict[str, DataFrame]:
    """Operators over the stored warehouse and the stored raw inputs."""
    at = (td.TEAM, td.DAYS, td.AS_OF)
    house = case.warehouse
    events = house.events(spark)
    daily, users, tools = (
        house.mart(spark, n) for n in ("daily_summary", "user_summary", "tool_summary"))
    hooks = stored(spark, td.hook_records(spark, sf), "hooks", tasks)
    texts = stored(spark, td.transcript_texts(spark, sf), "texts", tasks)
    turns = stored(spark, td.transcript_turns(spark, sf), "turns", tasks)
    lines = stored(spark, event_lines(spark, sf).select("value"), "lines", tasks)
    return {
        "daily_summary": A.daily_summary(events),
        "user_summary": A.user_summary(events),
        "tool_summary": A.tool_summary(events),
        "v_session_stats": V.session_stats(events),
        "v_feature_adoption": V.feature_adoption_daily(events),
        "v_monthly_active": V.monthly_active_events(events),
        "v_project_stats": V.project_stats(events),
        "heatmap": Q.heatmap(events, *at),
        "project_ranking": Q.project_ranking(events, *at),
        "session_kpi": Q.session_kpi(events, *at),
        "session_kpi_by_days": S.session_kpi(house.session_days(spark), events, *at),
        "kpi_overview": Q.kpi_overview(daily, users, *at),
        "kpi_overview_by_bits": Q.kpi_overview(daily, None, *at, house.user_days(spark)),
        "user_leaderboard": Q.user_leaderboard(users, *at),
        "tool_trend": Q.tool_trend(tools, *at),
        "roi_kpi": Q.roi_kpi(daily, users, tools, *at),
        "api_stats": C.api_stats(events, users, *at),
        "api_tools": C.api_tools(events, *at),
        "normalize_hooks": N.normalize_hooks(hooks, texts),
        "stop_reason_tail": N.stop_reason_by_line(turns, "conv_id", ["turn"], "line", 3),
        "stop_reason_text": N.stop_reason(texts),
        "export_flat": export_flat(lines),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, case = load(spark, sf)
    for name, df in actions(spark, sf, case, int(cpus)).items():
        times[name] = timed(lambda frame=df: consume(frame), runs)
    for name, query in registry.queries().items():
        if name not in times and name not in LOADS:
            times[name] = timed(lambda run=query: consume(run(spark, sf)), 1)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
