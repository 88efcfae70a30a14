"""Named queries over the bundled tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.text import (
    is_usage_limit,
    project_name,
    user_identifier,
)
from eventloom.operators import dashboard as Q
from eventloom.operators import derived as D
from eventloom.operators import marts as A
from eventloom.operators import normalize as N
from eventloom.operators import service_stats as C
from eventloom.operators import views as V
from eventloom.operators.clean import remap_user_summary, remap_users
from eventloom.plans import ingest_cases
from eventloom.sources import testdata
from eventloom.sources.exports import export_flat
from eventloom.sources.raw_logs import with_provenance
from eventloom.sources.testdata import AS_OF, DAYS, TEAM, USER

Query = Callable[[SparkSession, str], DataFrame]


def _on_events(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: op(testdata.usage_events(spark, sf))


def _on_marts(op: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        events = testdata.usage_events(spark, sf)
        return op(A.daily_summary(events), A.user_summary(events), A.tool_summary(events))

    return run


# --- normalisation queries --------------------------------------------------


def _classify_tools(spark: SparkSession, sf: str) -> DataFrame:
    hooks = testdata.hook_records(spark, sf).fillna({"tool_name": "unknown"})
    return N.classify_tool(hooks, "tool_name", "tool_input").select(
        "event_id", "tool_name", "categories.*"
    )


def _limit_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.transcript_texts(spark, sf).select(
        "path", is_usage_limit(F.col("value")).alias("is_usage_limit")
    )


def _stop_reason_tail(spark: SparkSession, sf: str) -> DataFrame:
    return N.stop_reason_by_line(
        testdata.transcript_turns(spark, sf), "conv_id", ["turn"], "line"
    )


def _stop_reason_text(spark: SparkSession, sf: str) -> DataFrame:
    return N.stop_reason(testdata.transcript_texts(spark, sf))


def _pseudonymize(spark: SparkSession, sf: str) -> DataFrame:
    who = [F.col("explicit_user_id"), F.col("username"), F.col("hostname")]
    return testdata.hook_records(spark, sf).select(
        "event_id",
        user_identifier(*who).alias("user_id"),
        user_identifier(*who, anonymize=True).alias("anonymous_id"),
    )


def _project_names(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.hook_records(spark, sf).select(
        "event_id", project_name(F.col("project_dir")).alias("project")
    )


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    return N.normalize_hooks(
        testdata.hook_records(spark, sf), testdata.transcript_texts(spark, sf)
    )


def _normalize_hooks(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_flags(_payloads(spark, sf))


def _flat_flags(payloads: DataFrame) -> DataFrame:
    flags = ("skill", "subagent", "mcp", "command", "file_operation")
    return payloads.select(
        *[c for c in payloads.columns if c != "categories"],
        *[F.col(f"categories.{name}").alias(f"cat_{name}") for name in flags],
    )


def _redact(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_flags(N.redact(_payloads(spark, sf)))


def _validate_events(spark: SparkSession, sf: str) -> DataFrame:
    payloads = testdata.usage_events(spark, sf).selectExpr(
        "event_id",
        "CASE WHEN event_id % 5 > 0 THEN event_type END AS event_type",
        "CASE WHEN event_id % 7 > 0 THEN CAST(event_timestamp AS STRING) END AS timestamp",
        "CASE WHEN event_id % 11 > 0 THEN user_id END AS user_id",
        "CASE WHEN event_id % 13 > 0 THEN team_id END AS team_id",
        "project_name AS project", "session_id",
    )
    ok, rejected = N.validate_events(payloads)
    ok = ok.withColumn("reject_reason", F.lit(None).cast("string"))
    return ok.unionByName(rejected).select("event_id", "project", "reject_reason")


def _validate_types(spark: SparkSession, sf: str) -> DataFrame:
    ok, rejected = N.validate_documents(testdata.loose_lines(spark, sf))
    typed = ok.select(
        "event_id", "event_type", "project", "success", "output_length",
        F.array_join(F.array_sort(F.map_keys(F.map_filter("categories", lambda _, v: v))), ",").alias("flags"))
    reasons = rejected.select("event_id", F.array_join("reject_reasons", ",").alias("reject_reasons"))
    return typed.unionByName(reasons, allowMissingColumns=True)


# --- source and sink queries ------------------------------------------------


def _path_provenance(spark: SparkSession, sf: str) -> DataFrame:
    paths = testdata.usage_events(spark, sf).select(
        "event_id",
        F.expr("CASE event_id % 3"
               " WHEN 0 THEN concat('/logs/', user_id, '/events-',"
               "   date_format(event_date, 'yyyy-MM-dd'), '.jsonl')"
               " WHEN 1 THEN concat('/arch/', date_format(event_date, 'yyyyMMdd'), '/', user_id,"
               "   '-events-', date_format(event_date, 'yyyyMMdd'), '.jsonl.gz')"
               " ELSE concat('/sink/event_date=', date_format(event_date, 'yyyy-MM-dd'),"
               "   '/part-00001.json') END").alias("source_file"),
    )
    return with_provenance(paths).select("event_id", "uploader", "log_date")


def _export_flat(spark: SparkSession, sf: str) -> DataFrame:
    lines = testdata.jsonl_lines(testdata.usage_events(spark, sf))
    return export_flat(lines, "event_id")


_RENAMES = {
    "user0": "user1@example.com",
    "user8@example.com": "user8b@example.com",
    "user9@example.com": "user8b@example.com",
}


def _user_remap(spark: SparkSession, sf: str) -> DataFrame:
    return remap_user_summary(A.user_summary(testdata.usage_events(spark, sf)), _RENAMES)


def _user_remap_events(spark: SparkSession, sf: str) -> DataFrame:
    # Users without a mail domain move to one.
    events = testdata.usage_events(spark, sf)
    mapping = events.filter("NOT contains(user_id, '@')").selectExpr(
        "user_id AS old_id", "concat(user_id, '@example.com') AS new_id"
    ).distinct()
    return C.user_activity(remap_users(events, mapping))


def _layer_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = testdata.usage_events(spark, sf)
    return C.layer_row_counts({
        "raw_events": testdata.table(spark, sf, "events"),
        "events": events,
        "daily_summary": A.daily_summary(events),
        "user_summary": A.user_summary(events),
        "tool_summary": A.tool_summary(events),
    })


def _user_ranked(daily: DataFrame, users: DataFrame, tools: DataFrame) -> DataFrame:
    ranked = D.user_ranked(Q.user_leaderboard(users, TEAM, DAYS, AS_OF), AS_OF)
    return ranked.withColumn("tags", F.array_join("tags", ","))


def queries() -> dict[str, Query]:
    at = (TEAM, DAYS, AS_OF)
    return {
        # marts
        "daily_summary": _on_events(A.daily_summary),
        "user_summary": _on_events(A.user_summary),
        "tool_summary": _on_events(A.tool_summary),
        # views
        "v_kpi_metrics": _on_events(V.kpi_metrics),
        "v_user_ranking": _on_events(V.user_ranking),
        "v_tool_ranking": _on_events(V.tool_ranking),
        "v_overview_daily": _on_events(V.overview_daily),
        "v_user_stats": _on_events(V.user_stats_all),
        "v_tool_stats": _on_events(V.tool_stats_daily),
        "v_session_stats": _on_events(V.session_stats),
        "v_project_stats": _on_events(V.project_stats),
        "v_monthly_active": _on_events(V.monthly_active_events),
        "v_feature_adoption": _on_events(V.feature_adoption_daily),
        # dashboard queries
        "kpi_overview": _on_marts(lambda d, u, t: Q.kpi_overview(d, u, *at)),
        "timeline": _on_marts(lambda d, u, t: Q.timeline(d, *at)),
        "heatmap": _on_events(lambda e: Q.heatmap(e, *at)),
        "user_leaderboard": _on_marts(lambda d, u, t: Q.user_leaderboard(u, *at)),
        "user_timeline": _on_marts(lambda d, u, t: Q.user_timeline(u, TEAM, USER, DAYS, AS_OF)),
        "user_top_tools": _on_events(lambda e: Q.user_top_tools(e, TEAM, USER, DAYS, AS_OF)),
        "tool_leaderboard": _on_marts(lambda d, u, t: Q.tool_leaderboard(t, *at)),
        "tool_trend": _on_marts(lambda d, u, t: Q.tool_trend(t, *at)),
        "session_kpi": _on_events(lambda e: Q.session_kpi(e, *at)),
        "stop_reasons": _on_events(lambda e: Q.stop_reasons(e, *at)),
        "limit_hits_by_hour": _on_events(lambda e: Q.limit_hits_by_hour(e, *at)),
        "project_ranking": _on_events(lambda e: Q.project_ranking(e, *at)),
        "monthly_active": _on_marts(lambda d, u, t: Q.monthly_active(d, u, TEAM)),
        "feature_adoption": _on_marts(lambda d, u, t: Q.feature_adoption(u, *at)),
        "roi_kpi": _on_marts(lambda d, u, t: Q.roi_kpi(d, u, t, *at)),
        "productivity_trend": _on_marts(lambda d, u, t: Q.productivity_trend(d, u, *at)),
        "user_efficiency": _on_marts(lambda d, u, t: Q.user_efficiency(u, *at)),
        "weekly_feature_mix": _on_marts(lambda d, u, t: Q.weekly_feature_mix(d, TEAM, 30, AS_OF)),
        # service, command line and admin statistics
        "api_stats": _on_events(lambda e: C.api_stats(e, A.user_summary(e), *at)),
        "api_users": _on_events(lambda e: C.api_users(e, *at)),
        "api_tools": _on_events(lambda e: C.api_tools(e, *at)),
        "api_timeline": _on_events(lambda e: C.api_timeline(e, *at)),
        "personal_stats": _on_events(lambda e: C.personal_stats(e, DAYS, AS_OF)),
        "personal_daily": _on_events(lambda e: C.personal_daily(e, DAYS, AS_OF)),
        "personal_top_tools": _on_events(lambda e: C.personal_top_tools(e, DAYS, AS_OF)),
        "user_activity": _on_events(C.user_activity),
        "layer_row_counts": _layer_row_counts,
        # derived figures
        "overview_cards": _on_marts(lambda d, u, t: D.overview_cards(Q.kpi_overview(d, u, *at))),
        "session_cards": _on_events(lambda e: D.session_cards(Q.session_kpi(e, *at))),
        "adoption_long": _on_marts(lambda d, u, t: D.adoption_long(Q.feature_adoption(u, *at))),
        "roi_summary": _on_marts(lambda d, u, t: D.roi_summary(Q.roi_kpi(d, u, t, *at), DAYS)),
        "insights": _on_marts(lambda d, u, t: D.insights(Q.kpi_overview(d, u, *at))),
        "tool_tiers": _on_marts(lambda d, u, t: D.tool_tiers(Q.tool_leaderboard(t, *at))),
        "user_ranked": _on_marts(_user_ranked),
        "weekly_mix_share": _on_marts(
            lambda d, u, t: D.weekly_mix_share(Q.weekly_feature_mix(d, TEAM, 30, AS_OF))
        ),
        "user_bubble": _on_marts(lambda d, u, t: D.user_bubble(Q.user_efficiency(u, *at))),
        "limit_hours_dense": _on_events(lambda e: D.limit_hours_dense(Q.limit_hits_by_hour(e, *at))),
        "heatmap_dense": _on_events(lambda e: D.heatmap_dense(Q.heatmap(e, *at))),
        "heatmap_pivot": _on_events(lambda e: D.heatmap_pivot(Q.heatmap(e, *at))),
        "stop_reason_labels": _on_events(lambda e: D.stop_reason_labels(Q.stop_reasons(e, *at))),
        "project_table": _on_events(lambda e: D.project_table(Q.project_ranking(e, *at))),
        # normalisation
        "classify_tools": _classify_tools,
        "limit_phrases": _limit_phrases,
        "stop_reason_tail": _stop_reason_tail,
        "stop_reason_text": _stop_reason_text,
        "pseudonymize": _pseudonymize,
        "normalize_hooks": _normalize_hooks,
        "project_names": _project_names,
        "redact": _redact,
        "validate_events": _validate_events,
        "validate_types": _validate_types,
        "stop_reason_files": ingest_cases.stop_reason_files,
        # ingest, sources and sinks
        "ingest_clean": ingest_cases.ingest_clean,
        "ingest_quarantine": ingest_cases.ingest_quarantine,
        "ingest_dedup": ingest_cases.ingest_dedup,
        "ingest_forced_reload": ingest_cases.ingest_forced_reload,
        "ingest_upsert": ingest_cases.ingest_upsert,
        "ingest_late_data": ingest_cases.ingest_late_data,
        "ingest_tool_mart": ingest_cases.ingest_tool_mart,
        "ingest_stage_retry": ingest_cases.ingest_stage_retry,
        "ingest_heal": ingest_cases.ingest_heal,
        "user_remap_stored": ingest_cases.user_remap_stored,
        "stored_kpi_overview": ingest_cases.stored_kpi_overview,
        "stored_roi_kpi": ingest_cases.stored_roi_kpi,
        "stored_api_stats": ingest_cases.stored_api_stats,
        "stored_sessions": ingest_cases.stored_sessions,
        "stored_session_kpi": ingest_cases.stored_session_kpi,
        "warehouse_row_counts": ingest_cases.warehouse_row_counts,
        "file_listing": ingest_cases.file_listing,
        "file_ledger": ingest_cases.file_ledger,
        "export_json_order": ingest_cases.export_json_order,
        "export_csv": ingest_cases.export_csv_rows,
        "file_inventory": ingest_cases.file_inventory_by_day,
        "path_provenance": _path_provenance,
        "jsonl_by_day": ingest_cases.jsonl_by_day,
        "export_json": ingest_cases.export_json_lines,
        "export_flat": _export_flat,
        "user_remap": _user_remap,
        "user_remap_events": _user_remap_events,
    }
