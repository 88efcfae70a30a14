"""Dashboard figures derived from the query results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import metrics as M
from eventloom.functions.clock import AsOf, monday_first, time_ago
from eventloom.functions.text import label, project_display
from eventloom.schema import STOP_LABELS, WEEKDAY_LABELS


def _rows(df: DataFrame, items: list[dict[str, Column]]) -> DataFrame:
    """Turn each row into one row per item."""
    structs = [F.struct(*[col.alias(name) for name, col in item.items()]) for item in items]
    return df.select(F.inline(F.array(*structs)))


# --- overview ---------------------------------------------------------------


def overview_cards(kpi: DataFrame) -> DataFrame:
    """The six headline cards with change, direction and user penetration."""
    c = F.col
    cards = [
        ("messages", "msg_count", "prev_msg"),
        ("sessions", "sess_count", "prev_sess"),
        ("active_users", "active_users", "prev_users"),
        ("skills", "skill_count", "prev_skill"),
        ("mcp", "mcp_count", "prev_mcp"),
        ("limit_hits", "limit_hits", None),
    ]
    items = []
    for name, current, previous in cards:
        change = M.pct_change(c(current), c(previous)) if previous else F.lit(0.0)
        penetration = (
            M.whole_percent(c("active_users"), c("total_users"))
            if name == "active_users"
            else F.lit(None).cast("bigint")
        )
        items.append({
            "card": F.lit(name),
            "value": M.or_zero(c(current)).cast("bigint"),
            "change_pct": change.cast("double"),
            "penetration_pct": penetration,
        })
    return _rows(kpi, items).withColumn("direction", M.change_direction(F.col("change_pct")))


def insights(kpi: DataFrame) -> DataFrame:
    """Five rule-based findings about the period."""
    msg = M.pct_change(F.col("msg_count"), F.col("prev_msg"))
    mcp = M.pct_change(F.col("mcp_count"), F.col("prev_mcp"))
    hits = M.or_zero(F.col("limit_hits"))
    pct = M.whole_percent(F.col("active_users"), F.col("total_users"))

    def item(position: int, style, tag, value, advice) -> dict[str, Column]:
        def text(part) -> Column:
            return part if isinstance(part, Column) else F.lit(part)

        return {
            "position": F.lit(position),
            "style": text(style),
            "tag": text(tag),
            "value": value.cast("double"),
            "advice": text(advice),
        }

    return _rows(kpi, [
        item(1, F.when(msg >= 0, "trend-up").otherwise("trend-down"),
             F.when(msg >= 0, "TREND UP").otherwise("TREND DOWN"), msg, "watch_trend"),
        item(2, F.when(mcp > 5, "trend-up").otherwise("usecase"),
             F.when(mcp > 5, "MCP ADOPTION").otherwise("USECASE"), mcp,
             F.when(mcp > 5, "mcp_growing").otherwise("code_generation")),
        item(3, "power-user", "POWER USER", F.lit(None), "share_skills"),
        item(4, F.when(hits > 10, "trend-down").otherwise("neutral"), "USAGE LIMIT", hits,
             F.when(hits > 0, "plan_usage").otherwise("no_limit_hits")),
        item(5, "neutral", "ADOPTION", pct,
             F.when(pct < 80, "reach_inactive").otherwise("high_adoption")),
    ])


# --- heatmap and hours ------------------------------------------------------


def limit_hours_dense(by_hour: DataFrame) -> DataFrame:
    """All 24 hours, zero where no limit was hit."""
    hours = by_hour.sparkSession.range(24).select(F.col("id").cast("int").alias("hour_of_day"))
    return (
        hours.join(by_hour, "hour_of_day", "left")
        .select("hour_of_day", F.coalesce("limit_hits", F.lit(0)).alias("limit_hits"))
        .orderBy("hour_of_day")
    )


def heatmap_dense(cells: DataFrame) -> DataFrame:
    """All 7 x 24 cells, Monday first, zero where nothing happened."""
    spine = cells.sparkSession.range(7 * 24).select(
        F.floor(F.col("id") / 24).cast("int").alias("dow"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"),
    )
    return (
        spine.join(cells, ["dow", "hour_of_day"], "left")
        .select(
            monday_first(F.col("dow")).alias("day_order"),
            "dow",
            label(F.col("dow"), WEEKDAY_LABELS).alias("weekday"),
            "hour_of_day",
            F.coalesce("event_count", F.lit(0)).alias("event_count"),
        )
        .orderBy("day_order", "hour_of_day")
    )


def heatmap_pivot(cells: DataFrame) -> DataFrame:
    """One row per weekday with a column per hour."""
    hours = list(range(24))
    wide = (
        heatmap_dense(cells)
        .groupBy("day_order", "weekday")
        .pivot("hour_of_day", hours)
        .agg(F.sum("event_count"))
        .na.fill(0)
    )
    return wide.select(
        "day_order", "weekday", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in hours]
    ).orderBy("day_order")


# --- users ------------------------------------------------------------------


def user_ranked(board: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Leaderboard rows with rank, age of the last activity and feature tags.

    Expects a leaderboard already cut to its top k; only those rows reach the
    unpartitioned window.
    """
    order = Window.orderBy(F.col("total_count").desc(), "user_id")
    return board.select(
        F.row_number().over(order).alias("rank"),
        "user_id",
        "display_name",
        time_ago(F.col("last_active"), as_of).alias("last_seen"),
        M.user_tags(F.col("skill_count"), F.col("subagent_count"), F.col("mcp_count")).alias("tags"),
        "message_count", "session_count", "skill_count", "mcp_count", "limit_hits", "total_count",
    )


def user_bubble(efficiency: DataFrame) -> DataFrame:
    """Efficiency rows with a marker size relative to the busiest user.

    The maximum comes from a scalar subquery: users are unbounded and must not
    meet in one window partition.
    """
    largest = efficiency.agg(F.max("sessions").alias("largest")).scalar()
    return efficiency.withColumn("marker_size", M.marker_size(F.col("sessions"), largest))


# --- tools and sessions -----------------------------------------------------


def tool_tiers(board: DataFrame, n: int = 10) -> DataFrame:
    """First n tools of the leaderboard with their success tier."""
    return (
        board.orderBy(F.col("total_count").desc(), "tool_name")
        .limit(n)
        .select("tool_name", "total_count", "success_rate",
                M.success_tier(F.col("success_rate")).alias("tier"))
    )


def session_cards(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "total_sessions",
        F.coalesce("avg_duration_min", F.lit(0.0)).alias("avg_duration_min"),
        "normal_stopped",
        M.or_zero(F.col("limit_stopped")).cast("bigint").alias("limit_stopped"),
        M.limit_stop_pct(F.col("limit_stopped"), F.col("total_sessions")).alias("limit_stop_pct"),
    )


def stop_reason_labels(reasons: DataFrame) -> DataFrame:
    return reasons.select(
        "stop_reason", label(F.col("stop_reason"), STOP_LABELS).alias("label"), "session_count"
    )


def project_table(ranking: DataFrame) -> DataFrame:
    """Project ranking with the short display name."""
    return ranking.withColumn("short_name", project_display(F.col("project_name")))


# --- adoption ---------------------------------------------------------------


def adoption_long(adoption: DataFrame) -> DataFrame:
    """One row per feature: users, share and users not yet adopting it."""
    total = F.when(M.or_zero(F.col("total_users")) == 0, F.lit(1)).otherwise(F.col("total_users"))
    features = [("Skill", "skill_users"), ("MCP", "mcp_users"),
                ("Subagent", "subagent_users"), ("Command", "command_users")]
    long = _rows(adoption, [
        {"feature": F.lit(name), "users": F.col(col), "total_users": total}
        for name, col in features
    ])
    return long.select(
        "feature", "users", "total_users",
        M.whole_percent(F.col("users"), F.col("total_users")).alias("feature_pct"),
        (F.col("total_users") - F.col("users")).alias("non_adopters"),
    )


# --- return on investment ---------------------------------------------------


def roi_summary(kpi: DataFrame, days: int) -> DataFrame:
    """Time saved, efficiency and projections of the period and its change."""
    c = F.col
    active, total = M.at_least_one(c("active_users")), M.at_least_one(c("total_users"))

    def figures(prefix: str) -> dict[str, Column]:
        def get(name: str) -> Column:
            return c(prefix + name)

        users = M.at_least_one(get("active_users"))
        return {
            "hours_saved": M.hours_saved(get("tool_execs")),
            "events_per_user": M.ratio(M.or_zero(get("total_events")), users, ties="even"),
            "tool_success_pct": M.percent(
                M.or_zero(get("tool_success")), M.at_least_one(get("tool_total")), ties="even"
            ),
            "depth_score": M.depth_score(
                get("skill_users"), get("mcp_users"), get("sa_users"), get("cmd_users"),
                M.at_least_one(get("feat_total")),
            ),
        }

    now, before = figures(""), figures("prev_")
    base = kpi.select(
        active.alias("active"), total.alias("total"),
        *[col.alias(name) for name, col in now.items()],
        *[col.alias(f"prev_{name}") for name, col in before.items()],
    )
    annual = M.annual_hours(c("hours_saved"), days)
    scaled = annual * (c("total") / c("active").cast("double"))
    return base.select(
        *now,
        *[f"prev_{name}" for name in before],
        *[M.pct_change(c(name), c(f"prev_{name}")).alias(f"{name}_change") for name in now],
        annual.alias("annual_hours"),
        M.person_months(annual).alias("annual_person_months"),
        (c("hours_saved") / c("active")).alias("hours_per_user"),
        scaled.alias("scaled_annual_hours"),
        M.person_months(scaled).alias("scaled_person_months"),
        M.whole_percent(c("active"), c("total")).alias("active_pct"),
    )


def weekly_mix_share(mix: DataFrame) -> DataFrame:
    """Weekly feature mix as shares of the week's total in percent."""
    parts = ["basic_tools", "messages", "skills", "mcp"]
    whole = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return mix.select(
        "week_start",
        *[F.try_divide(F.col(p).cast("double") * 100, whole).alias(f"{p}_pct") for p in parts],
    ).orderBy("week_start")
