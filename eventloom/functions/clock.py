"""Time helpers: the explicit clock, report periods and calendar parts.

Event time is a zone-less Tokyo wall clock.  Every period is computed from an
explicit ``as_of`` wall clock in Python, so the bounds reach the plan as
literals that prune partitions and push down to the file scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.schema import EVENT_ZONE, PERIOD_DAYS, TREND_CAP_DAYS

AsOf = datetime | str | None
# A period that reaches back before every date.
ALL_HISTORY = 200_000
# A letter or a sign after a time of day names an offset or a zone.
_HAS_OFFSET = r"\d:\d.*[A-Za-z+-]"


def resolve_as_of(as_of: AsOf = None) -> datetime:
    """The report clock as a naive Tokyo wall clock; now when not given."""
    if as_of is None:
        return datetime.now(ZoneInfo(EVENT_ZONE)).replace(tzinfo=None)
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(ZoneInfo(EVENT_ZONE)).replace(tzinfo=None)
    return as_of


def to_utc(wall: datetime) -> datetime:
    """Naive UTC wall clock of a naive Tokyo wall clock."""
    aware = wall.replace(tzinfo=ZoneInfo(EVENT_ZONE))
    return aware.astimezone(ZoneInfo("UTC")).replace(tzinfo=None)


def from_utc(wall: datetime) -> datetime:
    """Naive Tokyo wall clock of a naive UTC wall clock."""
    aware = wall.replace(tzinfo=ZoneInfo("UTC"))
    return aware.astimezone(ZoneInfo(EVENT_ZONE)).replace(tzinfo=None)


def ntz_lit(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def date_lit(day: date) -> Column:
    return F.lit(day.isoformat()).cast("date")


# --- periods ----------------------------------------------------------------


def period_days(label: str) -> int:
    """Days behind a period preset (1D, 7D, 30D, 90D, All).

    All means one year, as dashboards show it; ALL_HISTORY reaches every date.
    """
    return PERIOD_DAYS[label]


def cap_days(days: int, cap: int | None = TREND_CAP_DAYS) -> int:
    """``days``, at most ``cap``; None lifts the cap."""
    return days if cap is None else min(days, cap)


def date_in_current(days: int, as_of: AsOf = None, col: str = "summary_date") -> Column:
    """Mart-grain current period; it has no upper bound."""
    today = resolve_as_of(as_of).date()
    return F.col(col) >= date_lit(today - timedelta(days=days))


def date_in_previous(days: int, as_of: AsOf = None, col: str = "summary_date") -> Column:
    """Mart-grain previous period, half open."""
    today = resolve_as_of(as_of).date()
    return (F.col(col) >= date_lit(today - timedelta(days=2 * days))) & (
        F.col(col) < date_lit(today - timedelta(days=days))
    )


def event_since(start: datetime, ts: str = "event_timestamp", day: str = "event_date") -> Column:
    """Events from ``start`` on; the date bound prunes table partitions."""
    return (F.col(ts) >= ntz_lit(start)) & (F.col(day) >= date_lit(start.date()))


def event_in_current(days: int, as_of: AsOf = None) -> Column:
    """Event-grain current period: rolling, without an upper bound."""
    return event_since(resolve_as_of(as_of) - timedelta(days=days))


def current_dates(df: DataFrame, days: int, as_of: AsOf = None) -> DataFrame:
    return df.filter(date_in_current(days, as_of))


def current_events(df: DataFrame, days: int, as_of: AsOf = None) -> DataFrame:
    return df.filter(event_in_current(days, as_of))


def previous_period(df: DataFrame, days: int, as_of: AsOf = None) -> DataFrame:
    return df.filter(date_in_previous(days, as_of))


def for_team(df: DataFrame, team_id: str) -> DataFrame:
    return df.filter(F.col("team_id") == F.lit(team_id))


# --- calendar parts ---------------------------------------------------------


def day_of_week(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("int")


def monday_first(dow: Column) -> Column:
    """Sort key that starts the week on Monday."""
    return F.pmod(dow + 6, F.lit(7))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(day, "week")


def wall_seconds(wall: Column) -> Column:
    """Seconds of a zone-less wall clock since 1970, whatever the session's zone."""
    span = wall.cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    return span.cast("interval second").cast("decimal(18,6)")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two wall clocks."""

    def minute(ts: Column) -> Column:
        return F.floor(wall_seconds(ts) / 60)

    return (minute(end) - minute(start)).cast("bigint")


# --- conversions ------------------------------------------------------------


def event_time(text: Column) -> Column:
    """Tolerant ISO-8601 text to Tokyo wall clock; NULL when unreadable.

    Text without an offset is UTC.  Nothing depends on the session's zone: a
    text with an offset is read as a moment and placed on the UTC wall clock
    by its distance from 1970, a text without one as a wall clock.
    """
    moment = F.lit("1970-01-01").cast("timestamp_ntz") + F.lit(
        timedelta(microseconds=1)) * F.unix_micros(F.try_to_timestamp(text))
    wall = F.when(text.rlike(_HAS_OFFSET), moment).otherwise(text.try_cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(EVENT_ZONE), wall)


def utc_wall(ts: Column) -> Column:
    """UTC wall clock of a stored event time."""
    return F.convert_timezone(F.lit(EVENT_ZONE), F.lit("UTC"), ts)


def iso_utc(wall: Column) -> Column:
    """ISO text of a UTC wall clock."""
    text = wall.cast("timestamp_ntz").cast("string")
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.translate(F.substring(text, 1, 19), " ", "T"), F.lit("."), fraction,
                    F.lit("+00:00"))


def time_ago(ts: Column, as_of: AsOf = None) -> Column:
    """Coarse age of ``ts``: days, else hours, else minutes, else now.

    A moment after the clock counts back within its day, so its age is taken
    modulo one day.
    """
    seconds = F.floor(wall_seconds(ntz_lit(resolve_as_of(as_of))) - wall_seconds(ts))
    days = F.floor(seconds / 86_400)
    rest = F.pmod(seconds, F.lit(86_400))
    hours = F.floor(rest / 3_600)
    minutes = F.floor(rest / 60)
    return (
        F.when(ts.isNull(), F.lit("-"))
        .when(days > 0, F.concat(days.cast("string"), F.lit(" days")))
        .when(hours > 0, F.concat(hours.cast("string"), F.lit(" hours")))
        .when(minutes > 0, F.concat(minutes.cast("string"), F.lit(" minutes")))
        .otherwise(F.lit("now"))
    )
