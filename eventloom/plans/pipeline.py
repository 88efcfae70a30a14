"""The load pipeline: raw lines to clean events to marts.

Each load lands its keyed lines in layer 1, adds the events that layer 2 does
not hold yet, and brings the marts of the dates it touched up to date.  Marts
are rolled up from daily states: partial aggregates to which a load adds those
of its own events, so the events already stored are not read again.  Every step
can be repeated: a load replaces its own raw partition, inserts skip known
hashes, and a date whose state does not account for exactly the stored events
is rebuilt from them, which heals whatever a crash left behind.

One writer per warehouse at a time: partition overwrites are not transactional.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.clean import key_lines, remap_users, split_bad, typed_events
from eventloom.operators.distinct_users import new_numbers, user_days
from eventloom.operators.marts import marts_from_base, merged_usage, usage_base, usage_rows, users_from_base
from eventloom.operators.sessions import merged_session_days, session_days, session_rows
from eventloom.plans.journal import Journal
from eventloom.schema import (
    DAILY_SCHEMA,
    EVENTS_SCHEMA,
    LEDGER_SCHEMA,
    RAW_SCHEMA,
    SESSION_DAYS_SCHEMA,
    TOOL_SCHEMA,
    USAGE_SCHEMA,
    USER_DAYS_SCHEMA,
    USER_NUMBERS_SCHEMA,
    USER_SCHEMA,
)
from eventloom.sources.raw_logs import list_files, read_raw
from eventloom.sources.tables import (
    append_raw,
    dates_of,
    on_dates,
    read_table,
    rewrite_events,
    stored,
    write_days,
    write_events,
    write_mart,
)

# The user mart is written last: while it is stale, the load that left it so shows.
_MARTS = {"daily_summary": DAILY_SCHEMA, "tool_summary": TOOL_SCHEMA, "user_summary": USER_SCHEMA}

# Up to so many hashes go into the scan of the stored events, where the hash
# filters of row groups without any of them answer; the rows found are the same.
POINT_HASHES = 1000
# All hashes of a load are only compared if its first lines, so many, do not hold more.
_FIRST_LINES = 4 * POINT_HASHES


@dataclass(frozen=True)
class DailyState:
    """Partial aggregates per day that loads add to.

    ``rows`` gives every event as a state row of its own, so that ``merge``
    groups them together with stored rows, in one shuffle; ``build`` is the
    state of events alone.
    """

    name: str
    schema: object
    day: str
    total: str
    build: Callable[[DataFrame], DataFrame]
    rows: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


STATES = (
    DailyState("usage_days", USAGE_SCHEMA, "summary_date", "total_events",
               lambda events: usage_base(events, by_tool=True), usage_rows, merged_usage),
    DailyState("session_days", SESSION_DAYS_SCHEMA, "event_date", "event_count",
               session_days, session_rows, merged_session_days),
)


@dataclass(frozen=True)
class Warehouse:
    """Paths of the layers below one root folder."""

    root: str

    @property
    def raw_path(self) -> str:
        return f"{self.root}/raw_events"

    @property
    def events_path(self) -> str:
        return f"{self.root}/events"

    def mart_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def raw(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.raw_path, RAW_SCHEMA)

    def load(self, spark: SparkSession, load_id: str) -> DataFrame:
        """Keyed lines of one load; only its own folder is listed."""
        folder = f"{self.raw_path}/load_id={load_id}"
        return read_table(spark, folder, RAW_SCHEMA, base_path=self.raw_path, required=True)

    def events(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.events_path, EVENTS_SCHEMA)

    def mart(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.mart_path(name), _MARTS[name])

    def state(self, spark: SparkSession, state: DailyState) -> DataFrame:
        return read_table(spark, self.mart_path(state.name), state.schema)

    def usage_days(self, spark: SparkSession) -> DataFrame:
        """Counters per date, team, user and tool."""
        return self.state(spark, STATES[0])

    def session_days(self, spark: SparkSession) -> DataFrame:
        """One row per session and day."""
        return self.state(spark, STATES[1])

    def user_numbers(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.mart_path("user_numbers"), USER_NUMBERS_SCHEMA)

    def user_days(self, spark: SparkSession) -> DataFrame:
        """Bits of each team's users of a day."""
        return read_table(spark, self.mart_path("user_days"), USER_DAYS_SCHEMA)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """Lines that could not become events, with the reason."""
        return split_bad(self.raw(spark))[1]

    def ledger(self, spark: SparkSession) -> DataFrame:
        """Files that have been loaded, once per load, with their lines."""
        return read_table(spark, self.mart_path("ledger"), LEDGER_SCHEMA)

    def journal(self, spark: SparkSession) -> Journal:
        return Journal(spark, f"{self.root}/journal")

    def layers(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {
            "raw_events": self.raw(spark),
            "events": self.events(spark),
            **{name: self.mart(spark, name) for name in _MARTS},
        }


# --- layer 2 ----------------------------------------------------------------


def insert_new(existing_keys: DataFrame, batch: DataFrame) -> DataFrame:
    """Keyed lines whose event the target does not hold, each hash once.

    ``raw`` is a function of the hash, and time and team are ones of ``raw``, so
    any copy will do.  Copies combine in the map tasks, a hash that fills much
    of a load sends one row from each, and the text is shuffled once: grouping
    and anti join share the key.  Equal hashes have equal dates, hence the date
    in it.
    """
    keys = ["event_date", "event_hash"]
    carried = [c for c in ("raw", "event_timestamp", "team_id") if c in batch.columns]
    once = batch.select(*keys, *carried).groupBy(*keys).agg(*[F.first(c).alias(c) for c in carried])
    return once.join(existing_keys.select(*keys), keys, "left_anti")


def known_keys(events: DataFrame, batch: DataFrame, dates: DataFrame) -> DataFrame:
    """(event_date, event_hash) of stored events on ``dates`` that a batch may repeat."""
    known = on_dates(events, dates, "event_date")

    def some_hashes(lines: DataFrame) -> list[str]:
        return [r.event_hash for r in lines.distinct().limit(POINT_HASHES + 1).collect()]

    # A load of many lines mostly shows by its first ones that it has too many hashes.
    hashes = some_hashes(batch.select("event_hash").limit(_FIRST_LINES))
    if len(hashes) <= POINT_HASHES:
        hashes = some_hashes(batch.select("event_hash"))
    if len(hashes) <= POINT_HASHES:
        known = known.filter(F.col("event_hash").isin(hashes))
    return known.select("event_date", "event_hash")


# --- layer 3 ----------------------------------------------------------------


def _per_date(rows: DataFrame, day: str, alias: str, total: str | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if total is None else F.sum(total)
    return rows.groupBy(F.col(day).alias("event_date")).agg(n.alias(alias))


def date_actions(spark: SparkSession, warehouse: Warehouse, dates: DataFrame,
                 load_id: str | None = None) -> DataFrame:
    """(event_date, action): what the daily states of each date need.

    ``keep`` when every state counts as many events as are stored, ``merge`` when
    it lacks as many as the load ``load_id`` inserted, ``rebuild`` otherwise.
    Stored events are only counted, which reads no column of theirs.
    """
    events = on_dates(warehouse.events(spark), dates, "event_date")
    added = events.filter(F.col("load_id") == load_id) if load_id else events.limit(0)
    counts = [_per_date(events, "event_date", "held"), _per_date(added, "event_date", "added")]
    for state in STATES:
        rows = warehouse.state(spark, state)
        on = dates.withColumnRenamed("event_date", state.day)
        counts.append(_per_date(on_dates(rows, on, state.day), state.day, state.name, state.total))
    joined = reduce(lambda a, b: a.join(b, "event_date", "left"), counts, dates)
    n = {c: F.coalesce(c, F.lit(0)) for c in ("held", "added", *(s.name for s in STATES))}
    current = reduce(lambda a, b: a & b, [n[s.name] == n["held"] for s in STATES])
    lacking = reduce(lambda a, b: a & b, [n[s.name] + n["added"] == n["held"] for s in STATES])
    return joined.select("event_date", F.when(current, "keep").when(
        lacking & F.lit(load_id is not None), "merge").otherwise("rebuild").alias("action"))


def together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run independent writes side by side; small ones mostly wait for their commits."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            running.result()


def update_states(spark: SparkSession, warehouse: Warehouse, actions: DataFrame,
                  load_id: str | None = None) -> None:
    """Bring the daily states of some dates up to date; ``actions`` are stored."""
    wanted = {r.action for r in actions.select("action").distinct().collect()}
    events = warehouse.events(spark)

    def update(state: DailyState) -> None:
        def those(action: str, day: str) -> DataFrame:
            return actions.filter(F.col("action") == action).select(F.col("event_date").alias(day))

        parts = []
        if "merge" in wanted:
            inserted = events.filter(F.col("load_id") == load_id)
            parts += [on_dates(warehouse.state(spark, state), those("merge", state.day), state.day),
                      state.rows(on_dates(inserted, those("merge", "event_date"), "event_date"))]
        if "rebuild" in wanted:
            parts.append(state.rows(on_dates(events, those("rebuild", "event_date"), "event_date")))
        if parts:
            columns = state.schema.fieldNames()
            whole = reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
            write_days(state.merge(whole).select(*columns), warehouse.mart_path(state.name),
                       state.day, "team_id")

    together(spark, *[partial(update, state) for state in STATES])


def write_marts(spark: SparkSession, warehouse: Warehouse, dates: DataFrame | None = None) -> None:
    """Roll the marts of ``dates`` (all: None) up from the daily states."""
    base = warehouse.usage_days(spark)
    if dates is not None:
        base = on_dates(base, dates.withColumnRenamed("event_date", "summary_date"), "summary_date")
    # Three of the four tables below come from the users of a day.
    users = stored(users_from_base(base), "users")
    marts = marts_from_base(base, users)

    def write(name: str) -> None:
        write_mart(marts[name], warehouse.mart_path(name))

    def write_bits() -> None:
        numbers = stored(new_numbers(users, warehouse.user_numbers(spark)), "numbers")
        if not numbers.isEmpty():
            numbers.write.mode("append").parquet(warehouse.mart_path("user_numbers"))
        write_days(user_days(marts["user_summary"], warehouse.user_numbers(spark)),
                   warehouse.mart_path("user_days"), "summary_date", "team_id")

    together(spark, partial(write, "daily_summary"), partial(write, "tool_summary"), write_bits)
    write("user_summary")


def refresh_marts(spark: SparkSession, warehouse: Warehouse, dates: DataFrame,
                  load_id: str | None = None) -> None:
    """Bring states and marts of ``dates`` up to date.

    With ``load_id`` the events that load inserted are added to states that
    lack just them; states that differ in any other way are rebuilt.
    """
    update_states(spark, warehouse, stored(date_actions(spark, warehouse, dates, load_id), "actions"),
                  load_id)
    write_marts(spark, warehouse, dates)


# --- loads ------------------------------------------------------------------


def _write_ledger(warehouse: Warehouse, load: DataFrame, load_id: str, files: DataFrame | None) -> None:
    lines = load.groupBy("source_file").agg(F.count(F.lit(1)).alias("line_count"))
    if files is not None:
        # Files without a line have been loaded too.
        lines = files.select("source_file").join(lines, "source_file", "full").select(
            "source_file", F.coalesce("line_count", F.lit(0)).alias("line_count"))
    lines.write.mode("overwrite").parquet(f"{warehouse.mart_path('ledger')}/load_id={load_id}")


def load_lines(lines: DataFrame, warehouse: Warehouse, load_id: str, strict: bool = True,
               files: DataFrame | None = None) -> None:
    """Run one load of raw lines (``value``, ``source_file``) through all layers.

    A failure in layers 1 or 2 stops the load before the ledger names its
    files.  One in the marts is recorded, and raised only if ``strict``: the
    load counts as loaded, and the next load of its dates or ``heal`` finds them
    stale.  ``files`` (``source_file``) names files that may hold no line.
    """
    spark = lines.sparkSession
    journal = warehouse.journal(spark)
    # A load that may have added to states before must not add again.
    fresh = not journal.has(load_id, "marts")
    with journal.watching(load_id, "raw"):
        append_raw(key_lines(lines), warehouse.raw_path, load_id)
    with journal.watching(load_id, "events"):
        # From here on everything reads the stored load, not the source files.
        load = warehouse.load(spark, load_id)
        good, _ = split_bad(load)
        per_date = stored(_per_date(good.filter("event_date IS NOT NULL"), "event_date", "n"), "dates")
        dates, rows = per_date.select("event_date"), per_date.agg(F.sum("n")).first()[0] or 0
        if rows:
            known = known_keys(warehouse.events(spark), good, dates)

            def finish(placed: DataFrame) -> DataFrame:
                return typed_events(placed).withColumn("load_id", F.lit(load_id)).select(
                    *EVENTS_SCHEMA.fieldNames())

            write_events(insert_new(known, good), warehouse.events_path, rows, finish)
        _write_ledger(warehouse, load, load_id, files)
    done = [("raw", "done", None), ("events", "done", None)]
    if not rows:
        journal.record(load_id, *done)
        return
    journal.record(load_id, *done, ("marts", "started", None))
    try:
        with journal.watching(load_id, "marts"):
            refresh_marts(spark, warehouse, dates, load_id if fresh else None)
    except Exception:
        if strict:
            raise
        return
    journal.record(load_id, ("marts", "done", None))


def ingest_batch(spark: SparkSession, source: str, warehouse: Warehouse,
                 glob: str | None = None, strict: bool = True) -> str:
    """Load every file below ``source``, whether loaded before or not."""
    load_id = f"full-{uuid.uuid4().hex}"
    load_lines(read_raw(spark, source, glob), warehouse, load_id, strict,
               list_files(spark, source, glob))
    return load_id


# --- upkeep -----------------------------------------------------------------


def compact_events(spark: SparkSession, warehouse: Warehouse, dates: DataFrame) -> None:
    """Rewrite the events of ``dates`` (``event_date``) as few files clustered by team and time.

    Each load appends files to the days it touches; this merges them.
    """
    rewrite_events(on_dates(warehouse.events(spark), dates, "event_date"), warehouse.events_path)


def stale_dates(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Dates (``event_date``) whose states or user mart do not count just the stored events."""
    users = warehouse.mart(spark, "user_summary")
    totals = [_per_date(warehouse.events(spark), "event_date", "held"),
              _per_date(users, "summary_date", "user_summary", "total_events")]
    totals += [_per_date(warehouse.state(spark, s), s.day, s.name, s.total) for s in STATES]
    joined = reduce(lambda a, b: a.join(b, "event_date", "full"), totals)
    same = reduce(lambda a, b: a & b, [
        F.coalesce(F.col("held") == F.col(c), F.lit(False))
        for c in ("user_summary", *(s.name for s in STATES))])
    return joined.filter(~same).select("event_date")


def heal(spark: SparkSession, warehouse: Warehouse) -> None:
    """Rebuild states and marts of every stale date."""
    dates = stored(stale_dates(spark, warehouse), "stale")
    if not dates.isEmpty():
        refresh_marts(spark, warehouse, dates)


def _rebuild(spark: SparkSession, warehouse: Warehouse, dates: DataFrame) -> None:
    update_states(spark, warehouse, dates.withColumn("action", F.lit("rebuild")))
    write_marts(spark, warehouse, dates)


def apply_remap(spark: SparkSession, warehouse: Warehouse, mapping: DataFrame) -> None:
    """Change user ids (``old_id``, ``new_id``) in the stored events and their marts.

    Only dates on which a renamed user occurs are rewritten, and their marts
    are rebuilt from the renamed events, so a later load of such a date keeps
    the new ids of what is stored.  The dates come from the events and from the
    user mart, which is written last: a crash in between leaves the old id in
    one of them, and the repeated call goes on from there.  An id with two
    targets raises, and so does a target that is itself renamed, as that could
    not be repeated.
    """
    moves = mapping.filter("old_id <> new_id")
    chained = moves.join(moves.select(F.col("old_id").alias("new_id")), "new_id", "left_semi")
    if not chained.isEmpty():
        raise ValueError("a new user id is itself renamed; apply such mappings one after the other")
    old = moves.select(F.col("old_id").alias("user_id"))
    events, users = warehouse.events(spark), warehouse.mart(spark, "user_summary")
    # Stored first: the rewrite would otherwise change what the dates are read from.
    dates = stored(
        dates_of(events.join(old, "user_id", "left_semi"), "event_date").union(
            dates_of(users.join(old, "user_id", "left_semi"), "summary_date")).distinct(), "dates")
    if dates.isEmpty():
        return
    rewrite_events(remap_users(on_dates(events, dates, "event_date"), moves), warehouse.events_path)
    _rebuild(spark, warehouse, dates)


def rebuild_marts(spark: SparkSession, warehouse: Warehouse) -> None:
    """Rebuild every state and mart date from all clean events."""
    _rebuild(spark, warehouse, stored(dates_of(warehouse.events(spark), "event_date"), "dates"))
