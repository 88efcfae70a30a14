"""Small literal frames for unit tests."""

import datetime as dt

from eventloom.schema import EVENTS_SCHEMA, FLAGS

BASE = {
    "event_hash": None, "event_type": "Stop", "event_timestamp": "2024-01-30 10:00:00",
    "received_at": None, "user_id": "ann@x.com", "team_id": "default-team", "session_id": "s1",
    "project_name": "web", "tool_name": None, "tool_success": None, "output_length": None,
    "error_message": None, "prompt_length": None, **{f: False for f in FLAGS},
    "stop_reason": None, "raw_data": None, "load_id": None,
}


def events(spark, *rows):
    """Clean events from partial dicts."""
    full = []
    for row in rows:
        values = {**BASE, **row}
        stamp = dt.datetime.fromisoformat(values["event_timestamp"])
        values["event_timestamp"] = stamp
        values["event_date"] = stamp.date()
        full.append(tuple(values[name] for name in EVENTS_SCHEMA.fieldNames()))
    return spark.createDataFrame(full, EVENTS_SCHEMA)


def records(df):
    return [row.asDict() for row in df.collect()]


def one(df):
    rows = records(df)
    assert len(rows) == 1
    return rows[0]


def by(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
