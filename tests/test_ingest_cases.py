"""The end-to-end load cases hold what they name."""

from pyspark.sql import functions as F

from eventloom.plans import ingest_cases
from eventloom.sources.raw_logs import read_raw

EVENTS = """event_id long, ts timestamp, user_id long, event_type string, props string, value double"""


def test_dedup_case_has_every_kind_of_copy(spark, tmp_path, monkeypatch):
    rows = [(k, f"2024-01-{1 + k % 3:02d} 05:00:00", k % 4, ("click", "view", "signup", "error")[k % 4],
             f'{{"k":{k}}}', k / 2) for k in range(24)]
    spark.createDataFrame(rows, EVENTS.replace("timestamp", "string")).withColumn(
        "ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "events.parquet"))
    cases = []

    class Seen(ingest_cases.LoadCase):
        def __init__(self, *args):
            super().__init__(*args)
            cases.append(self)

    monkeypatch.setattr(ingest_cases, "LoadCase", Seen)
    got = ingest_cases.ingest_dedup(spark, str(tmp_path))
    assert sorted(r.event_id for r in got.collect()) == list(range(24))

    load_of = {r.source_file: r.load_id for r in cases[0].warehouse.raw(spark).select(
        "source_file", "load_id").distinct().collect()}
    lines = read_raw(spark, cases[0].source).withColumn("seq", F.get_json_object("value", "$.seq").cast("int")).collect()
    for event in range(24):
        loads = {}
        for r in lines:
            if r.seq == event:
                loads.setdefault(load_of[r.source_file], {}).setdefault(r.value, []).append(r.source_file)
        first = max(loads.values(), key=len)
        assert len(loads) == 2 and len(first) == 2  # a later load; other key order
        files = max(first.values(), key=len)
        assert len(set(files)) == 2 and len(files) == 3  # in another file; twice in one
