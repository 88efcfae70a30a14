import csv
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventloom.functions.text import last_lines
from eventloom.sources import exports, tables
from eventloom.sources import raw_logs as R
from eventloom.sources.tables import read_table
from eventloom.schema import DAILY_SCHEMA
from eventloom.sources.transcripts import read_transcripts
from eventloom.sources.workdir import fresh_folder, scratch_root
from frames import by, one, records


def put(root, name, *lines):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(line.encode() + b"\n" for line in lines))


def test_provenance_of_every_layout(spark):
    paths = {
        "file:///x/ann/events-2024-01-02.jsonl": ("ann", dt.date(2024, 1, 2)),
        "s3a://b/p/20240103/bob-events-20240103.jsonl": ("bob", dt.date(2024, 1, 3)),
        "s3a://b/p/20240103/b-events-c-events-20240103.jsonl.gz": ("b-events-c", dt.date(2024, 1, 3)),
        "/x/ann/events-2024-01-02.jsonl.gz": ("ann", dt.date(2024, 1, 2)),
        "/out/event_date=2024-01-04/part-0.json": (None, dt.date(2024, 1, 4)),
        "/x/notes.txt": (None, None),
    }
    df = spark.createDataFrame([(p,) for p in paths], "source_file string")
    got = {r.source_file: (r.uploader, r.log_date) for r in R.with_provenance(df).collect()}
    assert got == paths


def test_inventory_of_loaded_and_new_files(spark, tmp_path):
    put(tmp_path, "ann/events-2024-01-01.jsonl", "{}", "", "broken")
    put(tmp_path, "bob/events-2024-01-01.jsonl", "x" * 3000)
    put(tmp_path, "cid/events-2024-01-01.jsonl", "")
    listing, lines = R.list_files(spark, str(tmp_path)), R.read_raw(spark, str(tmp_path))
    ledger = lines.filter("source_file LIKE '%/ann/%'").select("source_file")
    inventory = R.file_inventory(listing, lines, ledger)
    rows = by(R.with_provenance(inventory), "uploader")
    assert (rows["ann"]["event_count"], rows["ann"]["loaded"]) == (3, True)
    assert (rows["bob"]["size_kb"], rows["bob"]["loaded"]) == (2.9, False)
    assert (rows["cid"]["event_count"], rows["cid"]["size_bytes"]) == (1, 1)
    totals = one(R.inventory_totals(inventory))
    assert (totals["files"], totals["event_count"]) == (3, 5)
    assert R.new_files(listing, ledger).count() == 2
    assert R.merge_ledger(ledger, listing.select("source_file")).count() == 3


def test_whole_transcripts(spark, tmp_path):
    put(tmp_path, "a/t1.txt", "one", "two")
    row = one(read_transcripts(spark, str(tmp_path)))
    assert row["value"] == "one\ntwo\n" and row["path"].endswith("a/t1.txt")


def python_tail(text, n=30):
    return " ".join(text.splitlines()[-n:])


@pytest.mark.parametrize("block,tail_bytes", [("128m", 1 << 20), ("64", 1), ("1k", 300), ("37", 200)])
def test_transcript_tails_equal_a_whole_read(spark, tmp_path, block, tail_bytes):
    texts = {
        "long.txt": "".join(f"line {i} {'x' * (i % 9)}\n" for i in range(400)),
        "open_end.txt": "\n".join(f"l{i}" for i in range(90)),
        "blank_end.txt": "a\n" * 40 + "\n\n",
        "short.txt": "one\ntwo", "one_line.txt": "z" * 900, "crlf.txt": "p\r\nq\rr\n" * 25,
        "wide.txt": "".join(f"{'y' * 120}{i}\n" for i in range(50)), "empty.txt": "",
        "unicode.txt": "あ\u2028い\x0bう\n" * 20,
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    with tables.settings(spark, {"spark.sql.files.maxPartitionBytes": block,
                                 "spark.sql.files.openCostInBytes": "1"}):
        found = read_transcripts(spark, str(tmp_path), tail_bytes=tail_bytes)
    tails = found.select("path", last_lines(F.col("value")).alias("tail")).collect()
    got = {r.path.rsplit("/", 1)[1]: r.tail for r in tails}
    assert got == {name: python_tail(text) for name, text in texts.items()}


def test_listing_has_empty_files_and_odd_names(spark, tmp_path):
    put(tmp_path, "k=1/a b%.txt", "x")
    (tmp_path / "k=1" / "none.txt").touch()
    (tmp_path / "skip.log").touch()
    rows = R.list_files(spark, str(tmp_path), "*.txt").collect()
    assert sorted(r.size_bytes for r in rows) == [0, 2]
    lines = R.read_raw(spark, str(tmp_path), "*.txt").select("source_file").collect()
    assert {r.source_file for r in lines} <= {r.source_file for r in rows}


def test_export_keeps_the_order_of_lines(spark, tmp_path):
    for name in ("b", "a"):
        put(tmp_path / "in", f"{name}.jsonl", *[json.dumps({"f": name, "i": i}) for i in range(700)], "{broken")
    with tables.settings(spark, {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1"}):
        exports.export_json(R.read_raw_in_order(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    written = [line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines()]
    assert written == [json.dumps({"f": n, "i": i}) for n in "ab" for i in range(700)]


def test_unwritten_table_reads_as_empty(spark, tmp_path):
    df = read_table(spark, str(tmp_path / "none"), DAILY_SCHEMA)
    assert df.count() == 0 and df.columns == DAILY_SCHEMA.fieldNames()


LINES = [
    json.dumps({"timestamp": "t", "event_type": "PostToolUse", "user_id": "u", "team_id": "x", "project": "p,q",
                "session_id": "s", "tool_name": "Bash", "success": True, "categories": {"command": True}}),
    json.dumps({"event_type": "Stop", "success": None, "categories": None}),
    "{broken", "", "12", "null", "{'event_type':'x'}", '{"event_type":"a"}{"event_type":"b"}',
    '{"event_type":"a"},{"event_type":"b"}', '{"event_type":"a"} tail',
]


def raw(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string")


def test_csv_export(spark, tmp_path):
    exports.export_csv(raw(spark), str(tmp_path / "csv"))
    rows = []
    for part in sorted((tmp_path / "csv").glob("*.csv")):
        with open(part, newline="") as handle:
            rows += list(csv.DictReader(handle))
    assert len(rows) == 2 and len(rows[0]) == 11
    tool, stop = sorted(rows, key=lambda r: r["event_type"])
    assert tool["project"] == "p,q" and tool["success"] == "true" and tool["is_command"] == "true"
    assert stop["user_id"] == "" and stop["success"] == "" and stop["is_mcp"] == "false"


def test_json_export_keeps_readable_lines(spark, tmp_path):
    exports.export_json(raw(spark), str(tmp_path / "json"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "json")).collect()) == sorted([*LINES[:2], "12", "null"])


def test_jsonl_by_day_appends(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "id int, event_date date")
    for _ in range(2):
        exports.write_jsonl_by_day(df, str(tmp_path / "d"))
    back = spark.read.json(str(tmp_path / "d"))
    assert sorted((r.id, r.event_date.day) for r in back.collect()) == [(1, 1), (1, 1), (2, 2), (2, 2)]
    found = R.with_provenance(R.list_files(spark, str(tmp_path / "d"), "*.json"))
    assert {r["log_date"].day for r in records(found)} == {1, 2}


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root.rstrip("/")
    a, b = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert a != b and a.startswith(root)


def test_scratch_folder_without_a_setting():
    from types import SimpleNamespace

    import pytest

    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert scratch_root(session("local[2]")) == scratch_root(session("local[8]"))
    with pytest.raises(RuntimeError):
        scratch_root(session("spark://host:7077"))
