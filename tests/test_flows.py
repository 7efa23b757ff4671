"""Capture, sinks, exports and streams end to end on small hand-made logs."""

import json
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidelog.plans.capture import capture, replay_since
from tidelog.plans.export import export_events, export_filter
from tidelog.schema import CELL, EVENT_STORE, ROW_EVENTS
from tidelog.sinks.change_log import at_or_above_level, change_log_lines, write_change_log
from tidelog.sinks.event_store import FULL, append_events
from tidelog.sinks.export import export_csv, export_json
from tidelog.sources.change_log import read_change_log
from tidelog.sources.event_store import read_event_store
from tidelog.sources.tables import read_row_events
from tidelog.streaming.capture import capture_stream, fan_out, log_sink, start_from, store_sink, table_sink

DRAIN = {"availableNow": True}


def cell(value):
    kind, field = {int: ("int", "i"), str: ("bytes", "b"), type(None): ("null", None)}[type(value)]
    value = value.encode() if kind == "bytes" else value
    return tuple(kind if f == "kind" else value if f == field else None for f in CELL.names)


def image(*values):
    return [cell(v) for v in values]


class Log:
    """Builds row events one after the other."""

    def __init__(self, file_no=1, clock=1776420000):
        self.file_no, self.clock, self.pos, self.events = file_no, clock, 4, []

    def add(self, event_type, table_id=1, db=None, table=None, rows=None):
        row = {
            "log_name": f"log.{self.file_no:06d}", "file_no": self.file_no, "start_pos": self.pos, "end_pos": self.pos + 10,
            "ts_unix": self.clock, "event_type": event_type, "table_id": table_id, "db_name": db, "table_name": table, "rows": rows,
        }
        self.events.append(tuple(row[f] for f in ROW_EVENTS.names))
        self.pos += 10
        self.clock += 1
        return self

    def table(self, table_id, db, table):
        return self.add("TABLE_MAP", table_id, db, table)

    def insert(self, table_id, *rows):
        return self.add("WRITE", table_id, rows=[(None, image(*r), None) for r in rows])

    def update(self, table_id, before, after):
        return self.add("UPDATE", table_id, rows=[(image(*before), image(*after), None)])

    def delete(self, table_id, row):
        return self.add("DELETE_V1", table_id, rows=[(image(*row), None, None)])

    def frame(self, spark):
        return spark.createDataFrame(self.events, ROW_EVENTS)


@pytest.fixture
def catalogs(spark):
    names = [("depot", "parcels", ["id", "label", "grams"]), ("depot", "routes", ["id", "code"])]
    columns = spark.createDataFrame(names, "db_name string, table_name string, columns array<string>")
    keys = spark.createDataFrame([("depot", "parcels", ["id"])], "db_name string, table_name string, pk_columns array<string>")
    return columns, keys


def sample():
    log = Log().table(1, "depot", "parcels").insert(1, (1, "crate", 310), (2, "tube", 260))
    log.update(1, (2, "tube", 260), (2, "tube", 275)).delete(1, (1, "crate", 310))
    return log.table(2, "depot", "routes").insert(2, (7, "x")).table(3, "loan_7", "spare").insert(3, (5, None))


def parsed(events):
    rows = events.orderBy("file_no", "start_pos", "row_index").collect()
    return [{**r.asDict(), "primary_key": json.loads(r["primary_key"]), "row": json.loads(r["row"])} for r in rows]


def test_capture(spark, catalogs):
    events = parsed(capture(sample().frame(spark), *catalogs))
    assert [(e["operation"], e["table"], e["primary_key"]) for e in events] == [
        ("INSERT", "parcels", 1), ("INSERT", "parcels", 2), ("UPDATE", "parcels", 2), ("DELETE", "parcels", 1),
        ("INSERT", "routes", 7), ("INSERT", "spare", None),
    ]
    assert events[0]["row"] == {"values": {"id": 1, "label": "crate", "grams": 310}}
    assert events[2]["row"]["before_values"]["grams"] == 260 and events[2]["row"]["after_values"]["grams"] == 275
    assert events[3]["row"]["values"]["label"] == "crate"
    assert events[5]["row"] == {"values": {"col_0": 5, "col_1": None}}
    assert events[0]["pk_columns"] == ["id"] and events[4]["pk_columns"] is None
    assert events[0]["timestamp"] == "2026-04-17T10:00:01+00:00" and events[0]["event_time"] == 1776420001


@pytest.mark.parametrize(
    "lists, tables", [({"tables": "parcels"}, {"parcels"}), ({"databases": "lo*_?"}, {"spare"}), ({"tables": "p?rc*"}, {"parcels"})]
)
def test_capture_filters(spark, catalogs, lists, tables):
    assert {e["table"] for e in parsed(capture(sample().frame(spark), *catalogs, **lists))} == tables


def test_capture_beyond_the_broadcast_limit(spark, catalogs, setting):
    frame = sample().frame(spark)
    expected = parsed(capture(frame, *catalogs))
    setting(broadcastBytes=1, chunkBytes=20, salts=3)
    spread = capture(frame, *catalogs)
    physical = spread._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in physical and "BroadcastHashJoin" not in physical
    assert parsed(spread) == expected


def test_capture_does_not_shuffle_events(spark, sf):
    from samples import queries as Q

    plan = Q.q_capture(spark, sf)._jdf.queryExecution().executedPlan().toString()
    payload = next(line for line in plan.splitlines() if "FileScan" in line and "rows:array" in line.replace(" ", ""))
    above = plan[: plan.index(payload)]
    depth = len(payload) - len(payload.lstrip(" :+-"))
    ancestors = []
    for line in reversed(above.splitlines()):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            ancestors.append(line)
            depth = indent
    assert not any("Exchange" in line for line in ancestors)
    assert any("BroadcastHashJoin" in line for line in ancestors)


def test_replay_starts_at_the_position(spark, catalogs):
    frame = sample().frame(spark)
    events = parsed(replay_since(frame, *catalogs, since="2026-04-17T10:00:04Z"))
    # The maps of table 1 lie before the position.
    assert [e["table"] for e in events] == ["routes", "spare"]
    assert replay_since(frame, *catalogs).count() == 0
    assert replay_since(frame, *catalogs, start_spec="log.000001:4").count() == 6


# Change log


def test_lines_and_back(spark, catalogs, tmp_path):
    log = Log().table(1, "depot", "parcels").insert(1, ("42", 'q"\n', 1)).update(1, (42, "a", 1), (42, "b", 2))
    keys = spark.createDataFrame([("depot", "parcels", ["grams", "id"])], "db_name string, table_name string, pk_columns array<string>")
    events = capture(log.frame(spark), catalogs[0], keys)
    single = capture(log.frame(spark), *catalogs)
    path = str(tmp_path / "log")
    write_change_log(events.unionByName(single), path)
    spark.createDataFrame([('{"time":"t","level":"INFO","message":"started"}',), ("no json",), ("",)], "v string").write.mode("append").text(path)

    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect() if r["value"].startswith('{"time"')]
    first = next(v for v in lines if v.get("operation") == "INSERT")
    assert list(first) == ["time", "level", "timestamp", "event_time", "operation", "database", "table", "pk_columns", "primary_key", "row"]
    assert first["level"] == "INFO" and first["time"].endswith("Z") and first["row"]["values"]["label"] == 'q"\n'

    back = read_change_log(spark, path)
    assert {r["primary_key"] for r in back.collect()} == {'{"grams":1,"id":"42"}', '{"grams":2,"id":42}', '"42"', "42"}
    same = ["timestamp", "event_time", "operation", "database", "table", "pk_columns", "primary_key", "row"]
    assert back.select(*same).exceptAll(events.unionByName(single).select(*same)).count() == 0


def test_levels(spark, catalogs):
    events = capture(sample().frame(spark), *catalogs)
    assert [change_log_lines(events, level).count() for level in ("debug", "INFO", "other", "warn", "Warning", "error")] == [6, 6, 6, 0, 0, 0]
    lines = spark.createDataFrame([("DEBUG",), ("warning",), ("Error",), ("?",)], "level string")
    assert [r["level"] for r in at_or_above_level(lines, "warn").collect()] == ["warning", "Error"]


# Store and export


def test_store_ids_resume_and_retries_repeat(spark, catalogs, tmp_path):
    path = str(tmp_path / "store")
    events = capture(sample().frame(spark), *catalogs)
    append_events(events, path, FULL)
    append_events(events.limit(0), path)
    append_events(events, path)
    append_events(events.filter("table = 'parcels'"), path, batch_id=5, writer="other")
    append_events(events, path, batch_id=5, writer="other")
    store = read_event_store(spark, path)
    rows = store.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 19))
    assert store.columns == EVENT_STORE.names
    assert [r["operation"] for r in rows[:4]] == ["INSERT", "INSERT", "UPDATE", "DELETE"]
    assert json.loads(rows[0]["row_data"])["values"]["label"] == "crate" and rows[6]["row_data"] is None
    assert (rows[0]["primary_key"], rows[5]["primary_key"]) == ("1", "null")
    assert rows[0]["event_time"].endswith("+00:00") and rows[0]["captured_at"].endswith("+00:00")


def stored(spark):
    texts = ["plain", "a,b", 'say "x"', "two\nlines", "cr\rhere", " blanks ", "#", "\\", "", None]
    rows = [(i, "c", "e", "INSERT" if i % 2 else "DELETE", "d", "t", '"k"', text) for i, text in enumerate(texts, 1)]
    return spark.createDataFrame(rows, EVENT_STORE)


def test_export_csv_bytes(spark, tmp_path):
    export_csv(export_events(stored(spark)).coalesce(1), str(tmp_path / "csv"))
    (part,) = Path(tmp_path / "csv").glob("part-*")
    fields = ["plain", '"a,b"', '"say ""x"""', '"two\nlines"', '"cr\rhere"', " blanks ", "#", "\\", "", ""]
    lines = [f'{i},c,e,{"INSERT" if i % 2 else "DELETE"},d,t,"""k""",{f}\n' for i, f in enumerate(fields, 1)]
    assert part.read_bytes().decode() == ",".join(EVENT_STORE.names) + "\n" + "".join(lines)


def test_export_empty_csv_has_a_header(spark, tmp_path):
    export_csv(export_events(stored(spark), limit=0), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in Path(tmp_path / "csv").glob("part-*"))
    assert text == ",".join(EVENT_STORE.names) + "\n"


def test_export_json(spark, tmp_path):
    export_json(export_events(stored(spark), operation="DELETE").coalesce(1), str(tmp_path / "json"))
    (part,) = Path(tmp_path / "json").glob("part-*")
    rows = [json.loads(line) for line in part.read_text().splitlines()]
    assert [r["id"] for r in rows] == [2, 4, 6, 8, 10]
    assert list(rows[4]) == EVENT_STORE.names and rows[4]["row_data"] is None and rows[0]["primary_key"] == '"k"'


def test_export_filters(spark, tmp_path):
    stored(spark).write.parquet(f"{tmp_path}/s")
    store = spark.read.schema(EVENT_STORE).parquet(f"{tmp_path}/s")
    filtered = export_filter(store, "d", "t'x", "INSERT")
    assert "EqualTo(table_name,t'x)" in plan_of(filtered) and filtered.count() == 0
    with pytest.raises(ValueError):
        export_filter(store, operation="insert")


# Streams


def land(spark, log, path):
    log.frame(spark).coalesce(1).write.mode("append").parquet(path)


def split(log, *cuts):
    """The events of a log in several parts."""
    bounds = [0, *cuts, len(log.events)]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        part = Log(log.file_no)
        part.events = log.events[low:high]
        parts.append(part)
    return parts


def stream(spark, path, catalogs, sink, checkpoint, **options):
    source = start_from(read_row_events(spark, path, stream=True, max_files=1), options.pop("position", None))
    capture_stream(source, *catalogs, sink, checkpoint, trigger=DRAIN, **options).awaitTermination()


def test_stream_equals_batch_across_restarts(spark, catalogs, tmp_path, monkeypatch):
    monkeypatch.setattr("tidelog.streaming.state.RADIX", 2)
    landed, out, store, check = (str(tmp_path / n) for n in ("landed", "out", "store", "check"))
    log = sample().insert(1, (8, "late", 1)).update(2, (7, "x"), (7, "y"))
    expected = parsed(capture(log.frame(spark), *catalogs))
    for part in split(log, 1, 3, 6, 9):
        land(spark, part, landed)
        stream(spark, landed, catalogs, fan_out(table_sink(out), store_sink(store, FULL)), check)
    events = spark.read.parquet(out).drop("writer", "batch_id")
    assert parsed(events) == expected
    rows = read_event_store(spark, store).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, len(expected) + 1))
    assert [json.loads(r["row_data"]) for r in rows] == [e["row"] for e in expected]
    # A new query over the same store counts on and leaves the stored batches alone.
    stream(spark, landed, catalogs, store_sink(store), str(tmp_path / "check2"))
    ids = [r["id"] for r in read_event_store(spark, store).orderBy("id").collect()]
    assert ids == list(range(1, 2 * len(expected) + 1))


def test_stream_store_failure_does_not_stop_the_log(spark, catalogs, tmp_path):
    def broken(events, batch_id):
        raise OSError("disk full")

    landed, lines = str(tmp_path / "landed"), str(tmp_path / "lines")
    land(spark, sample(), landed)
    stream(spark, landed, catalogs, fan_out(log_sink(lines), broken), str(tmp_path / "check"))
    assert read_change_log(spark, lines).count() == 6
    with pytest.raises(Exception, match="disk full"):
        stream(spark, landed, catalogs, fan_out(log_sink(lines), broken, fail_on_store_error=True), str(tmp_path / "check2"))


def test_stream_loads_each_new_table_once(spark, catalogs, tmp_path):
    asked = []

    def load(tables):
        asked.extend(tuple(r) for r in tables.collect())
        new = spark.createDataFrame([("loan_7", "spare", ["id", "b"])], "db_name string, table_name string, columns array<string>")
        return new, catalogs[1].limit(0)

    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    log = sample().insert(3, (6, "again")).table(4, "loan_7", "bare").insert(4, (1,)).insert(4, (2,))
    for part in split(log, 8, 9, 11):
        land(spark, part, landed)
        stream(spark, landed, catalogs, table_sink(out), str(tmp_path / "check"), load=load)
    assert sorted(asked) == [("loan_7", "bare"), ("loan_7", "spare")]
    events = parsed(spark.read.parquet(out).drop("writer", "batch_id"))
    assert [e["primary_key"] for e in events if e["table"] == "spare"] == [5, 6]
    assert [e["row"]["values"] for e in events if e["table"] == "bare"] == [{"col_0": 1}, {"col_0": 2}]


def test_stream_from_a_position(spark, catalogs, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    log = sample()
    land(spark, log, landed)
    stream(spark, landed, catalogs, table_sink(out), str(tmp_path / "check"), position=(1, 44))
    assert [e["table"] for e in parsed(spark.read.parquet(out).drop("writer", "batch_id"))] == ["routes", "spare"]
