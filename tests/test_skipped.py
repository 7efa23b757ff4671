"""What a capture leaves out, counted by the run itself, and ids that come from headers."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_flows import sample
from test_stream_state import log_catalogs

from samples import log as L
from samples.queries import _catalogs
from tidelog.operators.ids import assign_ids
from tidelog.operators.resolve import rejected_rows, skipped_counts
from tidelog.plans.capture import Skipped, capture, numbered_capture

PLACE = ["file_no", "start_pos", "row_index"]


def test_a_capture_counts_what_it_leaves_out(spark, sf, tmp_path):
    # Without the maps of one table id some events have none.
    log = L.row_events(spark, sf).filter(~((F.col("event_type") == "TABLE_MAP") & (F.col("table_id") == 103)))
    skipped = Skipped()
    events = capture(log, *_catalogs(spark, sf), skipped=skipped)
    events.write.parquet(str(tmp_path / "events"))
    counts = skipped.counts()
    expected = skipped_counts(log).first()
    assert counts["rows_events"] == expected["rows_events"]
    assert counts["rows_events"] - counts["bound_events"] == expected["unbound_events"] > 0
    assert counts["bad_rows"] == expected["bad_rows"] > 0
    rejects = rejected_rows(log)
    by_kind = {r["kind"]: r["count"] for r in rejects.groupBy((F.col("error") == "no table map").alias("kind")).count().collect()}
    assert by_kind == {True: expected["unbound_events"], False: expected["bad_rows"]}


@pytest.mark.parametrize("limit, chunk", [(1, 5000), (1 << 26, 1 << 26)])
def test_numbered_capture(spark, setting, sf, limit, chunk):
    setting(broadcastBytes=limit, chunkBytes=chunk)
    log, catalogs = L.row_events(spark, sf), _catalogs(spark, sf)
    total, numbered = numbered_capture(log, *catalogs, databases="app_*")
    plain = assign_ids(capture(log, *catalogs, databases="app_*"))
    expected = {tuple(r[c] for c in PLACE): (r["id"], r["row"]) for r in plain.collect()}
    rows = numbered.collect()
    assert len(rows) == total == len(expected)
    assert {tuple(r[c] for c in PLACE): (r["id"], r["row"]) for r in rows} == expected


def test_rows_are_read_once_and_stay_in_place(spark, sf):
    log, catalogs = L.row_events(spark, sf), _catalogs(spark, sf)
    _, numbered = numbered_capture(log, *catalogs)
    plan = plan_of(numbered)
    plan = plan[plan.index("== Physical Plan ==") :]
    assert plan.count("before:array") == 1
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert not any("start_pos" in line or "row_index" in line for line in shuffles)


def test_an_empty_log(spark):
    frame = sample().frame(spark).limit(0)
    total, numbered = numbered_capture(frame, *log_catalogs(spark))
    assert total == 0 and numbered.collect() == [] and rejected_rows(frame).collect() == []
