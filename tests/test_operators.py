"""Operators against brute force in plain Python, with groups cut into small chunks and lookups both ways."""

import random

import pytest
from conftest import plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelog.operators import catalog as C
from tidelog.operators import positions as P
from tidelog.operators.ids import assign_ids, next_id
from tidelog.operators.lookup import lookup_join
from tidelog.operators.ordering import order_by_id
from tidelog.operators.resolve import drop_bad_rows, explode_rows, resolve_tables
from tidelog.operators.scan import Running, running
from tidelog.operators.seek import resolve_start, seek_positions
from tidelog.plans.capture import start_position
from tidelog.plans.inventory import inventory_current, log_inventory
from tidelog.schema import ROW_EVENTS

KINDS = ["TABLE_MAP", "WRITE", "UPDATE_V1", "DELETE", "OTHER"]


def log_frame(spark, events):
    """Row events from dicts; what is not given is null."""
    rows = [tuple(e.get(f) for f in ROW_EVENTS.names) for e in events]
    return spark.createDataFrame(rows, ROW_EVENTS)


def random_log(seed, files=4, events=120, rebind=False, untimed=0.15):
    """Events in log order. One file and one table id hold far more than their share."""
    rng = random.Random(seed)
    log, clock = [], 1000
    for file_no in range(1, files + 1):
        pos, count = 4, events * (4 if file_no == 2 else 1)
        for _ in range(count):
            size = rng.randint(1, 40)
            kind = rng.choice(KINDS)
            table_id = rng.choice([7, 7, 7, 8, 9])
            clock += rng.choice([0, 0, 0, 1, 3])
            name = f"t{rng.randint(0, 2)}" if rebind else f"t{table_id}"
            log.append(
                {
                    "log_name": f"log.{file_no:06d}", "file_no": file_no, "start_pos": pos, "end_pos": pos + size,
                    "ts_unix": 0 if rng.random() < untimed else clock + rng.choice([0, 0, 0, -2]),
                    "event_type": kind, "table_id": table_id,
                    "db_name": f"db{file_no % 2}" if kind == "TABLE_MAP" else None,
                    "table_name": name if kind == "TABLE_MAP" else None,
                    "rows": None if kind in ("TABLE_MAP", "OTHER") or rng.random() < 0.1 else [(None, None, None)],
                }
            )
            pos += size
    return log


def test_running_equals_a_plain_scan(spark):
    rng = random.Random(1)
    data = [(k, i, rng.randint(-5, 50) if rng.random() < 0.8 else None) for k in "aab" for i in range(rng.randint(40, 90))]
    data = sorted({(k, i): v for k, i, v in data}.items())
    frame = spark.createDataFrame([(k, i, v) for (k, i), v in data], "k string, i bigint, v bigint")
    for keys in (["k"], []):
        order = [F.col("i"), F.col("k")]
        outputs = {
            "high": Running("max", F.col("v")), "low": Running("min", F.col("v"), inclusive=False),
            "total": Running("sum", F.col("v")), "seen": Running("sum", F.lit(1), inclusive=False),
        }
        got = {(r["k"], r["i"]): r for r in running(frame, keys, F.floor(F.col("i") / 7), order, outputs).collect()}
        assert len(got) == len(data)
        rows = sorted(((k, i), v) for (k, i), v in data)
        for (k, i), v in rows:
            before = [w for (k2, i2), w in rows if (not keys or k2 == k) and (i2, k2) < (i, k)]
            known = [w for w in before if w is not None]
            with_own = known + ([v] if v is not None else [])
            row = got[(k, i)]
            assert row["high"] == max(with_own, default=None)
            assert row["low"] == min(known, default=None)
            assert (row["total"] or 0) == sum(with_own)
            assert row["seen"] == len(before)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_both_ways(spark, setting, how):
    facts = spark.range(500).select((F.col("id") % 7).alias("k"), "id")
    lookup = spark.createDataFrame([(k, f"n{k}") for k in (0, 1, 2, 9)], "k bigint, name string")
    expected = sorted(facts.join(lookup, "k", how).collect())
    assert sorted(lookup_join(facts, lookup, ["k"], how).collect()) == expected
    assert "BroadcastExchange" in plan_of(lookup_join(facts, lookup, ["k"], how))
    setting(broadcastBytes=10, salts=5)
    assert sorted(lookup_join(facts, lookup, ["k"], how, ["id"]).collect()) == expected
    assert "_salt" in plan_of(lookup_join(facts, lookup, ["k"], how))


def expected_tables(log):
    maps, found = {}, []
    for e in log:
        key = e["file_no"], e["table_id"]
        if e["event_type"] == "TABLE_MAP":
            maps[key] = e["db_name"], e["table_name"]
        elif e["rows"] is not None and key in maps:
            found.append((e["file_no"], e["start_pos"], *maps[key]))
    return sorted(found)


@pytest.mark.parametrize("rebind", [False, True])
@pytest.mark.parametrize("limit", [10, 1 << 26])
def test_resolve_tables(spark, setting, rebind, limit):
    setting(chunkBytes=100, broadcastBytes=limit)
    log = random_log(5, rebind=rebind)
    frame = log_frame(spark, log)
    resolved = resolve_tables(frame).select("file_no", "start_pos", "db_name", "table_name")
    expected = expected_tables(log)
    assert sorted(map(tuple, resolved.collect())) == expected
    assert resolved.columns == ["file_no", "start_pos", "db_name", "table_name"]
    # The small case joins by broadcast; large ones look points up where the events are. No event is shuffled.
    large = "ArrowEvalPython" in plan_of(resolved)
    assert large is (limit == 10) or rebind
    assert "rows#" not in " ".join(line for line in plan_of(resolved).splitlines() if "Exchange " in line)
    kept = resolve_tables(frame, "db1", "t?").select("file_no", "start_pos", "db_name", "table_name")
    assert sorted(map(tuple, kept.collect())) == [e for e in expected if e[2] == "db1"]


def test_an_id_bound_anew_keeps_the_broadcast(spark):
    base = {"log_name": "log.000001", "file_no": 1, "ts_unix": 1, "table_id": 5}
    names = ["a", "a", "b", "b", "c"]
    log = []
    for n, name in enumerate(names):
        log.append({**base, "event_type": "TABLE_MAP", "start_pos": 10 * n, "end_pos": 10 * n + 5, "db_name": "d", "table_name": name, "rows": None})
        log.append({**base, "event_type": "WRITE", "start_pos": 10 * n + 5, "end_pos": 10 * n + 10, "rows": [(None, [], None)]})
    resolved = resolve_tables(log_frame(spark, log))
    assert [r["table_name"] for r in resolved.orderBy("start_pos").collect()] == names
    assert "BroadcastHashJoin" in plan_of(resolved) and "ArrowEvalPython" not in plan_of(resolved)


def test_bad_rows_are_skipped_alone(spark):
    rows = [(None, [], None), (None, [], "broken"), (None, [], None)]
    log = [{"event_type": "WRITE", "file_no": 1, "start_pos": 4, "rows": rows}]
    kept = drop_bad_rows(explode_rows(log_frame(spark, log)))
    assert [r["row_index"] for r in kept.orderBy("row_index").collect()] == [0, 2]


def test_catalogs(spark):
    columns = spark.createDataFrame(
        [("d", "t", "b", 2), ("d", "t", "a", 1), ("d", "u", "x", 1), ("e", "t", "c", 10), ("e", "t", "z", 9)],
        "db_name string, table_name string, column_name string, ordinal bigint",
    )
    lists = {(r[0], r[1]): r[2] for r in C.catalog_columns(columns).collect()}
    assert lists == {("d", "t"): ["a", "b"], ("d", "u"): ["x"], ("e", "t"): ["z", "c"]}
    assert C.catalog_columns(columns, "d", "u").collect()[0]["columns"] == ["x"]
    keys = columns.withColumn("constraint_name", F.when(F.col("column_name") == "b", "uq").otherwise("PRIMARY"))
    pks = C.catalog_primary_keys(keys, "d")
    assert {(r[0], r[1]): r[2] for r in pks.collect()} == {("d", "t"): ["a"], ("d", "u"): ["x"]}
    counts = C.catalog_counts(C.catalog_columns(columns), pks).first()
    assert tuple(counts) == (3, 2)
    feed = spark.createDataFrame([("d", "t"), ("q", "t"), ("q", "t")], "db_name string, table_name string")
    assert [tuple(r) for r in C.unknown_tables(feed, C.catalog_columns(columns)).collect()] == [("q", "t")]
    attached = C.attach_primary_keys(feed, pks).collect()
    assert sorted(tuple(r["pk_columns"]) for r in attached) == [(), (), ("a",)]


def first_time(events):
    for e in events:
        if (e["ts_unix"] or 0) > 0:
            return e["ts_unix"]
    return None


def by_file(log):
    files = {}
    for e in log:
        files.setdefault(e["file_no"], []).append(e)
    return files


def expected_position(log, target):
    files = by_file(log)
    crossing = [f for f, events in files.items() if (t := first_time(events)) is not None and t <= target]
    file_no = max(crossing, default=min(files))
    for e in files[file_no]:
        if (e["ts_unix"] or 0) > 0 and e["ts_unix"] >= target:
            return file_no, e["start_pos"]
    return file_no, files[file_no][-1]["end_pos"]


@pytest.mark.parametrize("limit", [10, 1 << 26])
@pytest.mark.parametrize("seed, untimed", [(1, 0.15), (2, 0.9)])
def test_seek_positions(spark, setting, seed, untimed, limit):
    setting(broadcastBytes=limit, salts=3)
    log = random_log(seed, files=5, events=40, untimed=untimed)
    times = [e["ts_unix"] for e in log]
    targets = sorted({0, 1, 10**9, -5, *range(min(t for t in times if t), max(times) + 3, 2)})
    frame = spark.createDataFrame([(t,) for t in targets] + [(None,)], "target_ts bigint")
    got = {r["target_ts"]: (r["file_no"], r["pos"]) for r in seek_positions(log_frame(spark, log), frame).collect()}
    assert got.pop(None) == (None, None)
    assert got == {t: expected_position(log, t) for t in targets}


def test_first_event_times_and_ranges(spark):
    log = random_log(9, files=6, events=30, untimed=0.93)
    frame = log_frame(spark, log)
    firsts = {f: first_time(events) for f, events in by_file(log).items()}
    assert None in firsts.values() and any(firsts.values())
    assert {r["file_no"]: r["first_time"] for r in P.first_event_time(frame).collect()} == firsts
    ranges = {r["file_no"]: r for r in P.file_time_ranges(frame, 99999).collect()}
    for f in firsts:
        assert ranges[f]["start_time"] == firsts[f]
        assert ranges[f]["end_time"] == (99999 if f == 6 else firsts[f + 1])
        assert ranges[f]["is_current"] is (f == 6)
        assert ranges[f]["file_size"] == by_file(log)[f][-1]["end_pos"]


def test_files_overlapping_edges(spark):
    ranges = spark.createDataFrame(
        [("a", 10, 20), ("b", None, 20), ("c", 10, None), ("d", None, None)], "log_name string, start_time bigint, end_time bigint"
    )

    def names(**window):
        return "".join(sorted(r["log_name"] for r in P.files_overlapping(ranges, **window).collect()))

    assert names() == "abcd"
    assert names(since=20) == "abcd" and names(since=21) == "cd"
    assert names(until=10) == "abcd" and names(until=9) == "bd"
    assert names(since=30, until=5) == "d"
    totals = P.inventory_totals(P.log_files(log_frame(spark, [])))
    assert tuple(totals.first()) == (0, 0)


def test_inventory(spark):
    log = random_log(3, files=3, events=10, untimed=0.0)
    frame = log_frame(spark, log)
    rows = log_inventory(frame, 1776420000, since="2026-04-17T10:00:00Z").collect()
    assert [(r["log_name"], r["end_time"], r["is_current"]) for r in rows] == [("log.000003", "2026-04-17T10:00:00Z", True)]
    end = log[-1]["end_pos"]
    assert tuple(inventory_current(frame).first()) == ("log.000003", end, f"log.000003:{end}")
    with pytest.raises(ValueError):
        log_inventory(frame, 0, until="yesterday")
    with pytest.raises(PySparkException):
        P.current_position(log_frame(spark, [])).collect()


def test_files_are_ordered_by_number(spark):
    log = [
        {"log_name": f"log.{n}", "file_no": n, "start_pos": 4, "end_pos": 9, "ts_unix": n, "event_type": "OTHER"}
        for n in (999999, 1000000)
    ]
    assert P.current_position(log_frame(spark, log)).first()["log_name"] == "log.1000000"


def test_event_offsets(spark, setting):
    setting(chunkBytes=64)
    log = random_log(4)
    found = P.event_offsets(log_frame(spark, log).select("file_no", "end_pos"))
    assert sorted(map(tuple, found.collect())) == sorted((e["file_no"], e["end_pos"], e["start_pos"]) for e in log)


def test_from_position(spark):
    log = random_log(4)
    kept = P.from_position(log_frame(spark, log), 2, 500).collect()
    assert sorted((r["file_no"], r["start_pos"]) for r in kept) == [
        (e["file_no"], e["start_pos"]) for e in log if (e["file_no"], e["start_pos"]) >= (2, 500)
    ]


def test_resolve_start(spark):
    log = random_log(6, untimed=0.0)
    frame = log_frame(spark, log)
    here = ("log.000004", 4, log[-1]["end_pos"])
    text = "1970-01-01 00:20:00"
    sought = expected_position(log, 1200)
    cases = [
        ("end", None, here), ("start", None, ("log.000004", 4, 4)), ("log.000002:99", None, ("log.000002", 2, 99)),
        ("bad", None, here), ("log.000002:99", text, (f"log.{sought[0]:06d}", *sought)), ("log.000002:99", "bad", here),
        ("start", "bad", here), ("x:18446744073709551615", None, ("x", None, 18446744073709551615)),
    ]
    specs = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "n int, start_spec string, since string")
    rows = {r["n"]: (r["log_name"], r["file_no"], r["pos"]) for r in resolve_start(specs, frame).collect()}
    assert rows == {i: c[2] for i, c in enumerate(cases)}
    assert start_position(frame, since=text) == sought
    assert start_position(log_frame(spark, [])) is None


def test_assign_ids_in_log_order(spark, setting):
    setting(chunkBytes=50)
    rng = random.Random(2)
    rows = [(e["file_no"], e["start_pos"], i) for e in random_log(8) for i in range(rng.randint(1, 3))]
    shuffled = rng.sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "file_no bigint, start_pos bigint, row_index int")
    numbered = assign_ids(frame, start=11)
    assert [tuple(r) for r in numbered.orderBy("id").collect()] == [(n, *row) for n, row in enumerate(rows, 11)]
    assert next_id(numbered).first()["next_id"] == 11 + len(rows)
    assert next_id(numbered.limit(0)).first()["next_id"] == 1
    # Rows are numbered within their file's chunks; only the chunks' counts, one slim row each, come together.
    plan = plan_of(numbered)
    plan = plan[plan.index("== Physical Plan ==") :].splitlines()
    single = [i for i, line in enumerate(plan) if "SinglePartition" in line]
    assert single and all("HashAggregate" in plan[i + 1] or "Window" in plan[i + 1] for i in single)
    assert not any("row_index" in line for i in single for line in plan[i : i + 2])


@pytest.mark.parametrize("limit", [0, 1, 1000, 1001, 2500, 5000, 5001, None])
def test_order_by_id(spark, monkeypatch, limit):
    monkeypatch.setattr("tidelog.operators.ordering._IDS_PER_BUCKET", 64)
    monkeypatch.setattr("tidelog.operators.ordering._BUCKETS_PER_GROUP", 8)
    frame = spark.range(0, 5000).select((F.col("id") * 3 + 1).alias("id")).orderBy(F.rand(5))
    assert [r["id"] for r in order_by_id(frame, limit).collect()] == [3 * i + 1 for i in range(5000)][:limit]


@pytest.mark.parametrize("limit", [1, 999, 1000, 2001, 9998, 9999, 10000, 10001])
def test_order_by_repeated_ids(spark, limit):
    frame = spark.range(0, 10000).select(F.floor(F.col("id") / 4).alias("id")).orderBy(F.rand(5))
    assert [r["id"] for r in order_by_id(frame, limit).collect()] == [i // 4 for i in range(10000)][:limit]


def test_order_by_id_refuses_negative_limits(spark):
    with pytest.raises(ValueError):
        order_by_id(spark.range(1), -1)
