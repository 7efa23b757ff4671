"""Streams whose parts land in any order, state that stays small, and a store with several or failing writers."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_flows import land, sample, split, stream
from test_operators import expected_tables, log_frame, random_log

from tidelog.operators.catalog import catalog_columns, catalog_primary_keys
from tidelog.plans.capture import capture
from tidelog.schema import CHANGE_EVENTS, TABLE_MAPS
from tidelog.sinks import event_store as S
from tidelog.sources.change_log import read_change_log
from tidelog.sources.event_store import read_event_store, register_event_store, store_commits
from tidelog.streaming.capture import fan_out, log_sink, replay_refused, store_sink
from tidelog.streaming.state import BatchState, resolve_tables_stream, waiting_events

NAMES = ["file_no", "start_pos", "db_name", "table_name"]


def run_batches(spark, parts, state, **options):
    """What each batch gives out."""
    return [
        sorted(map(tuple, resolve_tables_stream(log_frame(spark, part), b, state, **options).select(*NAMES).collect()))
        for b, part in enumerate(parts)
    ]


@pytest.mark.parametrize("limit", [10, 1 << 26])
def test_parts_in_any_order_give_what_the_whole_log_gives(spark, setting, tmp_path, limit):
    setting(chunkBytes=300, broadcastBytes=limit)
    log = random_log(11, files=2, events=60, rebind=True)
    pieces = [log[i : i + 12] for i in range(0, len(log), 12)]
    random.Random(4).shuffle(pieces)
    parts = [sum(pieces[k::3], []) for k in range(3)]
    given = run_batches(spark, parts, str(tmp_path / "state"))
    assert sorted(sum(given, [])) == expected_tables(log)
    # Nothing is settled by a map that a later part may put another in front of.
    landed = set()
    for part, rows in zip(parts, given):
        landed |= {(e["file_no"], e["start_pos"]) for e in part}
        for row in rows:
            own = [e for e in log if e["file_no"] == row[0] and e["start_pos"] <= row[1]]
            table_id = own[-1]["table_id"]
            maps = [i for i, e in enumerate(own) if e["event_type"] == "TABLE_MAP" and e["table_id"] == table_id]
            assert all((e["file_no"], e["start_pos"]) in landed for e in own[maps[-1] :])
    assert waiting_events(spark, str(tmp_path / "state"), 2).count() == 0


def test_a_gap_holds_back_and_can_be_given_up(spark, tmp_path):
    base = {"log_name": "log.000001", "file_no": 1, "ts_unix": 1, "table_id": 5}
    event = lambda kind, pos, **more: {**base, "event_type": kind, "start_pos": pos, "end_pos": pos + 10, **more}
    rows = [(None, [], None)]
    first = [event("TABLE_MAP", 4, db_name="d", table_name="a"), event("WRITE", 14, rows=rows)]
    later = [event("WRITE", 34, rows=rows)]
    gap = [event("TABLE_MAP", 24, db_name="d", table_name="b")]
    parts = [first, later, [], gap]
    assert run_batches(spark, parts, str(tmp_path / "a")) == [[(1, 14, "d", "a")], [], [], [(1, 34, "d", "b")]]
    assert run_batches(spark, [first, later, [], []], str(tmp_path / "b"), give_up_after=2) == [
        [(1, 14, "d", "a")], [], [], [(1, 34, "d", "a")]
    ]
    # A feed that was opened behind the map waits for nothing before that place.
    assert run_batches(spark, [later], str(tmp_path / "c"), start=(1, 34)) == [[]]
    assert waiting_events(spark, str(tmp_path / "c"), 0).count() == 0


def test_state_is_read_from_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidelog.streaming.state.RADIX", 3)
    state = BatchState(spark, str(tmp_path / "state"), TABLE_MAPS)
    for b in range(10):
        state.write(b, spark.createDataFrame([("l", b, 1, 4, "d", "t")], TABLE_MAPS))
        state.write(b, spark.createDataFrame([("l", b, 1, 4, "d", "t")], TABLE_MAPS))  # again, as after a failure
        assert sorted(r["file_no"] for r in state.before(b + 1).collect()) == list(range(b + 1))
    assert [len(state._folders(0, b)) for b in (1, 3, 9, 10, 26, 27, 243, 300)] == [1, 1, 1, 2, 6, 1, 1, 4]
    monkeypatch.setattr("tidelog.streaming.state.RADIX", 8)
    assert max(len(state._folders(0, b)) for b in range(301)) <= 7 * 3


@pytest.fixture(scope="module")
def events(spark):
    log = sample()
    catalogs = log_catalogs(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    capture(log.frame(spark), *catalogs).write.mode("overwrite").parquet(f"{path}/sample-events")
    return spark.read.schema(CHANGE_EVENTS).parquet(f"{path}/sample-events")


def log_catalogs(spark):
    columns = spark.createDataFrame([("d", "t", "a", 1)], "db_name string, table_name string, column_name string, ordinal bigint")
    return catalog_columns(columns), catalog_primary_keys(columns.withColumn("constraint_name", F.lit("PRIMARY")))


def test_writers_that_interleave_share_no_id(spark, events, tmp_path, monkeypatch):
    path, real, inside = str(tmp_path / "store"), S.publish, []

    def publish(session, name, text):
        # Another writer takes the same place in the ledger first.
        if "reserved" in name and not inside:
            inside.append(True)
            S.append_events(events, path, S.FULL, 0, "second")
        return real(session, name, text)

    monkeypatch.setattr(S, "publish", publish)
    S.append_events(events, path, S.FULL, 0, "first")
    store = read_event_store(spark, path).orderBy("id").collect()
    assert [r["id"] for r in store] == list(range(1, 13))
    assert {r["folder"]: (r["first"], r["rows"]) for r in store_commits(spark, path).collect()} == {
        "append=0": (1, 6), "append=1": (7, 6)
    }


@pytest.mark.parametrize("stop_at", ["writers/", "committed"])
def test_a_writer_that_is_stopped_repeats_its_ids(spark, events, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "store")
    S.append_events(events, path, batch_id=0, writer="w")

    def stopping(real):
        def call(session, name, text):
            if stop_at in name:
                raise KeyboardInterrupt
            return real(session, name, text)

        return call

    with monkeypatch.context() as broken:
        broken.setattr(S, "publish", stopping(S.publish))
        broken.setattr(S, "replace", stopping(S.replace))
        with pytest.raises(KeyboardInterrupt):
            S.append_events(events, path, batch_id=1, writer="w")
    # The half-written append is invisible, and its range is nobody else's.
    assert read_event_store(spark, path).count() == 6
    if stop_at == "committed":
        S.append_events(events, path, batch_id=0, writer="other")
    S.append_events(events, path, batch_id=1, writer="w")
    S.append_events(events, path, batch_id=1, writer="w")
    ids = sorted(r["id"] for r in read_event_store(spark, path).collect())
    assert ids == list(range(1, 19 if stop_at == "committed" else 13))


def test_id_bounds_open_only_their_folders_and_sql_reads_the_store(spark, events, tmp_path):
    path = str(tmp_path / "store")
    for _ in range(3):
        S.append_events(events, path)
    some = read_event_store(spark, path, first_id=5, last_id=8)
    assert sorted(r["id"] for r in some.collect()) == [5, 6, 7, 8]
    assert {f.split("append=")[1][0] for f in some.inputFiles()} == {"0", "1"}
    assert read_event_store(spark, path, first_id=99).count() == 0
    register_event_store(spark, path, "kept")
    counts = spark.sql("SELECT operation, count(*) AS n FROM kept GROUP BY operation").collect()
    assert sum(r["n"] for r in counts) == 18
    assert read_event_store(spark, str(tmp_path / "none")).count() == 0


def test_batches_that_the_store_refuses_are_given_again(spark, tmp_path):
    landed, lines, store, refused = (str(tmp_path / n) for n in ("landed", "lines", "store", "refused"))
    calls, real = [], store_sink(store, S.FULL)

    def failing(batch, batch_id):
        calls.append(batch_id)
        if len(calls) in (1, 2):
            raise OSError("disk full")
        real(batch, batch_id)

    for part in split(sample(), 3, 5):
        land(spark, part, landed)
        stream(spark, landed, log_catalogs(spark), fan_out(log_sink(lines), failing, refused=refused), str(tmp_path / "check"))
    assert calls == [0, 0, 0, 1, 2]
    assert read_change_log(spark, lines).count() == 6
    rows = read_event_store(spark, store).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 7))
    assert [json.loads(r["row_data"]) is not None for r in rows] == [True] * 6
    (writer,) = [p.name.split("=")[1] for p in (tmp_path / "refused").iterdir()]
    assert replay_refused(spark, refused, writer, failing) == 0 and len(calls) == 5
