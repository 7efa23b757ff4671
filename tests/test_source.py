"""The log as a stream of positions."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_operators import expected_tables, log_frame, random_log

from tidelog.streaming.source import _source, events_of, read_segments
from tidelog.streaming.state import resolve_tables_stream


def land(spark, events, path, mode="append"):
    frame = log_frame(spark, events).repartition("file_no").sortWithinPartitions("file_no", "start_pos")
    frame.write.mode(mode).partitionBy("file_no").parquet(path)


def reader(path, start="end", max_files=1000):
    made = _source()(options={"path": path, "start": start, "max_files": str(max_files)})
    return made.simpleStreamReader(None)


def test_offsets_stop_at_gaps_and_open_no_earlier_file(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    log = random_log(3, files=4, events=30)
    by_file = {f: [e for e in log if e["file_no"] == f] for f in range(1, 5)}
    half = {f: by_file[f][: len(by_file[f]) // 2] for f in by_file}
    land(spark, by_file[1] + by_file[2] + half[3], path)
    source = reader(path)
    opened = []
    monkeypatch.setattr(type(source), "_landed", lambda self, f, real=type(source)._landed: opened.append(f) or real(self, f))
    begin = source.initialOffset()
    assert begin == {"file_no": 3, "pos": half[3][-1]["end_pos"]}
    rows, end = source.read(begin)
    assert (list(rows), end) == ([], begin)
    # A part lands that leaves a gap, and the next file: the offset waits.
    rest = by_file[3][len(half[3]) :]
    land(spark, rest[5:] + by_file[4], path)
    assert source.read(begin)[1] == begin
    land(spark, rest[:5], path)
    rows, end = source.read(begin)
    assert end == {"file_no": 4, "pos": by_file[4][-1]["end_pos"]}
    assert list(rows) == [(3, begin["pos"], None), (4, 4, end["pos"])]
    assert list(source.readBetweenOffsets(begin, end)) == [(3, begin["pos"], None), (4, 4, end["pos"])]
    assert min(opened) == 3
    assert reader(path, "start").initialOffset() == {"file_no": 4, "pos": 4}
    first = reader(path, "1:4", max_files=2)
    assert first.initialOffset() == {"file_no": 1, "pos": 4}
    assert first.read({"file_no": 1, "pos": 4})[1] == {"file_no": 2, "pos": by_file[2][-1]["end_pos"]}
    assert reader(str(tmp_path / "none")).initialOffset() == {"file_no": 0, "pos": 4}


@pytest.mark.parametrize("position", [(1, 4), (2, 300)])
def test_a_stream_from_a_position_reads_on(spark, tmp_path, position):
    path, out, check = (str(tmp_path / n) for n in ("log", "out", "check"))
    log = random_log(8, files=3, events=20)
    cut = len(log) // 2
    seen = []

    def run(segments, batch_id):
        events, begins = events_of(spark, path, segments)
        seen.append(sorted({f.split("file_no=")[1].split("/")[0] for f in events.inputFiles()}) if begins else [])
        found = resolve_tables_stream(events, batch_id, str(tmp_path / "state"), start=position)
        found.select("file_no", "start_pos", "db_name", "table_name").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def go():
        stream = read_segments(spark, path, position)
        query = stream.writeStream.foreachBatch(run).option("checkpointLocation", check).start()
        query.processAllAvailable()
        query.stop()

    for part in (log[:cut], log[cut:]):
        land(spark, part, path)
        go()
    expected = expected_tables([e for e in log if (e["file_no"], e["start_pos"]) >= position])
    got = spark.read.parquet(out).drop("batch")
    assert sorted(map(tuple, got.collect())) == expected
    assert all(int(f) >= position[0] for files in seen for f in files)
    # The second start goes on in the file where the first one stopped.
    assert seen[-1][0] == str(log[cut]["file_no"]) or seen[-1][0] == str(log[cut - 1]["file_no"])
    assert got.select(F.count_distinct("file_no", "start_pos")).first()[0] == len(expected)


def test_an_append_under_way_is_not_read(spark, tmp_path):
    """Files of a committing job show in any order: a later log file before the rest of an earlier one."""
    path, rest = (str(tmp_path / n) for n in ("log", "rest"))
    log = random_log(3, files=3, events=30)
    first = [e for e in log if e["file_no"] == 1][:10]
    land(spark, first, path)
    land(spark, log[10:], rest)
    source = reader(path)
    begin = source.initialOffset()
    assert begin == {"file_no": 1, "pos": first[-1]["end_pos"]}
    (tmp_path / "log" / "_temporary").mkdir()
    shutil.copytree(f"{rest}/file_no=3", f"{path}/file_no=3")
    rows, end = source.read(begin)
    assert (list(rows), end) == ([], begin)
    shutil.copytree(f"{rest}/file_no=1", f"{path}/file_no=1", dirs_exist_ok=True)
    shutil.copytree(f"{rest}/file_no=2", f"{path}/file_no=2")
    (tmp_path / "log" / "_temporary").rmdir()
    rows, end = source.read(begin)
    assert [r[0] for r in rows] == [1, 2, 3] and end == {"file_no": 3, "pos": log[-1]["end_pos"]}


def test_an_append_that_ends_during_the_look_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    log = random_log(3, files=3, events=30)
    land(spark, log, path)
    source = reader(path, "1:4")
    begin = source.initialOffset()
    reached = type(source)._reached

    def slow(self, start):
        end = reached(self, start)
        os.utime(f"{path}/_SUCCESS", ns=(1, 1))
        return end

    with monkeypatch.context() as patch:
        patch.setattr(type(source), "_reached", slow)
        assert source.read(begin)[1] == begin
    assert source.read(begin)[1] == {"file_no": 3, "pos": log[-1]["end_pos"]}
