"""As-of lookups and stretches of log against plain loops, with chunks made tiny."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidelog.operators.asof import asof_join
from tidelog.operators.coverage import in_island, islands


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit, chunk", [(1, 50), (1, 1 << 26), (1 << 26, 50)])
def test_asof_join(spark, setting, how, limit, chunk):
    setting(broadcastBytes=limit, chunkBytes=chunk)
    rng = random.Random(7)
    points = sorted({(f, k, rng.randint(0, 400)) for f in (1, 2) for k in (5, 6) for _ in range(7 if f == 1 else 3)})
    named = [(*p, f"n{i}" if i % 5 else None, i) for i, p in enumerate(points)]
    facts = [(rng.choice([1, 1, 2, 3]), rng.choice([5, 6, 7, None]), rng.choice([*range(0, 900, 7), *[p[2] for p in points]]), f"x{i}") for i in range(300)]
    expected = []
    for f, k, pos, tag in facts:
        before = [p for p in named if p[:2] == (f, k) and p[2] < pos]
        if before or how == "left":
            expected.append((f, k, pos, tag, *(max(before, key=lambda p: p[2])[3:] if before else (None, None))))
    left = spark.createDataFrame(facts, "file_no bigint, k int, start_pos bigint, tag string")
    right = spark.createDataFrame(named, "file_no bigint, k int, from_pos bigint, name string, nr bigint")
    found = asof_join(left, right, ["file_no", "k"], ["name", "nr"], how)
    assert found.columns == ["file_no", "k", "start_pos", "tag", "name", "nr"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    plan = plan_of(found)
    assert ("ArrowEvalPython" in plan) is (limit == 1)
    # What the lookup does not need stays in the JVM, in place: the call has three arguments, and no fact is shuffled.
    assert "Exchange hash" not in plan[plan.index("== Physical Plan ==") :] or limit > 1


def test_wanted_points_hide_the_others(spark, setting):
    points = spark.createDataFrame([(1, 0, "a"), (1, 10, "b"), (1, 20, "a")], "file_no bigint, from_pos bigint, name string")
    facts = spark.createDataFrame([(1, p) for p in (5, 15, 25)], "file_no bigint, start_pos bigint")
    for limit in (1, 1 << 26):
        setting(broadcastBytes=limit)
        found = asof_join(facts, points, ["file_no"], ["name"], wanted=F.col("name") == "a")
        assert sorted(r["start_pos"] for r in found.collect()) == [5, 25]


def test_islands(spark, setting):
    setting(chunkBytes=40)
    rng = random.Random(3)
    events = []
    for f in (1, 2):
        pos = 4
        for _ in range(120):
            size = rng.randint(1, 30)
            if rng.random() < 0.85:
                events.append((f, pos, pos + size))
            pos += size
    events += events[10:14] + [(2, 4, 300)]
    expected = []
    for f, start, end in sorted(events):
        if expected and expected[-1][0] == f and start <= expected[-1][2]:
            expected[-1][2] = max(expected[-1][2], end)
        else:
            expected.append([f, start, end])
    rng.shuffle(events)
    frame = spark.createDataFrame(events, "file_no bigint, start_pos bigint, end_pos bigint")
    found = islands(frame)
    assert sorted(map(list, found.collect())) == expected
    for limit in (1, 1 << 26):
        setting(broadcastBytes=limit)
        placed = {(r["file_no"], r["start_pos"]): r["island"] for r in in_island(frame, found).collect()}
        for (f, start), island in placed.items():
            assert island == next(i[1] for i in expected if i[0] == f and i[1] <= start < i[2])
