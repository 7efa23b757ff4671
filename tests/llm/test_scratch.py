"""What the pipeline's stages leave on disk and shuffle: scratch tables go, texts stay where they are."""

import os

import pytest
from conftest import plan_of
from pyspark.sql import Row

from tidelog.llm import mixing, near
from tidelog.llm.common import settled, stored


def folder_of(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_tables_on_the_way_are_deleted(spark):
    folders = []

    def inner():
        passed = stored(spark.range(7), "a")
        folders.append(folder_of(passed))
        return passed.filter("id > 1")

    def outer():
        kept = settled(inner, "b")
        assert not os.path.exists(folders[0]) and kept.count() == 5
        folders.append(folder_of(kept))
        return kept.filter("id > 2")

    found = settled(outer, "c")
    assert sorted(r.id for r in found.collect()) == [3, 4, 5, 6]
    assert not any(map(os.path.exists, folders)) and os.path.exists(folder_of(found))


def test_nothing_is_deleted_outside(spark):
    first = stored(spark.range(3), "a")
    settled(lambda: stored(first.filter("id > 0"), "b"), "c")
    assert first.count() == 3


WORDS = [f"w{i}" for i in range(60)]
DOCS = [
    *[(i, " ".join(WORDS)) for i in (5, 3, 3, 9)],
    (2, " ".join([*WORDS[:59], "x"])),
    (None, "alone but for its copies here now"), (None, "alone but for its copies here now"),
    (7, "some text that nothing else is like"), (8, None), (4, ""),
]


@pytest.mark.parametrize("most", [0, 64 << 20])
def test_equal_rows_and_copies_leave_one_row(spark, setting, most):
    setting(broadcastBytes=most)
    docs = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in DOCS], "doc_id bigint, text string")
    kept = sorted(near.without_near_copies(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.doc_id for r in kept] == [2, 4, 7, None]


@pytest.mark.parametrize("stage", [near.without_near_copies, mixing.mixed_documents])
def test_texts_are_not_shuffled_to_be_looked_up(spark, stage):
    docs = spark.createDataFrame([Row(doc_id=i, text=t, source="s") for i, t in DOCS], "doc_id bigint, text string, source string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(stage(docs)).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
