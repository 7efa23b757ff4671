"""The mix against a plain computation of its finish times, with tiny slices and bins, ties and repeated rows."""

import hashlib
import random
from itertools import groupby

import pytest

from tidelog.llm import mixing


def _expected(rows, targets, end):
    """The finish time of each copy that is taken, with its row, in the order of the mix."""
    found = []
    for source, (source_no, source_size, target) in targets.items():
        own = [(hashlib.md5(str(i).encode()).hexdigest(), len((t or "").split()), (i, s, t)) for i, s, t in rows if s == source]
        own.sort(key=lambda x: x[:2])
        played = 0
        for (place, size), peers in groupby(own, key=lambda x: x[:2]):
            peers = list(peers)
            played += size * len(peers)  # equal places and sizes finish together
            for epoch in range(mixing.MAX_EPOCHS):
                at = ((played + epoch * source_size) / target, source_no, place) if target else None
                if size and at and at <= tuple(end):
                    found += [(at, row) for _, _, row in peers]
    return sorted(found, key=lambda x: x[0])


@pytest.mark.parametrize("per_slice, bins", [(20_000, 256), (7, 3), (3, 40)])
def test_order_of_the_mix(spark, monkeypatch, per_slice, bins):
    monkeypatch.setattr(mixing, "ROWS_PER_SLICE", per_slice)
    monkeypatch.setattr(mixing, "LEAST_BINS", bins)
    rng = random.Random(5)
    rows = []
    for i in range(120):
        text = rng.choice([None, "", " ".join(["w"] * rng.randint(1, 60))])
        rows.append((rng.choice([i, i // 2]), rng.choice(["a", "a", "a", "b", "c"]), text))
    rows += [(500, "a", "x y z")] * 9 + [(501, "b", "u v")] * 4 + [(501, "b", "p q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(4)
    narrow = mixing.stored(mixing._narrow(mixing.as_rows(docs)), "sizes")
    mix = mixing.plan_mix(narrow)
    targets = {r["source"]: (r["source_no"], r["source_size"], r["target"]) for r in mix.sources.collect()}
    expected = _expected(rows, targets, mix.end)
    found = [tuple(r) for r in mixing.mixed_documents(docs).collect()]
    assert len(found) == len(expected) > len(rows) / 2
    at = 0
    for _, group in groupby(expected, key=lambda x: x[0]):
        own = [row for _, row in group]
        assert sorted(found[at : at + len(own)]) == sorted(own)
        at += len(own)


def test_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * i) for i in range(40)], "doc_id bigint, source string, text string")
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
