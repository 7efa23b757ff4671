"""What the nearest-neighbour search sends to the driver."""

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import ann


def _vectors(spark, n):
    rng = np.random.default_rng(1)
    return spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(8)]) for i in range(n)], "vec_id bigint, embedding array<float>")


def _broadcast(plan: str) -> list[str]:
    """The parts of a physical plan that lie below a broadcast."""
    lines = plan[plan.index("== Physical Plan ==") :].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    parts = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
            parts.append("\n".join(lines[i:end]))
    return parts


def test_queries_with_their_buckets_are_never_broadcast(spark, monkeypatch):
    plans, real = {}, ann.stored

    def noting(df, label):
        plans[label] = df._jdf.queryExecution().toString()
        return real(df, label)

    monkeypatch.setattr(ann, "stored", noting)
    # In production a row of buckets is many times what Spark takes it for.
    vectors = _vectors(spark, 3000)
    ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0")).collect()
    found = _broadcast(plans["ann-found"])
    assert found and not any("MapInArrow" in part for part in found)


def test_probes_come_a_few_queries_at_a_time(spark):
    import pyarrow as pa

    vectors = _vectors(spark, 200)
    hashing = ann.fit(vectors)
    rows = vectors.withColumnRenamed("vec_id", "query").collect()
    batch = pa.RecordBatch.from_pydict({"query": [r[0] for r in rows], "embedding": [r[1] for r in rows]})
    got = [[len(set(b.column("query").to_pylist())), b.column("query").to_pylist()] for b in ann._probed(hashing, 7)(iter([batch]))]
    assert max(n for n, _ in got) <= 64
    assert sorted({q for _, part in got for q in part}) == list(range(200))


def test_the_sample_is_the_first_vectors_by_hash(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 50)
    vectors = _vectors(spark, 400).repartition(8)
    first = [r[0] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(50).select("vec_id").collect()]
    expected = ann.fit(vectors.filter(F.col("vec_id").isin(first)))
    assert ann.fit(vectors).distance == expected.distance
    assert ann.fit(vectors.limit(0)) is None
