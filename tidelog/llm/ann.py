"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by K random projections (Gaussian, so 2-stable), each cut into slots of one width; the slots
together are the bucket. For a neighbour at the distance that is usual in the data, the projections' differences are
normal, so the chance that it lies in a given bucket near the query's is a product of slot probabilities. A query visits
buckets in the order of that chance, until the chances add up to a set share; what several tables find is merged and
reranked by exact distance. On data whose neighbours are close that is few buckets; on data without near neighbours
(uniform on a sphere) it is a large part of a table, which no hashing avoids.

Buckets are dealt to shards by hash; a shard of more than ROWS_PER_SHARD rows is cut into chunks, each visited by the
shard's queries, so a hot bucket is many tasks and nothing is capped. A task keeps the best of its rows per query; no
pair of query and candidate is ever a row of a table. A query that finds fewer than k is searched again in all shards. Of equal vectors the copies beyond the k + 1 smallest ids can be in
no result and aren't indexed; equal queries are searched once.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those of
another length than most of the sample; ties go to the smaller id; fewer candidates than k give fewer rows; an empty table
gives none; rows that repeat an id are one candidate, and one query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import in_python, stored
from tidelog.settings import broadcast_bytes

# Production parameters.
K_NEAREST = 10
TABLES = 2
PROJECTIONS = 6
REACH = 2  # slots to either side that a probe may be away
WIDTH = 1.1  # of a slot, in usual distances
SHARE = 0.80  # of a table's chance to hold a neighbour, after which probing ends
SAMPLE = 2000  # vectors, chosen by hash of their id, that the usual distance is taken from
SEED = 20
ROWS_PER_SHARD = 2000
QUERIES_PER_BATCH = 64  # that a task probes at a time; the buckets of one are some 40 KB
SHARD_BYTES = 64  # of a shard and its number of chunks, broadcast


@dataclass
class Hashing:
    directions: np.ndarray  # tables x projections x dimensions
    offsets: np.ndarray  # tables x projections, in slots
    width: float
    distance: float
    share: float

    def places(self, x: np.ndarray, t: int) -> np.ndarray:
        return x @ self.directions[t].T / self.width + self.offsets[t]

    def buckets(self, slots: np.ndarray, t: int) -> np.ndarray:
        """A number per row of slots, the table's number among them."""
        h = np.full(slots.shape[:-1], t + 1, np.uint64)
        for i in range(slots.shape[-1]):
            h = (h ^ slots[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h >> np.uint64(1)).astype(np.int64)

    def probes(self, q: np.ndarray, t: int) -> np.ndarray:
        """The buckets that one query visits in a table, likeliest first."""
        place = self.places(q[None], t)[0]
        home = np.floor(place)
        steps = np.arange(-REACH, REACH + 1)
        edges = (home[:, None] + np.arange(-REACH, REACH + 2) - place[:, None]) * self.width / self.distance
        upto = 0.5 * (1 + np.vectorize(math.erf)(edges / math.sqrt(2)))
        chances = np.diff(upto, axis=1)
        product, slots = np.ones(1), np.zeros((1, 0))
        for i in range(len(home)):
            product = (product[:, None] * chances[i]).ravel()
            slots = np.concatenate(
                [np.repeat(slots, len(steps), axis=0), np.tile(home[i] + steps, len(slots))[:, None]], axis=1
            )
        order = np.argsort(-product, kind="stable")
        n = int(np.searchsorted(np.cumsum(product[order]), self.share)) + 1
        return self.buckets(slots[order[:n]], t)


def _matrix(column, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    e = F.col("embedding")
    # Null components fail the comparison; a vector's largest magnitude is finite and not 0.
    finite = F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    some = F.exists(e, lambda x: x != 0)
    return vectors.select("vec_id", "embedding").filter(e.isNotNull() & (F.size(e) > 0)).filter(finite).filter(some)


def fit(vectors: DataFrame, tables: int = TABLES, projections: int = PROJECTIONS, share: float = SHARE) -> Hashing | None:
    """Random directions, and the distance at which most vectors of the sample have their K_NEAREST-th neighbour there."""
    # The place where the sample ends comes from ids alone, so tasks send no more vectors than the sample has.
    place = F.xxhash64("vec_id").alias("place")
    last = vectors.select(place, "vec_id").orderBy("place", "vec_id").limit(SAMPLE).agg(F.max("place")).first()[0]
    early = vectors.filter(F.xxhash64("vec_id") <= F.lit(last))
    sample = early.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()
    if not sample:
        return None
    lengths = [len(r[0]) for r in sample]
    dimensions = max(set(lengths), key=lambda n: (lengths.count(n), n))
    x = np.array([r[0] for r in sample if len(r[0]) == dimensions], np.float64)
    few = x[:500]
    squares = np.maximum(0, (few**2).sum(1)[:, None] + (x**2).sum(1) - 2 * few @ x.T)
    near = np.sqrt(np.sort(squares, axis=1)[:, min(K_NEAREST, len(x) - 1)])
    distance = float(np.quantile(near, 0.9)) or 1.0
    random = np.random.default_rng(SEED)
    directions = random.standard_normal((tables, projections, dimensions))
    return Hashing(directions, random.random((tables, projections)), WIDTH * distance, distance, share)


def _indexed(hashing: Hashing, shards: int):
    def index(batches):
        for batch in batches:
            x = _matrix(batch.column("embedding"), hashing.directions.shape[2])
            for t in range(len(hashing.directions)):
                b = hashing.buckets(np.floor(hashing.places(x, t)), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b % shards), pa.array(b), batch.column("vec_id"), batch.column("embedding")],
                    ["shard", "bucket", "vec_id", "embedding"],
                )

    return index


def _probed(hashing: Hashing, shards: int):
    def probe(batches):
        for batch in batches:
            x = _matrix(batch.column("embedding"), hashing.directions.shape[2])
            for first in range(0, len(x), QUERIES_PER_BATCH):
                rows, found, lists = [], [], []
                for i, q in enumerate(x[first : first + QUERIES_PER_BATCH], first):
                    b = np.concatenate([hashing.probes(q, t) for t in range(len(hashing.directions))])
                    shard = b % shards
                    for s in np.unique(shard):
                        rows.append(i)
                        found.append(s)
                        lists.append(b[shard == s])
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), batch.column("query").take(at), batch.column("embedding").take(at), pa.array(lists, pa.list_(pa.int64()))],
                    ["shard", "query", "embedding", "buckets"],
                )

    return probe


def _nearest(dimensions: int, keep: int):
    def nearest(rows: pa.Table, queries: pa.Table) -> pa.Table:
        """The best of a chunk for each query that visits it, among the rows in the buckets it visits (all if none are named)."""
        out = ([], [], [])
        if rows.num_rows and queries.num_rows:
            buckets = rows.column("bucket").to_numpy()
            order = np.argsort(buckets, kind="stable")
            buckets = buckets[order]
            x = _matrix(rows.column("embedding").combine_chunks(), dimensions)[order]
            ids = rows.column("vec_id").to_numpy()[order]
            q = _matrix(queries.column("embedding").combine_chunks(), dimensions)
            for i, visited in enumerate(queries.column("buckets")):
                visited = visited.values.to_numpy()
                hit = np.isin(buckets, visited) if len(visited) else np.ones(len(buckets), bool)
                gaps = np.sqrt(((x[hit] - q[i]) ** 2).sum(axis=1))
                own, one = np.unique(ids[hit], return_index=True)  # a vector may be here from several tables
                gaps = gaps[one]
                best = np.lexsort((own, gaps))[:keep]
                out[0].append(np.full(len(best), queries.column("query")[i].as_py()))
                out[1].append(own[best])
                out[2].append(gaps[best])
        columns = [np.concatenate(c) if c else np.empty(0) for c in out]
        return pa.table({"query": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)), "score": pa.array(columns[2].astype(np.float64))})

    return nearest


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = K_NEAREST) -> DataFrame:
    """Per query (a table like vectors): query_id, rank, vec_id, score of its k nearest among vectors but itself."""
    spark = vectors.sparkSession
    index, asked = valid_vectors(vectors), valid_vectors(queries)
    hashing = fit(index)
    if hashing is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dimensions = hashing.directions.shape[2]
    index = index.filter(F.size("embedding") == dimensions)
    asked = asked.filter(F.size("embedding") == dimensions)
    # Spark cuts each map task's groups to k + 1 rows before the shuffle.
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    index = index.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy")
    index = stored(index, "ann-vectors")
    shards = max(1, -(-index.count() * len(hashing.directions) // ROWS_PER_SHARD))
    rows = stored(in_python(index, _indexed(hashing, shards), "shard bigint, bucket bigint, vec_id bigint, embedding array<float>"), "ann-index")
    identity = [F.xxhash64("embedding", F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), "embedding").alias("h2")]
    asked = stored(asked.select("vec_id", "embedding", *identity), "ann-queries")
    distinct = asked.groupBy("h1", "h2").agg(F.min(F.struct("vec_id", "embedding")).alias("one"))
    distinct = distinct.select("h1", "h2", F.col("one.vec_id").alias("query"), F.col("one.embedding").alias("embedding"))
    probes = in_python(
        distinct.select("query", "embedding"), _probed(hashing, shards),
        "shard bigint, query bigint, embedding array<float>, buckets array<bigint>",
    )
    chunks = rows.groupBy("shard").agg(F.ceil(F.count("*") / ROWS_PER_SHARD).alias("chunks"))
    # Said here, as Spark takes lists of buckets for short and would gather the probes or visits of all queries on the driver.
    chunks = chunks.hint("broadcast" if shards * SHARD_BYTES <= broadcast_bytes(spark) else "merge")
    chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).alias("chunk")
    left = rows.join(chunks, "shard").select("shard", chunk, "bucket", "vec_id", "embedding")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk")
    best = Window.partitionBy("query").orderBy("score", "vec_id")

    def searched(visits: DataFrame) -> DataFrame:
        local = left.groupBy("shard", "chunk").cogroup(visits.groupBy("shard", "chunk")).applyInArrow(
            _nearest(dimensions, k + 1), "query bigint, vec_id bigint, score double"
        )
        found = local.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
        return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)

    merged = stored(searched(probes.join(chunks, "shard").select("shard", every, "query", "embedding", "buckets")), "ann-found")
    # Queries whose buckets held fewer than k others go through all shards, block by block.
    full = merged.groupBy("query").count().filter(F.col("count") > k).select("query")
    short = stored(distinct.select("query", "embedding").join(full, "query", "left_anti"), "ann-short")
    if not short.isEmpty():
        shard = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard")
        visits = short.select(shard, "query", "embedding", F.array().cast("array<bigint>").alias("buckets"))
        again = searched(visits.join(chunks, "shard").select("shard", every, "query", "embedding", "buckets"))
        merged = merged.join(short.select("query"), "query", "left_anti").unionByName(again)
    members = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2")
    members = members.join(distinct.select("h1", "h2", "query"), ["h1", "h2"])
    members = members.select("query_id", "query").distinct()
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = members.join(merged, "query").filter("vec_id <> query_id").withColumn("rank", F.row_number().over(rank))
    return answers.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
