"""As-of lookups: each fact meets the last point of its key before it, and the facts stay where they are.

Points are few per key as a rule. They are measured, and broadcast as spans below `spark.tidelog.broadcastBytes`. Beyond
it they are written to the shared folder, cut by file and chunk of log, each chunk with what holds at its start. A task
then reads the chunks of the facts it scans: only the facts' keys and positions go through Arrow, all else (such as the
changed rows) waits in the JVM. Neither way shuffles a fact, and memory is bounded by one chunk of points.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.settings import broadcast_bytes, chunk_bytes, scratch_dir

# Points that one key may have for the broadcast join (each fact is compared with all of them: some nanoseconds each, while
# a chunk costs a folder to write and one to open in every task that meets it).
MAX_POINTS = 128

# Chunks of points that a task keeps at a time.
_KEPT_CHUNKS = 4


def measured(points: DataFrame, keys: list[str], values: list[str]) -> tuple[int, int]:
    """Bytes of all points, about, and the most of one key. One aggregate, from one row per key."""
    text = [F.octet_length(v) for v, kind in points.dtypes if v in values and kind == "string"]
    each = sum((F.coalesce(t, F.lit(0)) for t in text), F.lit(16 + 8 * (len(keys) + len(values))))
    per_key = points.groupBy(*keys).agg(F.sum(each).alias("bytes"), F.count("*").alias("points"))
    size, most = per_key.agg(F.sum("bytes"), F.max("points")).first()
    return size or 0, most or 0


def with_until(points: DataFrame, keys: list[str]) -> DataFrame:
    """Points gain `until_pos`, where the next point of their key begins."""
    return points.withColumn("until_pos", F.lead("from_pos").over(Window.partitionBy(*keys).orderBy("from_pos")))


def _by_broadcast(facts: DataFrame, points: DataFrame, keys: list[str], values: list[str], how: str) -> DataFrame:
    f, p = facts.drop(*values).alias("f"), F.broadcast(points).alias("p")
    on = (F.col("f.start_pos") > F.col("p.from_pos")) & (
        F.col("p.until_pos").isNull() | (F.col("f.start_pos") <= F.col("p.until_pos"))
    )
    for key in keys:
        on &= F.col(f"f.{key}") == F.col(f"p.{key}")
    return f.join(p, on, how).select("f.*", *[f"p.{v}" for v in values])


def _chunked(facts: DataFrame, points: DataFrame, keys: list[str], values: list[str], size: int) -> str:
    """Write the points by file and chunk; a chunk also gets each key's last point before it. Returns the folder.

    A key is carried on as far as its file has facts, so every chunk that a fact asks for is complete.
    """
    chunk = lambda pos: F.floor(F.col(pos) / F.lit(size))
    held = points.select(*keys, "from_pos", *values, chunk("from_pos").alias("chunk_no"))
    last = held.groupBy(*keys, "chunk_no").agg(F.max(F.struct("from_pos", *values)).alias("_last"))
    ends = facts.groupBy("file_no").agg(F.max(chunk("start_pos")).alias("_end"))
    following = F.lead("chunk_no").over(Window.partitionBy(*keys).orderBy("chunk_no"))
    spread = last.withColumn("_next", following).join(ends, "file_no")
    upto = F.coalesce("_next", "_end")
    carried = spread.filter(upto > F.col("chunk_no")).select(
        *keys, "_last.*", F.explode(F.sequence(F.col("chunk_no") + 1, upto)).alias("chunk_no")
    )
    path = scratch_dir(facts.sparkSession, "points")
    both = held.unionByName(carried)
    # Few files per folder, and a hot file on many tasks.
    both.repartition("file_no", "chunk_no").write.partitionBy("file_no", "chunk_no").parquet(path)
    return path


def _finder(path: str, size: int, ids: list[str], values: list[tuple[str, str]], kept: int):
    """An Arrow function of (file_no, start_pos, *ids) that gives the values of the point before. It needs no own module."""

    def find(batches):
        from collections import OrderedDict

        import numpy as np
        import pyarrow as pa
        from pyarrow import dataset, fs

        types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
        struct = pa.struct([(name, types[kind]) for name, kind in values])
        names = [*ids, "from_pos", *[name for name, _ in values]]
        store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        chunks = OrderedDict()

        def points_of(file_no, chunk):
            place = file_no, chunk
            if place not in chunks:
                folder = f"{root}/file_no={file_no}/chunk_no={chunk}"
                there = store.get_file_info(folder).type == fs.FileType.Directory
                table = dataset.dataset(folder, filesystem=store, format="parquet").to_table(columns=names) if there else None
                chunks[place] = table.combine_chunks() if table is not None else None
                if len(chunks) > kept:
                    chunks.popitem(last=False)
            chunks.move_to_end(place)
            return chunks[place]

        def found(file_no, chunk, positions, own):
            """Per fact the number of its point, or -1, and the chunk's points."""
            points = points_of(file_no, chunk)
            if points is None or not points.num_rows:
                return np.full(len(positions), -1), None
            n = points.num_rows
            p_pos = points["from_pos"].to_numpy()
            p_ids = [points[name].to_numpy() for name in ids]
            # Merge points and facts by key and position; a point counts for what comes after it only.
            pos = np.concatenate([positions, p_pos])
            is_point = np.arange(len(pos)) >= len(positions)
            keys = [np.concatenate([a, b]) for a, b in zip(own, p_ids)]
            order = np.lexsort([is_point, pos, *reversed(keys)])
            at = np.arange(len(order))
            same = np.ones(len(order), bool)
            for key in keys:
                same[1:] &= key[order][1:] == key[order][:-1]
            same[:1] = False
            start = np.maximum.accumulate(np.where(same, 0, at))
            latest = np.maximum.accumulate(np.where(is_point[order], at, -1))
            hit = np.where(latest >= start, order[latest] - len(positions), -1)
            result = np.empty(len(order), np.int64)
            result[order] = hit
            assert n + len(positions) == len(order)
            return result[: len(positions)], points

        for columns in batches:
            numbers = [c.to_numpy(zero_copy_only=False) for c in columns]
            known = ~np.logical_or.reduce([c.is_null().to_numpy(zero_copy_only=False) for c in columns])
            rows = np.flatnonzero(known)
            file_no, pos = (numbers[i][rows].astype(np.int64) for i in range(2))
            own = [x[rows].astype(np.int64) for x in numbers[2:]]
            places, which = np.unique(np.stack([file_no, pos // size]), axis=1, return_inverse=True)
            parts = [[pa.nulls(0, types[kind]) for _, kind in values]]
            taken = np.full(len(known), -1)
            base = 0
            for k in range(places.shape[1]):
                mine = np.flatnonzero(which.ravel() == k)
                at, points = found(int(places[0, k]), int(places[1, k]), pos[mine], [x[mine] for x in own])
                if points is not None:
                    parts.append([points[name].combine_chunks() for name, _ in values])
                    taken[rows[mine]] = np.where(at >= 0, at + base, -1)
                    base += points.num_rows
            pool = [pa.concat_arrays([a if isinstance(a, pa.Array) else a.combine_chunks() for a in one]) for one in zip(*parts)]
            picked = pa.array(taken, mask=taken < 0)
            yield pa.StructArray.from_arrays(
                [a.take(picked) for a in pool], fields=list(struct), mask=pa.array(taken < 0)
            )

    return find


def _by_chunks(facts: DataFrame, points: DataFrame, keys: list[str], values: list[str], how: str) -> DataFrame:
    from collections.abc import Iterator

    import pyarrow as pa

    size = chunk_bytes(facts.sparkSession)
    path = _chunked(facts, points, keys, values, size)
    kinds = [(v, kind) for v in values for name, kind in points.dtypes if name == v]
    find = _finder(path, size, keys[1:], kinds, _KEPT_CHUNKS)
    find.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    # Not deterministic by name only: it must run once, however often the result is used.
    look_up = F.arrow_udf(find, ", ".join(f"{v} {kind}" for v, kind in kinds)).asNondeterministic()
    arguments = [F.col(c).cast("bigint") for c in (keys[0], "start_pos", *keys[1:])]
    found = facts.drop(*values).withColumn("_found", look_up(*arguments))
    if how == "inner":
        found = found.filter(F.col("_found").isNotNull())
    return found.select("*", *[F.col(f"_found.{v}").alias(v) for v in values]).drop("_found")


def asof_join(
    facts: DataFrame,
    points: DataFrame,
    keys: list[str],
    values: list[str],
    how: str = "inner",
    wanted: Column | None = None,
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """Facts with the `values` of the last point of the same `keys` whose `from_pos` is below the fact's `start_pos`.

    `keys` are whole numbers, `file_no` first. Facts without such a point are left out (`inner`) or get nulls (`left`). Of
    points at one place any may win. With `wanted`, a test on the points, an inner join keeps only facts whose point passes
    it. A position up to that of the next point belongs to the point before. `size` is what `measured` gave, if known.
    """
    spans = with_until(points, keys)
    kept = spans if wanted is None else spans.filter(wanted)
    total, most = size or measured(kept, keys, values)
    if total <= broadcast_bytes(facts.sparkSession) and most <= MAX_POINTS:
        return _by_broadcast(facts, kept, keys, values, how)
    found = _by_chunks(facts, points, keys, values, how)
    return found if wanted is None else found.filter(wanted)
