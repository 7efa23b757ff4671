"""From instants and start specifications to log positions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.instants import file_number, parse_instant, parse_start_spec
from tidelog.operators.lookup import lookup_join
from tidelog.operators.positions import FIRST_OFFSET, file_starts, latest_position
from tidelog.operators.scan import Running, running
from tidelog.settings import scratch_dir

# Width of a time bucket in seconds. Both sides are reduced to distinct seconds first, which bounds a bucket.
_SECONDS_PER_BUCKET = 1 << 16

# Up to this many positions are broadcast to the targets, a few MB; more are shuffled.
_FEW_POSITIONS = 1 << 15

# Slices of the targets without an instant.
_SPREAD = 1 << 12

# Up to this many crossing files are named in the scan's filter.
_LISTED_FILES = 1000


def _written(df: DataFrame, label: str) -> DataFrame:
    """A small table that later steps read instead of computing it again."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _crossing_files(files: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_ts, file_no): the last file whose first time is not after the target; the first file if there is none."""
    first_file = files.agg(F.min("file_no")).first()[0]
    starts = files.filter(F.col("first_time").isNotNull()).select(
        F.col("first_time").alias("at"), F.lit(0).alias("is_target"), "file_no"
    )
    wanted = targets.select(
        F.col("target_ts").alias("at"), F.lit(1).alias("is_target"), F.lit(None).cast("bigint").alias("file_no")
    )
    # In time order, files before targets of the same second: the highest file so far is the crossing file.
    merged = running(
        starts.unionByName(wanted),
        [],
        F.floor(F.col("at") / _SECONDS_PER_BUCKET),
        [F.col("at"), F.col("is_target")],
        {"crossing": Running("max", F.col("file_no"))},
    )
    return merged.filter(F.col("is_target") == 1).select(
        F.col("at").alias("target_ts"), F.coalesce("crossing", F.lit(first_file).cast("bigint")).alias("file_no")
    )


def _with_positions(targets: DataFrame, positions: DataFrame) -> DataFrame:
    """Targets with their positions, which are as many as distinct instants and so grow with the targets: a plain shuffle.

    Targets without an instant meet nothing; they are spread over all tasks. Skewed instants are for Spark to split.
    """
    unset = F.when(F.col("target_ts").isNull(), F.pmod(F.xxhash64(*targets.columns), F.lit(_SPREAD)) + 1)
    spread = targets.withColumn("_at", F.coalesce("target_ts", F.lit(0))).withColumn("_unset", F.coalesce(unset, F.lit(0)))
    found = positions.withColumnRenamed("target_ts", "_at").withColumn("_unset", F.lit(0).cast("bigint"))
    few = positions.count() <= _FEW_POSITIONS
    return spread.join(F.broadcast(found) if few else found, ["_at", "_unset"], "left").select(
        *targets.columns, "log_name", "file_no", "pos"
    )


def seek_positions(row_events: DataFrame, targets: DataFrame) -> DataFrame:
    """Add (log_name, file_no, pos) to a table of instants (`target_ts`, unix seconds).

    The position is the start of the first event of the crossing file at or after the instant, else the file's end.
    It is a position and not a time filter: later events with an earlier time stay behind it.

    The log is read twice: its headers once for the files' first times, and the crossing files for their seconds.
    """
    distinct = _written(targets.select("target_ts").filter(F.col("target_ts").isNotNull()).distinct(), "seek-targets")
    files = _written(file_starts(row_events.select("file_no", "log_name", "start_pos", "end_pos", "ts_unix")), "seek-files")
    crossing = _written(_crossing_files(files, distinct).filter(F.col("file_no").isNotNull()), "seek-crossing")

    header = row_events.select("file_no", "start_pos", "ts_unix").filter(F.col("ts_unix") > 0)
    chosen = crossing.select("file_no").distinct()
    few = [r[0] for r in chosen.limit(_LISTED_FILES + 1).collect()]
    if len(few) <= _LISTED_FILES:
        # Literal numbers prune the partitions of all other files.
        scanned = header.filter(F.col("file_no").isin(few))
    else:
        scanned = lookup_join(header, chosen, ["file_no"], "left_semi", ["start_pos"])
    # All events of one second act alike, so each file shrinks to its distinct seconds before anything is shuffled.
    seconds = scanned.groupBy("file_no", F.col("ts_unix").alias("at")).agg(F.min("start_pos").alias("start_pos"))
    marks = _written(seconds, "seek-seconds").select("file_no", "at", F.lit(0).alias("is_target"), "start_pos")
    wanted = crossing.select(
        "file_no", F.col("target_ts").alias("at"), F.lit(1).alias("is_target"), F.lit(None).cast("bigint").alias("start_pos")
    )
    # From the file's end backwards in time, events before targets of the same second: the lowest start so far.
    found = running(
        marks.unionByName(wanted),
        ["file_no"],
        -F.floor(F.col("at") / _SECONDS_PER_BUCKET),
        [F.col("at").desc(), F.col("is_target")],
        {"found": Running("min", F.col("start_pos"))},
    ).filter(F.col("is_target") == 1)
    ends = files.select("file_no", "log_name", F.col("file_size").alias("file_end"))
    positions = found.join(ends, "file_no", "left").select(
        F.col("at").alias("target_ts"),
        "log_name",
        "file_no",
        F.coalesce("found", "file_end", F.lit(FIRST_OFFSET).cast("bigint")).alias("pos"),
    )
    return _with_positions(targets, _written(positions, "seek-positions"))


def resolve_start(specs: DataFrame, row_events: DataFrame) -> DataFrame:
    """Add (log_name, file_no, pos) to start specifications (`start_spec`, `since`).

    `since` wins over `start_spec`; text that cannot be read counts as `end`. `end` is the current position, `start`
    the beginning of the current file, `<file>:<pos>` is taken as given.
    """
    current = latest_position(row_events)
    here = current.select(F.struct("log_name", "file_no", "pos").alias("p")).scalar()
    parsed = (
        specs.withColumn("_spec", parse_start_spec(F.col("start_spec")))
        .withColumn("target_ts", parse_instant(F.col("since")))
        .withColumn("_here", here)
    )
    joined = seek_positions(row_events, parsed)
    joined = joined.withColumn("_sought", F.when(F.col("pos").isNotNull(), F.struct("log_name", "file_no", "pos")))
    kind = F.when(F.col("since").isNotNull(), F.lit("end")).otherwise(F.col("_spec.kind"))

    def choose(field: str, start, at):
        return (
            F.when(F.col("_sought").isNotNull(), F.col(f"_sought.{field}"))
            .when(kind == "at", at)
            .when(kind == "start", start)
            .otherwise(F.col(f"_here.{field}"))
            .alias(field)
        )

    spec_file = F.col("_spec.log_name")
    return joined.select(
        *specs.columns,
        choose("log_name", F.col("_here.log_name"), spec_file),
        choose("file_no", F.col("_here.file_no"), file_number(spec_file)),
        choose("pos", F.lit(FIRST_OFFSET), F.col("_spec.pos")).cast("decimal(20,0)").alias("pos"),
    )
