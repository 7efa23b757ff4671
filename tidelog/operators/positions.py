"""Log files, their sizes and time ranges, and positions in them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.scan import Running, running
from tidelog.settings import chunk_bytes

# The first offset after a file's header.
FIRST_OFFSET = 4

_FILE = ["file_no", "log_name"]
_FILES_PER_BUCKET = 4096
_MAX_BIGINT = 9223372036854775807


def log_files(row_events: DataFrame) -> DataFrame:
    """(log_name, file_no, file_size) of every log file."""
    return row_events.groupBy("log_name", "file_no").agg(F.max("end_pos").alias("file_size"))


def latest_position(row_events: DataFrame) -> DataFrame:
    """One row (log_name, file_no, pos): the end of the last file; nulls for a log without events."""
    # The number of the newest file comes from the partitions' names, and then only that file is read.
    newest = row_events.agg(F.max("file_no")).first()[0]
    last = F.max(F.struct("file_no", "end_pos", "log_name")).alias("last")
    return row_events.filter(F.col("file_no") == F.lit(newest).cast("bigint")).agg(last).select(
        F.col("last.log_name").alias("log_name"), F.col("last.file_no").alias("file_no"), F.col("last.end_pos").alias("pos")
    )


def current_position(row_events: DataFrame) -> DataFrame:
    """One row (log_name, file_no, pos), the current write position; a log without events is an error."""
    missing = F.raise_error(F.lit("the log has no events, so it has no current position"))
    return latest_position(row_events).select(
        F.coalesce("log_name", missing.cast("string")).alias("log_name"), "file_no", "pos"
    )


def _timed() -> Column:
    return F.col("ts_unix") > 0


def file_starts(row_events: DataFrame) -> DataFrame:
    """(file_no, log_name, file_size, first_time), from one aggregate over the event headers."""
    timed_pos = F.when(_timed(), F.col("start_pos"))
    return row_events.groupBy(*_FILE).agg(
        F.max("end_pos").alias("file_size"), F.min_by("ts_unix", timed_pos).alias("first_time")
    )


def first_event_time(row_events: DataFrame) -> DataFrame:
    """(file_no, log_name, first_time): time of a file's first event that has one; null if none has."""
    return file_starts(row_events).select(*_FILE, "first_time")


def file_time_ranges(row_events: DataFrame, now_ts: int) -> DataFrame:
    """(log_name, file_no, file_size, start_time, end_time, is_current) in unix seconds.

    A file ends where the next one starts; the current file, the last one, ends now.
    """
    files = file_starts(row_events)
    # Walk the files backwards: the nearest file already passed is the next one. All columns travel along, so that
    # both branches of the running aggregate share one aggregate over the log.
    nearest = Running("min", F.struct("file_no", "first_time", "log_name", "file_size"), inclusive=False)
    bucket = -F.floor(F.col("file_no") / _FILES_PER_BUCKET)
    followed = running(files, [], bucket, [F.col("file_no").desc()], {"next_file": nearest})
    is_current = F.col("next_file").isNull()
    return followed.select(
        "log_name",
        "file_no",
        "file_size",
        F.col("first_time").alias("start_time"),
        F.when(is_current, F.lit(now_ts).cast("bigint")).otherwise(F.col("next_file.first_time")).alias("end_time"),
        is_current.alias("is_current"),
    )


def files_overlapping(ranges: DataFrame, since: int | Column | None = None, until: int | Column | None = None) -> DataFrame:
    """Keep the files whose range meets [since, until], both inclusive and optional.

    An unknown start counts as 0, an unknown end as later than any bound.
    """
    if since is not None:
        ranges = ranges.filter(F.coalesce(F.col("end_time"), F.lit(_MAX_BIGINT)) >= since)
    if until is not None:
        ranges = ranges.filter(F.coalesce(F.col("start_time"), F.lit(0)) <= until)
    return ranges


def inventory_totals(files: DataFrame) -> DataFrame:
    """(files, total_bytes) of a list of files."""
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("total_bytes")
    )


def event_offsets(events: DataFrame) -> DataFrame:
    """Add `start_pos` to events that carry only `end_pos`: the end of the previous event, 4 for the first."""
    chunk = F.floor(F.col("end_pos") / F.lit(chunk_bytes(events.sparkSession)))
    previous = Running("max", F.col("end_pos"), inclusive=False)
    found = running(events, ["file_no"], chunk, [F.col("end_pos")], {"start_pos": previous})
    return found.withColumn("start_pos", F.coalesce("start_pos", F.lit(FIRST_OFFSET).cast("bigint")))


def from_position(df: DataFrame, file_no: int | Column, pos: int | Column) -> DataFrame:
    """Keep the events at or after a position."""
    # The first test alone prunes file partitions.
    return df.filter(
        (F.col("file_no") >= file_no) & ((F.col("file_no") > file_no) | (F.col("start_pos") >= pos))
    )
