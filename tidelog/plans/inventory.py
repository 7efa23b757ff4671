"""Inventory of the log files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.instants import format_utc_z, parse_instant, position_label
from tidelog.operators.positions import current_position, file_time_ranges, files_overlapping


def _instant(spark, text: str | None) -> int | None:
    if text is None:
        return None
    seconds = spark.range(1).select(parse_instant(F.lit(text)).alias("s")).first()["s"]
    if seconds is None:
        raise ValueError(f"not an instant: {text!r}")
    return seconds


def log_inventory(row_events: DataFrame, now_ts: int, since: str | None = None, until: str | None = None) -> DataFrame:
    """(log_name, file_size, start_time, end_time, is_current) of the files that meet the time window."""
    spark = row_events.sparkSession
    ranges = files_overlapping(file_time_ranges(row_events, now_ts), _instant(spark, since), _instant(spark, until))
    return ranges.select(
        "log_name",
        "file_size",
        format_utc_z(F.col("start_time")).alias("start_time"),
        format_utc_z(F.col("end_time")).alias("end_time"),
        "is_current",
    )


def inventory_current(row_events: DataFrame) -> DataFrame:
    """One row (file, pos, binlog_start): the current position and its label for a start specification."""
    here = current_position(row_events)
    return here.select(
        F.col("log_name").alias("file"), "pos", position_label(F.col("log_name"), F.col("pos")).alias("binlog_start")
    )
