"""Micro-batches that are read as plain Parquet.

Spark hands `foreachBatch` the rows of a micro-batch as its plan gives them: each use of the batch reads and copies all columns
anew, the changed rows too, whatever it asks for. Of a stream of landed files only their names need to flow: the batch then
reads those files, so that each use reads its own columns.
"""

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Gives the rows that a stream takes from some of its files.
Reread = Callable[[SparkSession, list[str]], DataFrame]


def rereadable(stream: DataFrame, read: Reread) -> DataFrame:
    """Note how the rows of this very stream are read from its files. What is derived from it further is not."""
    stream._reread = read
    return stream


def reread_of(stream: DataFrame) -> Reread | None:
    return stream.__dict__.get("_reread")


def literal(path: str) -> str:
    """A path that Spark doesn't take for a pattern."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def each_batch(stream: DataFrame, run: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """A writer that calls `run` with each micro-batch and its number; see `rereadable`."""
    read = reread_of(stream)
    if read is None:
        return stream.writeStream.foreachBatch(run)

    def run_files(names: DataFrame, batch_id: int) -> None:
        # As many as the files of a micro-batch.
        found = sorted(unquote(name) for (name,) in names.distinct().collect())  # names come as URLs
        run(read(names.sparkSession, found), batch_id)

    return stream.select("_metadata.file_path").writeStream.foreachBatch(run_files)
