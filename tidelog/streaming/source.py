"""The landed log as a stream whose offsets are positions: a file number and a position in that file.

The source hands out stretches of log, not events: where it stands follows from the footers of the landed files, from the
file of its offset on. Each micro-batch then reads its stretches as plain Parquet, so no event passes through Python and
no file before the offset is listed or opened. It goes as far as the log has landed without a gap.

A Spark job that appends to the log shows its files one by one and in no order when it commits: a later log file may be there
before the rest of an earlier one, and positions alone don't tell that the earlier one has a rest. So the offset waits while
such a job is under way, which its `_temporary` folder tells, or has ended during the look (the time of `_SUCCESS`).
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schema import ROW_EVENTS
from tidelog.sources.files import exists, publish, read_text

FORMAT = "tidelog_positions"
SEGMENTS = "file_no bigint, from_pos bigint, to_pos bigint"

# Log files of one micro-batch.
MAX_FILES = 1000

Start = str | tuple[int, int]


def _source():
    """The data source class. A local class travels to Spark's Python processes by value, so they need no own module."""
    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.path, self.start = options["path"], options["start"]
            self.max_files = int(options["max_files"])

        def _store(self):
            from pyarrow import fs

            if "://" in self.path or self.path.startswith("file:"):
                return fs.FileSystem.from_uri(self.path)
            return fs.LocalFileSystem(), self.path

        def _files(self):
            """Numbers of the log files that have a folder, in order."""
            from pyarrow import fs

            store, root = self._store()
            found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
            return sorted(int(f.base_name.split("=")[1]) for f in found if f.base_name.startswith("file_no="))

        def _append(self):
            """Whether a job is appending to the log, and when the last one ended."""
            from pyarrow import fs

            store, root = self._store()
            job, done = store.get_file_info([f"{root}/_temporary", f"{root}/_SUCCESS"])
            return job.type != fs.FileType.NotFound, done.mtime_ns

        def _landed(self, file_no):
            """(first position, end) of each row group of a log file, from the footers."""
            from pyarrow import fs, parquet

            store, root = self._store()
            spans = []
            for part in store.get_file_info(fs.FileSelector(f"{root}/file_no={file_no}")):
                if not part.base_name.endswith(".parquet") or part.base_name[0] in "._":
                    continue
                with store.open_input_file(part.path) as file:
                    meta = parquet.read_metadata(file)
                column = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                for k in range(meta.num_row_groups):
                    first, end = (meta.row_group(k).column(column[c]).statistics for c in ("start_pos", "end_pos"))
                    spans.append((first.min, end.max))
            return sorted(spans)

        def _upto(self, file_no, pos):
            """How far the file has landed from pos on without a gap, and whether nothing is beyond."""
            reached = pos
            for first, end in self._landed(file_no):
                if first > reached:
                    return reached, False
                reached = max(reached, end)
            return reached, True

        def initialOffset(self):
            files = self._files()
            if self.start not in ("start", "end"):
                file_no, pos = map(int, self.start.split(":"))
                return {"file_no": file_no, "pos": pos}
            if not files:
                return {"file_no": 0, "pos": 4}
            # Both are places in the newest file; no other is opened.
            end = max([end for _, end in self._landed(files[-1])], default=4)
            return {"file_no": files[-1], "pos": 4 if self.start == "start" else end}

        def read(self, start):
            before, end = self._append(), self._reached(start)
            if before[0] or self._append() != before:
                end = start
            return self.readBetweenOffsets(start, end), end

        def _reached(self, start):
            file_no, pos = start["file_no"], start["pos"]
            later = [f for f in self._files() if f > file_no]
            reached, whole = self._upto(file_no, pos) if file_no else (pos, True)
            for following in later[: self.max_files - 1]:
                if not whole:
                    break
                file_no = following
                reached, whole = self._upto(following, 4)
            return {"file_no": file_no, "pos": reached}

        def readBetweenOffsets(self, start, end):
            if start == end:
                return iter([])
            files = [f for f in self._files() if start["file_no"] <= f <= end["file_no"]]
            return iter(
                [
                    (f, start["pos"] if f == start["file_no"] else 4, end["pos"] if f == end["file_no"] else None)
                    for f in files
                ]
            )

    class Positions(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return SEGMENTS

        def simpleStreamReader(self, schema):
            return Reader(self.options)

    return Positions


def read_segments(spark: SparkSession, path: str, start: Start = "end", max_files: int = MAX_FILES) -> DataFrame:
    """A stream of stretches of the log below path, which has a folder `file_no=<n>` per log file.

    `start` is `end` (what has landed when the stream first starts), `start` (the beginning of the newest file) or a
    position, as `start_position` gives it for a specification or an instant. A restart goes on at its checkpoint.
    """
    spark.dataSource.register(_source())
    where = start if isinstance(start, str) else f"{start[0]}:{start[1]}"
    options = {"path": path, "start": where, "max_files": str(max_files)}
    return spark.readStream.format(FORMAT).options(**options).load()


def events_of(spark: SparkSession, path: str, segments: DataFrame) -> tuple[DataFrame, tuple[int, int] | None]:
    """The row events of a micro-batch's stretches, and where these begin; reads the folders of their files only."""
    rows = sorted(segments.collect(), key=lambda r: r["file_no"])  # one per log file
    if not rows:
        return spark.createDataFrame([], ROW_EVENTS), None
    first, last = rows[0], rows[-1]
    folders = [f"{path}/file_no={r['file_no']}" for r in rows]
    events = spark.read.schema(ROW_EVENTS).option("basePath", path).parquet(*folders)
    from_first = (F.col("file_no") > first["file_no"]) | (F.col("start_pos") >= first["from_pos"])
    to_last = (F.col("file_no") < last["file_no"]) | (F.col("start_pos") < last["to_pos"])
    return events.filter(from_first & to_last), (first["file_no"], first["from_pos"])


def opened_at(spark: SparkSession, checkpoint: str, begins: tuple[int, int] | None) -> tuple[int, int] | None:
    """Where the stream was opened: the beginning of its first batch, kept beside the checkpoint."""
    place = f"{checkpoint}/opened.json"
    if begins is not None and not exists(spark, place):
        publish(spark, place, json.dumps(begins))
    return tuple(json.loads(read_text(spark, place))) if exists(spark, place) else None
