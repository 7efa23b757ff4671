"""Appending to the event store.

The store is a parquet table with one folder per append. Beside the data, `_ledger` holds two small files per append, each
published under a name that only one writer can take: a reservation, made before anything is written, which takes the next
range of ids and with it the folder, and a commit, made after the data is whole. Readers open committed folders only, so a
half-written append is invisible; ranges follow each other, so no id is given twice, whoever writes. An append that runs
again finds its reservation and writes the same ids; one that is committed is not written again, unless it has another
number of events: then it takes a range anew, and its last commit is the one that counts.
"""

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.instants import now_text
from tidelog.operators.ids import numbered_rows
from tidelog.schema import EVENT_STORE
from tidelog.sources.event_store import LEDGER, commit_file, reservation_file
from tidelog.sources.files import exists, names_in, publish, read_text, replace

FULL = "full"
ID_ONLY = "id-only"

_APPEND = "append"


@dataclass(frozen=True)
class Reservation:
    """A range of ids, and who writes them: ids first to first + rows - 1 in folder `append=<number>`.

    No id from `next_id` on has been given out before.
    """

    number: int
    first: int
    rows: int
    next_id: int
    writer: str
    batch_id: int | None


def to_store_row(events: DataFrame, mode: str = ID_ONLY) -> DataFrame:
    """Change events as store rows. Mode `full` keeps the row JSON; any other mode leaves it null."""

    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    row_data = F.col("row") if mode == FULL else F.lit(None).cast("string")
    kept = [F.col("id")] if "id" in events.columns else []
    return events.select(
        *kept,
        now_text("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("captured_at"),
        text("timestamp").alias("event_time"),
        text("operation").alias("operation"),
        text("database").alias("db_name"),
        text("table").alias("table_name"),
        F.coalesce("primary_key", F.lit("null")).alias("primary_key"),
        row_data.alias("row_data"),
    )


def _reservation(spark: SparkSession, path: str, number: int) -> Reservation:
    return Reservation(**json.loads(read_text(spark, reservation_file(path, number))))


def _latest(spark: SparkSession, path: str) -> Reservation | None:
    """The last reservation; lists the folders of the ledger and the newest one."""
    groups = [n for n in names_in(spark, f"{path}/{LEDGER}") if n.startswith("group=")]
    names = [n for n in names_in(spark, f"{path}/{LEDGER}/{groups[-1]}") if n.startswith("reserved-")] if groups else []
    return _reservation(spark, path, int(names[-1].split("-")[1].split(".")[0])) if names else None


def _own(spark: SparkSession, path: str, writer: str, batch_id: int) -> Reservation | None:
    """What this append took before; its note of that is written right after the reservation."""
    note = f"{path}/{LEDGER}/writers/{writer}/{batch_id}.json"
    return _reservation(spark, path, int(read_text(spark, note))) if exists(spark, note) else None


def is_committed(spark: SparkSession, path: str, number: int) -> bool:
    return exists(spark, commit_file(path, number))


def reserve(spark: SparkSession, path: str, rows: int, writer: str, batch_id: int | None) -> Reservation:
    """Take the next range of ids, or find the one that this append took before.

    Of writers that want the same place in the ledger one gets it; the others read its range and try the next place.
    """
    own = _own(spark, path, writer, batch_id) if batch_id is not None else None
    last = _latest(spark, path)
    # A writer that was stopped between taking a range and its note of it finds the range if it is still the last.
    if own is None and batch_id is not None and last and (last.writer, last.batch_id) == (writer, batch_id):
        own = last
    if own is not None and own.rows == rows:
        return own
    while True:
        number, first = (last.number + 1, last.next_id) if last else (0, 1)
        # The same append with other events takes its ids anew if nobody has come after it.
        if own is not None and own.number == last.number:
            first = own.first
        next_id = max(first + rows, last.next_id if last else 1)
        mine = Reservation(number, first, rows, next_id, writer, batch_id)
        if publish(spark, reservation_file(path, number), json.dumps(asdict(mine))):
            break
        last = _reservation(spark, path, number)
    if batch_id is not None:
        replace(spark, f"{path}/{LEDGER}/writers/{writer}/{batch_id}.json", str(mine.number))
    return mine


def append_events(
    events: DataFrame, path: str, mode: str = ID_ONLY, batch_id: int | None = None, writer: str = _APPEND
) -> None:
    """Append change events with ids that go on from the highest one given out.

    `writer` and `batch_id` name an append that may be repeated; without a `batch_id` each call is a new append. Several
    writers may append at the same time.
    """
    append_numbered(*numbered_rows(events), path, mode, batch_id, writer)


def append_numbered(
    rows: int, numbered: DataFrame, path: str, mode: str = ID_ONLY, batch_id: int | None = None, writer: str = _APPEND
) -> None:
    """Append that many change events that have ids from 1 already, as `numbered_capture` gives them."""
    spark = numbered.sparkSession
    mine = reserve(spark, path, rows, writer, batch_id)
    if is_committed(spark, path, mine.number):
        return
    folder = f"append={mine.number}"
    with_ids = numbered.withColumn("id", F.col("id") + F.lit(mine.first - 1))
    to_store_row(with_ids, mode).select(*EVENT_STORE.names).write.mode("overwrite").parquet(f"{path}/{folder}")
    commit = {"folder": folder} | asdict(mine)
    publish(spark, commit_file(path, mine.number), json.dumps(commit))
