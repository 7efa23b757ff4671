"""From row-change logs to change events."""

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidelog.functions.instants import format_event_time
from tidelog.functions.render import (
    all_distinct,
    cell_keys,
    classify_operation,
    fragments,
    keys_of,
    null_if_empty,
    object_json,
    primary_key_json,
    row_envelope,
)
from tidelog.operators.asof import asof_join
from tidelog.operators.catalog import TABLE_KEY
from tidelog.operators.lookup import lookup_join
from tidelog.operators.positions import from_position
from tidelog.operators.resolve import good_rows, readable_rows, resolve_tables
from tidelog.operators.scan import Running, running
from tidelog.operators.seek import resolve_start
from tidelog.settings import chunk_bytes
from tidelog.sources.files import stored

_MAX_POS = 9223372036854775807


def keyed_catalog(columns: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """Both catalogs in one table, with what each row needs worked out once per table.

    Adds name_keys and pk_keys (quoted names) and plain_names (no name is missing or repeated).
    """
    both = columns.join(primary_keys, TABLE_KEY, "full_outer").withColumn("name_keys", keys_of(F.col("columns")))
    return both.select(
        *TABLE_KEY,
        "name_keys",
        all_distinct(F.col("name_keys")).alias("plain_names"),
        "pk_columns",
        keys_of(F.col("pk_columns")).alias("pk_keys"),
    )


@lru_cache
def _fragments_of(side: str, application: str) -> Column:
    """Fragments of one image of `row_change`.

    The expression is large, and a stream would build it anew for each batch; one per application is enough.
    """
    return fragments(F.col(f"row_change.{side}"))


def change_events(rows: DataFrame) -> DataFrame:
    """Changed rows with their table and its `keyed_catalog` entry to change events."""
    application = rows.sparkSession.sparkContext.applicationId
    nothing = F.array().cast("array<string>")
    names = F.coalesce("name_keys", nothing)
    operation = F.col("operation")
    # An image counts only for the operations that have it; one that is missing has no cells.
    used = {"before": operation != "INSERT", "after": operation != "DELETE"}

    def cells(side: str) -> Column:
        return F.col(f"row_change.{side}")

    def plain(side: str) -> Column:
        """The catalog names every cell, each differently; surplus names do no harm."""
        return F.coalesce(F.col("plain_names") & (F.size(cells(side)) <= F.size("name_keys")), F.lit(False))

    def keys(side: str) -> Column:
        count = F.size(cells(side))
        named = F.when(count == F.size(names), names).otherwise(F.slice(names, F.lit(1), count))
        return F.coalesce(
            F.when(used[side], F.when(plain(side), named).otherwise(cell_keys(cells(side), names))), nothing
        )

    def distinct(side: str) -> Column:
        return plain(side) | (F.size(names) == 0)

    def values(side: str) -> Column:
        return F.coalesce(F.when(used[side], _fragments_of(side, application)), nothing)

    # Fragments serve both the object and the key, so they are columns of their own.
    rendered = rows.withColumn("operation", classify_operation(F.col("event_type"))).withColumns(
        {
            "_before": values("before"),
            "_after": values("after"),
            "_before_keys": keys("before"),
            "_after_keys": keys("after"),
            "_before_distinct": distinct("before"),
            "_after_distinct": distinct("after"),
        }
    )
    is_delete = operation == "DELETE"
    return rendered.select(
        format_event_time(F.col("ts_unix")).alias("timestamp"),
        F.col("ts_unix").alias("event_time"),
        "operation",
        F.col("db_name").alias("database"),
        F.col("table_name").alias("table"),
        null_if_empty(F.col("pk_columns")).alias("pk_columns"),
        primary_key_json(
            F.when(is_delete, F.col("_before_keys")).otherwise(F.col("_after_keys")),
            F.when(is_delete, F.col("_before")).otherwise(F.col("_after")),
            F.col("pk_keys"),
        ).alias("primary_key"),
        row_envelope(
            operation,
            object_json(F.col("_before_keys"), F.col("_before"), F.col("_before_distinct")),
            object_json(F.col("_after_keys"), F.col("_after"), F.col("_after_distinct")),
        ).alias("row"),
        "log_name",
        "file_no",
        "start_pos",
        "row_index",
        *[c for c in ("id",) if c in rows.columns],
    )


class Skipped:
    """What one run of a capture leaves out, counted as the rows go by; no scan of its own.

    `rows_events` were read, `bound_events` of them have a wanted table, `bad_rows` of those could not be read. Without
    filters what is not bound had no table map. Tasks that run again may count twice.
    """

    def __init__(self):
        self._read, self._bound = Observation(), Observation()

    def reading(self, events: DataFrame) -> DataFrame:
        return events.observe(self._read, F.count(F.lit(1)).alias("rows_events"))

    def bound(self, events: DataFrame) -> DataFrame:
        bad = F.coalesce(F.sum(F.size("rows") - good_rows()), F.lit(0)).cast("bigint").alias("bad_rows")
        return events.observe(self._bound, F.count(F.lit(1)).alias("bound_events"), bad)

    def counts(self) -> dict[str, int]:
        """Waits for the run to end."""
        return {**self._read.get, **self._bound.get}


def capture(
    row_events: DataFrame,
    columns: DataFrame,
    primary_keys: DataFrame,
    databases: str = "",
    tables: str = "",
    skipped: Skipped | None = None,
) -> DataFrame:
    """Change events of the wanted databases and tables.

    Tables are resolved and filtered, and the catalogs joined, once per rows event and before any cell is rendered. With
    `skipped`, the run that evaluates the result also counts what is left out.
    """
    events = resolve_tables(row_events, databases, tables, skipped and skipped.reading)
    return capture_resolved(skipped.bound(events) if skipped else events, columns, primary_keys)


def numbered_capture(
    row_events: DataFrame, columns: DataFrame, primary_keys: DataFrame, databases: str = "", tables: str = ""
) -> tuple[int, DataFrame]:
    """How many change events there are, and the change events with ids from 1 in log order.

    The ids come from headers: each event's number of readable rows (only their error texts are scanned) gives the id of
    its first row, which is looked up where the event is. Rows are rendered once, and neither shuffled nor sorted.
    """
    spark = row_events.sparkSession
    events = resolve_tables(row_events, databases, tables)
    chunk = F.floor(F.col("start_pos") / F.lit(chunk_bytes(spark))).alias("chunk")
    headers = events.select("file_no", chunk, "start_pos", good_rows().cast("bigint").alias("n")).filter("n > 0")
    earlier = Window.partitionBy("file_no", "chunk").orderBy("start_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = stored(headers.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1), "first-ids")
    counts = local.groupBy("file_no", "chunk").agg(F.sum("n").alias("rows"))
    offsets = running(
        counts, [], F.col("file_no"), [F.col("chunk")], {"before": Running("sum", F.col("rows"), inclusive=False)}
    ).select("file_no", "chunk", "before")
    firsts = local.join(offsets, ["file_no", "chunk"]).select(
        "file_no", (F.col("start_pos") - 1).alias("from_pos"), (F.col("first") + F.col("before")).alias("first_id")
    )
    total = local.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return total, capture_resolved(asof_join(events, firsts, ["file_no"], ["first_id"]), columns, primary_keys)


def _exploded(events: DataFrame) -> DataFrame:
    """The readable rows of events; with `first_id` also their ids."""
    if "first_id" not in events.columns:
        return readable_rows(events)
    placed = F.transform("rows", lambda row, i: F.struct(row.alias("row_change"), i.alias("row_index")))
    good = F.filter(placed, lambda r: r["row_change"]["error"].isNull())
    kept = [c for c in events.columns if c not in ("rows", "first_id")]
    found = events.select(*kept, "first_id", F.posexplode(good).alias("nth", "r"))
    return found.select(*kept, "r.*", (F.col("first_id") + F.col("nth")).cast("bigint").alias("id"))


def capture_resolved(events: DataFrame, columns: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """Change events of rows events whose tables are known."""
    named = lookup_join(events, keyed_catalog(columns, primary_keys), TABLE_KEY, spread_by=["file_no", "start_pos"])
    return change_events(_exploded(named))


def start_position(row_events: DataFrame, start_spec: str = "end", since: str | None = None) -> tuple[int, int] | None:
    """(file_no, pos) of one start specification; null for a log without events."""
    spec = row_events.sparkSession.createDataFrame([(start_spec, since)], "start_spec string, since string")
    found = resolve_start(spec, row_events).select("file_no", "pos").first()
    # Log positions are BIGINT; a larger requested one lies behind every event all the same.
    return None if found["file_no"] is None else (found["file_no"], min(int(found["pos"]), _MAX_POS))


def replay_since(
    row_events: DataFrame,
    columns: DataFrame,
    primary_keys: DataFrame,
    since: str | None = None,
    databases: str = "",
    tables: str = "",
    start_spec: str = "end",
) -> DataFrame:
    """Change events from an instant (or a start specification) on.

    As with a feed opened there, table maps before the position are not seen.
    """
    position = start_position(row_events, start_spec, since)
    if position is not None:
        row_events = from_position(row_events, *position)
    return capture(row_events, columns, primary_keys, databases, tables)
