"""Binding of rows events to their tables: the latest table map of the same id, earlier in the same file."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.patterns import pattern_filter
from tidelog.functions.render import ROW_EVENT_TYPES
from tidelog.operators.asof import asof_join, with_until
from tidelog.operators.scan import Running, running
from tidelog.settings import chunk_bytes
from tidelog.sources.files import stored

_ID = ["file_no", "table_id"]


def rows_events_only(row_events: DataFrame) -> DataFrame:
    """Drop events that carry no rows: table maps, metadata, and events without a readable body."""
    # Null as the rows are; who asks for headers only reads the error texts instead of all cells.
    return row_events.filter(F.col("event_type").isin(ROW_EVENT_TYPES) & F.col("rows.error").isNotNull())


def _chunk(df: DataFrame) -> Column:
    return F.floor(F.col("start_pos") / F.lit(chunk_bytes(df.sparkSession)))


def _is_map() -> Column:
    return F.col("event_type") == "TABLE_MAP"


def table_bindings(row_events: DataFrame) -> DataFrame:
    """(file_no, table_id, db_name, table_name, from_pos, last_pos): first and last map of each name of a table id.

    Logs repeat the map before each change. This is a plain aggregate, so the repeats vanish before the shuffle.
    """
    maps = row_events.filter(_is_map())
    return maps.groupBy(*_ID, "db_name", "table_name").agg(
        F.min("start_pos").alias("from_pos"), F.max("start_pos").alias("last_pos")
    )


def name_changes(maps: DataFrame, keys: list[str]) -> DataFrame:
    """The maps that bind a key to another name than the map before, as (keys, from_pos, db_name, table_name).

    Reads headers only. A key of any size is many chunks of log.
    """
    name = F.struct("db_name", "table_name")
    slim = maps.select(*keys, "start_pos", "db_name", "table_name")
    before = running(
        slim, keys, _chunk(slim), [F.col("start_pos")],
        {"_before": Running("max", F.struct("start_pos", "db_name", "table_name"), inclusive=False)},
    )
    earlier = F.struct("_before.db_name", "_before.table_name")
    changed = before.filter(F.col("_before").isNull() | ~earlier.eqNullSafe(name))
    return changed.select(*keys, F.col("start_pos").alias("from_pos"), "db_name", "table_name")


def name_points(maps: DataFrame, keys: list[str], path: str) -> DataFrame:
    """What `name_changes` gives, as a rule by one aggregate: first maps of names are enough where none comes back.

    Repeated maps vanish before the shuffle. The spans of names are kept at `path`.
    """
    spans = maps.groupBy(*keys, "db_name", "table_name").agg(
        F.min("start_pos").alias("from_pos"), F.max("start_pos").alias("last_pos")
    )
    spans.write.mode("overwrite").parquet(path)
    spans = maps.sparkSession.read.schema(spans.schema).parquet(path)
    if with_until(spans, keys).agg(F.max(F.col("last_pos") >= F.col("until_pos"))).first()[0]:
        return name_changes(maps, keys)
    return spans.select(*keys, "from_pos", "db_name", "table_name")


def _alternating(bindings: DataFrame) -> bool:
    """Whether a table id goes to and fro between names, so that first and last maps don't tell its spans."""
    spans = with_until(bindings, _ID)
    return bool(spans.agg(F.max(F.col("last_pos") > F.col("until_pos"))).first()[0])


def bind(events: DataFrame, maps: DataFrame, keys: list[str], databases: str = "", tables: str = "") -> DataFrame:
    """Events of the wanted tables with the names of the latest map of the same keys before them; others are left out."""
    wanted = pattern_filter(databases, tables)
    return asof_join(events, name_changes(maps, keys), keys, ["db_name", "table_name"], wanted=wanted)


def good_rows() -> Column:
    """How many rows of an event can be read; scans their error texts only."""
    return F.size(F.filter("rows.error", lambda error: error.isNull()))


def rejected_rows(row_events: DataFrame) -> DataFrame:
    """What a capture without filters leaves out, with its place: (log_name, file_no, start_pos, row_index, error).

    A row that cannot be read has its own error; an event without a table map is one line without a row_index.
    """
    points = name_changes(row_events.filter(_is_map() & F.col("table_id").isNotNull()), _ID)
    found = asof_join(rows_events_only(row_events), points, _ID, ["db_name", "table_name"], "left")
    place = ["log_name", "file_no", "start_pos"]
    unbound = F.col("db_name").isNull() & F.col("table_name").isNull()
    slim = found.select(*place, unbound.alias("unbound"), F.col("rows.error").alias("errors"))
    whole = slim.filter("unbound").select(
        *place, F.lit(None).cast("int").alias("row_index"), F.lit("no table map").alias("error")
    )
    single = slim.filter("not unbound").select(*place, F.posexplode("errors").alias("row_index", "error"))
    return whole.unionByName(single.filter(F.col("error").isNotNull()))


def resolve_tables(
    row_events: DataFrame,
    databases: str = "",
    tables: str = "",
    reading: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows events of the wanted tables with `db_name` and `table_name`; an event without an earlier map is skipped.

    No event is shuffled, however many maps there are (see `asof_join`). As a rule one aggregate over the maps gives the
    spans of names; where a table id goes to and fro between names, the maps' headers are walked in log order. `reading`
    gets all rows events before their tables are known, to count them.
    """
    events = rows_events_only(row_events)
    if reading:
        events = reading(events)
    # A small table, written once: the tests on it and the join read that, not the log again.
    bindings = stored(table_bindings(row_events), "bindings")
    if _alternating(bindings):
        maps = row_events.filter(_is_map() & F.col("table_id").isNotNull())
        return bind(events, maps, _ID, databases, tables)
    points = bindings.filter(F.col("table_id").isNotNull()).drop("last_pos")
    return asof_join(events, points, _ID, ["db_name", "table_name"], wanted=pattern_filter(databases, tables))


def skipped_counts(row_events: DataFrame) -> DataFrame:
    """One row of what a capture leaves out: of `rows_events`, those without a table map, and rows that cannot be read."""
    resolved = resolve_tables(row_events)
    bad = F.size(F.filter("rows", lambda row: row["error"].isNotNull()))
    found = resolved.agg(F.count("*").alias("bound"), F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("bad_rows"))
    total = rows_events_only(row_events).agg(F.count("*").alias("rows_events"))
    # One row each.
    joined = total.join(F.broadcast(found), F.col("rows_events") >= F.col("bound"))
    return joined.select("rows_events", (F.col("rows_events") - F.col("bound")).alias("unbound_events"), "bad_rows")


def explode_rows(events: DataFrame) -> DataFrame:
    """One output per changed row, in order: `row_index` and `row_change` (before, after, error)."""
    kept = [c for c in events.columns if c != "rows"]
    return events.select(*kept, F.posexplode("rows").alias("row_index", "row_change"))


def drop_bad_rows(rows: DataFrame) -> DataFrame:
    """Skip rows that could not be read; the other rows of their event stay."""
    return rows.filter(F.col("row_change.error").isNull())


def readable_rows(events: DataFrame) -> DataFrame:
    """The rows of `explode_rows` that `drop_bad_rows` keeps. Who only counts them reads places and error texts, no cells."""
    kept = [c for c in events.columns if c != "rows"]
    placed = events.select(*kept, "rows", F.posexplode("rows.error").alias("row_index", "_error")).filter(F.col("_error").isNull())
    return placed.select(*kept, "row_index", F.element_at("rows", F.col("row_index") + 1).alias("row_change"))
