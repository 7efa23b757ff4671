"""The registered queries: each runs one operator over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samples import log as L
from samples.sql import ID_RANGE, LIMIT, NOW_TS, POSITION, REPLAY, SINCE, SINCE_TS, UNTIL, UNTIL_TS
from tidelog.functions import instants as I
from tidelog.functions import render as R
from tidelog.functions.csvtext import csv_field
from tidelog.functions.patterns import any_match, filter_changes, wildcard_match
from tidelog.operators import catalog as C
from tidelog.operators import positions as P
from tidelog.operators.ids import assign_ids, next_id
from tidelog.operators.resolve import (
    drop_bad_rows,
    explode_rows,
    rejected_rows,
    resolve_tables,
    rows_events_only,
    skipped_counts,
)
from tidelog.operators.seek import resolve_start, seek_positions
from tidelog.plans.capture import Skipped, capture, numbered_capture, replay_since
from tidelog.plans.export import export_events, export_filter
from tidelog.plans.inventory import inventory_current, log_inventory
from tidelog.settings import scratch_dir
from tidelog.sinks.change_log import at_or_above_level, change_log_lines, write_change_log
from tidelog.sinks.event_store import FULL, ID_ONLY, append_events, append_numbered, to_store_row
from tidelog.sinks.export import export_csv, export_json
from tidelog.sources.change_log import read_change_log
from tidelog.sources.event_store import read_event_store, register_event_store, store_commits
from tidelog.sources.files import names_in
from tidelog.sources.tables import read_row_events
from tidelog.streaming.batches import each_batch
from tidelog.streaming.capture import (
    capture_log,
    capture_stream,
    fan_out,
    log_sink,
    replay_refused,
    start_from,
    store_sink,
    table_sink,
)
from tidelog.streaming.state import resolve_tables_stream

Query = Callable[[SparkSession, str], DataFrame]

_PLACE = ["file_no", "start_pos", "row_index"]
_HEADER = ["log_name", "file_no", "start_pos", "end_pos", "ts_unix", "event_type", "table_id", "db_name", "table_name"]


def _catalogs(spark, sf) -> tuple[DataFrame, DataFrame]:
    return (
        C.catalog_columns(L.catalog_column_rows(spark, sf)),
        C.catalog_primary_keys(L.catalog_key_rows(spark, sf)),
    )


def _captured(spark, sf, databases="", tables="") -> DataFrame:
    return capture(L.row_events(spark, sf), *_catalogs(spark, sf), databases, tables)


def _flat_keys(events: DataFrame) -> DataFrame:
    """Lists as text, for comparison by value."""
    return events.withColumn("pk_columns", F.array_join("pk_columns", ","))


def _event_columns(events: DataFrame) -> DataFrame:
    flat = _flat_keys(events)
    return flat.select("timestamp", "event_time", "operation", "database", "table", "pk_columns", "primary_key", "row")


def _headers(events: DataFrame) -> DataFrame:
    return events.select(*_HEADER, F.size("rows").cast("bigint").alias("row_count"))


def _changed(spark, sf) -> DataFrame:
    return explode_rows(resolve_tables(L.row_events(spark, sf)))


def _named(spark, sf, names=lambda columns: columns) -> DataFrame:
    """The readable rows with their table's columns; `name_keys` are its names as keys, worked out once per table."""
    columns = _catalogs(spark, sf)[0].withColumn("name_keys", R.keys_of(names(F.col("columns"))))
    return C.attach_columns(drop_bad_rows(_changed(spark, sf)), columns)


def _feed(spark, sf) -> DataFrame:
    events = L.load(spark, sf, "events")
    return events.select("event_id", L.database_of(F.col("user_id")).alias("db_name"), F.col("event_type").alias("table_name"))


def _store(spark, sf, mode=FULL) -> DataFrame:
    """All events of the log, appended in two parts and read back."""
    path = scratch_dir(spark, "store")
    events = _captured(spark, sf)
    halfway = F.col("file_no") <= 5
    append_events(events.filter(halfway), path, mode)
    append_events(events.filter(~halfway), path, mode)
    return read_event_store(spark, path)


def _stored(df: DataFrame) -> DataFrame:
    return df.drop("captured_at")


# Sources


def q_read_row_events(spark, sf):
    return _headers(L.row_events(spark, sf))


def q_read_change_log(spark, sf):
    path = scratch_dir(spark, "change-log")
    write_change_log(_captured(spark, sf), path)
    noise = L.load(spark, sf, "events").select(
        F.when(F.col("event_id") % 2 == 0, F.lit('{"level":"INFO","message":"started"}'))
        .otherwise(F.concat(F.lit("not json "), F.col("props")))
    )
    noise.write.mode("append").text(path)
    return _event_columns(read_change_log(spark, path))


def q_catalog_columns(spark, sf):
    columns = C.catalog_columns(L.wide_catalog_rows(spark, sf))
    return columns.withColumn("columns", F.array_join("columns", ","))


def q_catalog_primary_keys(spark, sf):
    keys = C.catalog_primary_keys(L.wide_catalog_rows(spark, sf))
    return keys.withColumn("pk_columns", F.array_join("pk_columns", ","))


def q_catalog_counts(spark, sf):
    rows = L.wide_catalog_rows(spark, sf)
    return C.catalog_counts(C.catalog_columns(rows), C.catalog_primary_keys(rows))


def q_log_files(spark, sf):
    return P.log_files(L.row_events(spark, sf))


def q_current_position(spark, sf):
    return P.current_position(L.row_events(spark, sf))


def q_read_event_store(spark, sf):
    return _stored(_store(spark, sf))


def _store_in_parts(spark, sf) -> str:
    """All events of the log, appended in three parts by two writers."""
    path = scratch_dir(spark, "store")
    events = _captured(spark, sf)
    part = F.col("file_no") % 3
    for k, writer in enumerate(["first", "second", "first"]):
        append_events(events.filter(part == k), path, FULL, batch_id=k, writer=writer)
        append_events(events.filter(part == k), path, FULL, batch_id=k, writer=writer)  # the same append again
    return path


def q_store_commits(spark, sf):
    return store_commits(spark, _store_in_parts(spark, sf))


def q_store_id_range(spark, sf):
    return _stored(read_event_store(spark, _store_in_parts(spark, sf), *ID_RANGE))


def q_store_sql(spark, sf):
    """SQL over a store that is registered as a view."""
    register_event_store(spark, _store_in_parts(spark, sf), "kept_events")
    return spark.sql(
        "SELECT db_name, table_name, operation, count(*) AS events, min(event_time) AS earliest FROM kept_events "
        "GROUP BY db_name, table_name, operation"
    )


# Sinks


def q_change_log_lines(spark, sf):
    return change_log_lines(_captured(spark, sf), with_time=False)


def q_event_store_full(spark, sf):
    return _stored(_store(spark, sf, FULL))


def q_event_store_numbered(spark, sf):
    """Ids from headers: the whole log in one append."""
    path = scratch_dir(spark, "store")
    append_numbered(*numbered_capture(L.row_events(spark, sf), *_catalogs(spark, sf)), path, FULL)
    return _stored(read_event_store(spark, path))


def q_event_store_id_only(spark, sf):
    return _stored(_store(spark, sf, ID_ONLY))


def q_export_json_lines(spark, sf):
    path = scratch_dir(spark, "export-json")
    export_json(export_events(_store(spark, sf).withColumn("captured_at", F.col("event_time"))), path)
    return spark.read.text(path)


def q_export_csv_lines(spark, sf):
    path = scratch_dir(spark, "export-csv")
    export_csv(L.load(spark, sf, "documents").select("doc_id", "text", "lang", "source"), path)
    schema = "doc_id bigint, text string, lang string, source string"
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', lineSep="\n")


# Projections


def q_classify_operation(spark, sf):
    log = L.row_events(spark, sf)
    return log.select("file_no", "start_pos", "event_type", R.classify_operation(F.col("event_type")).alias("operation"))


def q_explode_rows(spark, sf):
    rows = _changed(spark, sf)
    return rows.select(
        *_PLACE,
        F.col("row_change.before").isNotNull().alias("has_before"),
        F.col("row_change.after").isNotNull().alias("has_after"),
        F.col("row_change.error").alias("error"),
    )


def q_name_cells(spark, sf):
    rows = _named(spark, sf)
    cells = F.coalesce("row_change.after", "row_change.before")
    return rows.select(*_PLACE, F.array_join(R.name_cells(cells, F.col("columns")), ",").alias("names"))


def _both_images() -> list:
    """The JSON of either image, null where there is none."""
    images = {side: F.col(f"row_change.{side}") for side in ("before", "after")}
    return [F.when(i.isNotNull(), R.keyed_image_json(i, F.col("name_keys"))).alias(side) for side, i in images.items()]


def q_row_json_missing_names(spark, sf):
    # Names of the first two columns only: the rest is named by place.
    return _named(spark, sf, lambda columns: F.slice(columns, 1, 2)).select(*_PLACE, *_both_images())


def q_row_image_json(spark, sf):
    return _named(spark, sf).select(*_PLACE, *_both_images())


def q_render_values(spark, sf):
    sides = F.explode(F.map_from_arrays(F.array(F.lit("before"), F.lit("after")), F.array("row_change.before", "row_change.after")))
    images = _changed(spark, sf).select(*_PLACE, sides.alias("side", "image"))
    cells = images.select(*_PLACE, "side", F.posexplode("image").alias("cell_no", "cell"))
    return cells.select(*_PLACE, "side", "cell_no", R.render_cell(F.col("cell")).alias("json"))


def q_render_bytes_hex(spark, sf):
    text = F.col("text").cast("binary")
    raw = F.when(F.col("doc_id") % 2 == 1, F.concat(F.unhex(F.lit("ff")), text)).otherwise(text)
    return L.load(spark, sf, "documents").select("doc_id", R.json_bytes(raw).alias("json"))


def q_row_envelope(spark, sf):
    return _captured(spark, sf).select(*_PLACE, "operation", "row")


def q_primary_key_json(spark, sf):
    return _captured(spark, sf).select(*_PLACE, "table", "primary_key")


def q_null_if_empty(spark, sf):
    rows = C.attach_primary_keys(drop_bad_rows(_changed(spark, sf)), _catalogs(spark, sf)[1])
    return rows.select(*_PLACE, F.array_join(R.null_if_empty(F.col("pk_columns")), ",").alias("pk_columns"))


def q_to_store_row(spark, sf):
    return _stored(to_store_row(_captured(spark, sf), FULL))


def q_format_event_time(spark, sf):
    return L.load(spark, sf, "events").select("event_id", I.format_event_time(L.unix_seconds("ts")).alias("text"))


def q_format_utc_z(spark, sf):
    orders = L.load(spark, sf, "orders")
    return orders.select("o_orderkey", I.format_utc_z(L.unix_seconds("o_orderdate")).alias("text"))


def q_parse_instant(spark, sf):
    return L.instant_texts(spark, sf).withColumn("seconds", I.parse_instant(F.col("text")))


def q_parse_start_spec(spark, sf):
    parsed = L.start_specs(spark, sf).withColumn("spec", I.parse_start_spec(F.col("start_spec")))
    return parsed.select(
        "event_id", "start_spec", "spec.kind", "spec.log_name", F.col("spec.pos").cast("string").alias("pos")
    )


def q_csv_field(spark, sf):
    return L.load(spark, sf, "documents").select("doc_id", csv_field(F.col("text")).alias("field"))


def q_position_label(spark, sf):
    label = I.position_label(F.col("log_name"), F.col("start_pos")).alias("label")
    return L.row_events(spark, sf).select("file_no", "start_pos", label)


# Filters


def q_wildcard_match(spark, sf):
    return L.load(spark, sf, "pages").select(
        "page_id",
        wildcard_match(F.col("url"), "http*page=?*&*").alias("by_url"),
        wildcard_match(F.col("html"), "*%%%*").alias("by_html"),
        any_match(F.col("url"), "*/fr/???, ").alias("by_end"),
    )


def _filtered(databases="", tables="") -> Query:
    return lambda spark, sf: filter_changes(_feed(spark, sf), databases, tables)


def q_rows_events_only(spark, sf):
    return _headers(rows_events_only(L.row_events(spark, sf)))


def q_skipped_counts(spark, sf):
    return skipped_counts(L.row_events(spark, sf))


def q_capture_counts(spark, sf):
    """What a capture left out, counted by the run that wrote its events."""
    skipped = Skipped()
    capture(L.row_events(spark, sf), *_catalogs(spark, sf), skipped=skipped).write.parquet(scratch_dir(spark, "events"))
    n = skipped.counts()
    counts = [(n["rows_events"], n["rows_events"] - n["bound_events"], n["bad_rows"])]
    return spark.createDataFrame(counts, "rows_events bigint, unbound_events bigint, bad_rows bigint")


def q_rejected_rows(spark, sf):
    return rejected_rows(L.row_events(spark, sf))


def q_drop_bad_rows(spark, sf):
    return drop_bad_rows(_changed(spark, sf)).select(*_PLACE)


def q_from_position(spark, sf):
    return _headers(P.from_position(L.row_events(spark, sf), *POSITION))


def q_export_filtered(spark, sf):
    return _stored(export_filter(_store(spark, sf), "app_1", "click", "UPDATE"))


def q_export_limit(spark, sf):
    return _stored(export_events(_store(spark, sf), limit=LIMIT))


def q_export_events(spark, sf):
    return _stored(export_events(_store(spark, sf), operation="INSERT", limit=500))


def q_files_overlapping(spark, sf):
    ranges = P.files_overlapping(P.file_time_ranges(L.row_events(spark, sf), NOW_TS), SINCE_TS, UNTIL_TS)
    return ranges.select("log_name", "file_no", "start_time", "end_time")


def q_level_filter(spark, sf):
    levels = F.array(*[F.lit(v) for v in ["debug", "INFO", "Warn", "WARNING", "error", "noise"]])
    lines = L.load(spark, sf, "events").select("event_id", F.get(levels, (F.col("event_id") % 6).cast("int")).alias("level"))
    return at_or_above_level(lines, "warning")


# Joins


def q_resolve_tables(spark, sf):
    resolved = resolve_tables(L.row_events(spark, sf))
    return resolved.select("file_no", "start_pos", "event_type", "table_id", "db_name", "table_name")


def q_resolve_alternating(spark, sf):
    """A log whose table ids go to and fro between names, resolved without room for a broadcast."""
    key = "spark.tidelog.broadcastBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1")
    try:
        resolved = resolve_tables(L.alternating_log(spark, sf))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return resolved.select("file_no", "start_pos", "event_type", "table_id", "db_name", "table_name")


def q_attach_columns(spark, sf):
    named = C.attach_columns(_feed(spark, sf), _catalogs(spark, sf)[0])
    return named.select("event_id", "db_name", "table_name", F.array_join("columns", ",").alias("columns"))


def q_attach_primary_keys(spark, sf):
    keyed = C.attach_primary_keys(_feed(spark, sf), _catalogs(spark, sf)[1])
    return keyed.select("event_id", "db_name", "table_name", F.array_join("pk_columns", ",").alias("pk_columns"))


def q_unknown_tables(spark, sf):
    return C.unknown_tables(_feed(spark, sf), _catalogs(spark, sf)[0])


def q_seek_positions(spark, sf):
    """Positions of the instants of all events, of 0 and of a time to come."""
    instants = L.load(spark, sf, "events").select(L.unix_seconds("ts").alias("target_ts"))
    edges = spark.createDataFrame([(0,), (4000000000,)], "target_ts bigint")
    return seek_positions(L.row_events(spark, sf), instants.unionByName(edges).distinct())


def q_resolve_start(spark, sf):
    resolved = resolve_start(L.start_specs(spark, sf), L.row_events(spark, sf))
    return resolved.select("event_id", "log_name", "file_no", F.col("pos").cast("string").alias("pos"))


# Aggregates and windows


def q_next_id(spark, sf):
    return next_id(_store(spark, sf))


def q_first_event_time(spark, sf):
    return P.first_event_time(L.row_events(spark, sf))


def q_file_time_ranges(spark, sf):
    return P.file_time_ranges(L.row_events(spark, sf), NOW_TS)


def q_inventory_totals(spark, sf):
    ranges = P.file_time_ranges(L.row_events(spark, sf), NOW_TS)
    return P.inventory_totals(P.files_overlapping(ranges, SINCE_TS, UNTIL_TS))


def q_event_offsets(spark, sf):
    return P.event_offsets(L.row_events(spark, sf).select("file_no", "end_pos"))


def q_assign_ids(spark, sf):
    return assign_ids(_changed(spark, sf).select(*_PLACE), start=1001)


# Commands


def q_capture(spark, sf):
    return _flat_keys(_captured(spark, sf))


def q_capture_filtered(spark, sf):
    return _flat_keys(_captured(spark, sf, databases="app_*", tables="*r*"))


def q_log_inventory(spark, sf):
    return log_inventory(L.row_events(spark, sf), NOW_TS, SINCE, UNTIL)


def q_inventory_current(spark, sf):
    return inventory_current(L.row_events(spark, sf))


def q_replay_since(spark, sf):
    return _flat_keys(replay_since(L.row_events(spark, sf), *_catalogs(spark, sf), since=REPLAY))


# Streams: the log lands in two parts, so that table maps of the first serve rows events of the second.


def _land(part: DataFrame, path: str) -> int:
    """Append a part of the log as it is read, without a shuffle; how many files lie below path then."""
    part.write.mode("append").parquet(path)
    return sum(n.startswith("part-") for n in names_in(part.sparkSession, path))


def _landed(spark, sf) -> tuple[str, int]:
    """The folder of the log, and the number of files of its first part: one micro-batch at every size."""
    path = scratch_dir(spark, "landed")
    early = F.col("start_pos") < 128000
    files = _land(L.part_of_log(spark, sf, early), path)
    _land(L.part_of_log(spark, sf, ~early), path)
    return path, files


_DRAIN = {"availableNow": True}


def _run_stream(spark, sf, sink, load=None, position=None, catalogs=None) -> None:
    landed, files = _landed(spark, sf)
    stream = start_from(read_row_events(spark, landed, stream=True, max_files=files), position)
    query = capture_stream(
        stream, *(catalogs or _catalogs(spark, sf)), sink, scratch_dir(spark, "stream"), load=load, trigger=_DRAIN
    )
    query.awaitTermination()


def _events_table(spark, path) -> DataFrame:
    return _flat_keys(spark.read.parquet(path).drop("writer", "batch_id"))


def q_stream_capture(spark, sf):
    path = scratch_dir(spark, "events")
    _run_stream(spark, sf, table_sink(path))
    return _events_table(spark, path)


def q_stream_from_position(spark, sf):
    path = scratch_dir(spark, "events")
    _run_stream(spark, sf, table_sink(path), position=POSITION)
    return _events_table(spark, path)


def q_stream_source_from_end(spark, sf):
    """A stream that is opened at the end of the log, before the rest of it lands."""
    path, landed = scratch_dir(spark, "events"), scratch_dir(spark, "landed")
    log = L.row_events(spark, sf)
    later = P.from_position(log, *POSITION)

    def land(part, mode):
        ordered = part.repartition("file_no").sortWithinPartitions("file_no", "start_pos")
        ordered.write.mode(mode).partitionBy("file_no").parquet(landed)

    land(log.filter((F.col("file_no") == POSITION[0]) & (F.col("start_pos") < POSITION[1])), "overwrite")
    query = capture_log(spark, landed, *_catalogs(spark, sf), table_sink(path), scratch_dir(spark, "stream"), start="end")
    try:
        query.processAllAvailable()
        land(later, "append")
        query.processAllAvailable()
    finally:
        query.stop()
    return _events_table(spark, path)


def q_stream_event_store(spark, sf):
    path = scratch_dir(spark, "store")
    _run_stream(spark, sf, store_sink(path, FULL))
    store = read_event_store(spark, path)
    return store.agg(
        F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.count_distinct("id").alias("ids"),
    )


def q_stream_resolve_tables(spark, sf):
    state, path = scratch_dir(spark, "state"), scratch_dir(spark, "resolved")

    def run(batch, batch_id):
        resolved = resolve_tables_stream(batch, batch_id, state)
        kept = resolved.select("file_no", "start_pos", "event_type", "table_id", "db_name", "table_name")
        kept.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    landed, files = _landed(spark, sf)
    stream = read_row_events(spark, landed, stream=True, max_files=files)
    writer = each_batch(stream, run).option("checkpointLocation", scratch_dir(spark, "checkpoint"))
    writer.trigger(**_DRAIN).start().awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


def q_stream_out_of_order(spark, sf):
    """Every log file in five parts of interleaved chunks, landed from the last part to the first."""
    state, path, landed = (scratch_dir(spark, n) for n in ("state", "resolved", "landed"))
    part = F.floor(F.col("start_pos") / 3000) % 5
    # Each part has as many files, as the headers are scanned alike for all: a micro-batch is a part.
    files = [_land(L.part_of_log(spark, sf, part == k), landed) for k in reversed(range(5))][0]

    def run(batch, batch_id):
        resolved = resolve_tables_stream(batch, batch_id, state)
        kept = resolved.select("file_no", "start_pos", "event_type", "table_id", "db_name", "table_name")
        kept.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    stream = read_row_events(spark, landed, stream=True, max_files=files)
    writer = each_batch(stream, run).option("checkpointLocation", scratch_dir(spark, "checkpoint"))
    writer.trigger(**_DRAIN).start().awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


def q_stream_refresh_catalog(spark, sf):
    """Capture that starts with empty catalogs and loads each table at first sight."""
    path = scratch_dir(spark, "events")
    columns, keys = _catalogs(spark, sf)

    def load(tables):
        return columns.join(tables, C.TABLE_KEY, "left_semi"), keys.join(tables, C.TABLE_KEY, "left_semi")

    _run_stream(spark, sf, table_sink(path), load=load, catalogs=(columns.limit(0), keys.limit(0)))
    return _events_table(spark, path)


def q_stream_fan_out(spark, sf):
    log_path, store_path = scratch_dir(spark, "log"), scratch_dir(spark, "store")
    _run_stream(spark, sf, fan_out(log_sink(log_path), store_sink(store_path)))
    return _event_columns(read_change_log(spark, log_path))


def q_stream_refused_batches(spark, sf):
    """A store that fails for the first two batches holds all events in the end; the log is unchanged."""
    log_path, store_path, refused = (scratch_dir(spark, n) for n in ("log", "store", "refused"))
    keep, calls = store_sink(store_path, FULL), []

    def failing(events, batch_id):
        calls.append(batch_id)
        if len(calls) <= 2:
            raise OSError("store is away")
        keep(events, batch_id)

    _run_stream(spark, sf, fan_out(log_sink(log_path), failing, refused=refused))
    for writer in names_in(spark, refused):
        replay_refused(spark, refused, writer.split("=")[1], keep)
    stored = read_event_store(spark, store_path).drop("id", "captured_at")
    logged = read_change_log(spark, log_path).select(F.lit("log").alias("kept_in"), "operation", "database", "table", "row")
    names = ["operation", F.col("db_name").alias("database"), F.col("table_name").alias("table"), F.col("row_data").alias("row")]
    return logged.unionByName(stored.select(F.lit("store").alias("kept_in"), *names))


def q_stream_read_change_log(spark, sf):
    path, out = scratch_dir(spark, "change-log"), scratch_dir(spark, "read")
    write_change_log(_captured(spark, sf), path)
    writer = read_change_log(spark, path, stream=True).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", scratch_dir(spark, "checkpoint")).trigger(**_DRAIN).start().awaitTermination()
    return _event_columns(spark.read.parquet(out))


def queries() -> dict[str, Query]:
    named = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return {
        **named,
        "filter_db_wildcard": _filtered("app_*"),
        "filter_table_wildcard": _filtered(tables="*r*, view,"),
        "filter_db_and_table": _filtered("app_?,legacy", "c*k,si*"),
    }
