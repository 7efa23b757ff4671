"""A row-change log, catalogs and specifications derived from the `events` and `orders` tables.

Each row of `events` becomes one rows event with one to three changed rows, as a rule preceded by its table map. Some
maps are missing, table ids are bound anew in the middle of a file, some events have no readable body and some rows an
error, and every fifth file starts with 25 metadata events without a time.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import ROW_EVENTS
from tidelog.settings import scratch_dir
from tidelog.sources.tables import read_row_events

# Fixed values, shared with the SQL in samples/sql.py.
TABLES = ["click", "error", "purchase", "signup", "view"]
EVENT_KINDS = [
    "WRITE", "WRITE_V1", "UPDATE", "UPDATE_V1", "PARTIAL_UPDATE", "DELETE", "DELETE_V1", "WRITE", "UPDATE", "DELETE",
]
NAMES = ["user_id", "value", "props", "at", "day", "gap", "score", "blob", "big", "extra"]
# Names per table: surplus ones (click), an empty and a repeated one and too few (view), none at all (signup).
CATALOG = {
    "click": [*NAMES, "surplus_a", "surplus_b"],
    "purchase": NAMES,
    "error": ["{id}", *NAMES[1:]],
    "view": ["user_id", "", "props", "user_id"],
}
PRIMARY = {"click": ["user_id"], "purchase": ["user_id", "day"], "view": ["user_id"]}
EVENTS_PER_FILE = 1000

_ROWS = ROW_EVENTS["rows"].dataType
_CELL = _ROWS.elementType["after"].dataType.elementType


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def unix_seconds(ts: str) -> Column:
    """Seconds of a zone-less timestamp column, independent of the session time zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast({ts} as timestamp_ntz))")


def database_of(user_id: Column) -> Column:
    return F.when(user_id % 4 == 3, F.lit("legacy")).otherwise(F.concat(F.lit("app_"), (user_id % 4).cast("string")))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """The source rows with their place in the log."""
    e = F.col("event_id")
    type_no = F.array_position(F.array(*[F.lit(t) for t in TABLES]), F.col("event_type")) - 1
    placed = load(spark, sf, "events").select(
        e,
        F.floor(e / EVENTS_PER_FILE).alias("_f"),
        (e % EVENTS_PER_FILE).alias("seq"),
        F.expr("cast(ts as timestamp_ntz)").alias("ts"),
        unix_seconds("ts").alias("ts_unix"),
        "user_id",
        type_no.alias("type_no"),
        F.col("event_type").alias("table_name"),
        database_of(F.col("user_id")).alias("db_name"),
        "value",
        "props",
    )
    return placed.select(
        "*",
        (F.col("_f") + 1).alias("file_no"),
        F.concat(F.lit("changelog."), F.lpad((F.col("_f") + 1).cast("string"), 6, "0")).alias("log_name"),
        (100 + (4 * F.col("type_no") + F.col("user_id") % 4 + 7 * F.floor(F.col("seq") / 500)) % 20).alias("table_id"),
        (516 + 256 * F.col("seq")).alias("base"),
        (e % 97 != 0).alias("has_map"),
    )


def _cell(kind: str, **fields: Column) -> Column:
    values = {"kind": F.lit(kind), **fields}
    return F.struct(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _CELL.fields]
    )


def _parts(dtype: T.StructType, *values: Column) -> Column:
    return F.struct(*[v.cast(f.dataType).alias(f.name) for f, v in zip(dtype.fields, values)])


def _fixed_cells() -> dict[str, Column]:
    """The cells that all images of an event share; each is made once per event."""
    e, ts = F.col("event_id"), F.col("ts")
    zero = F.lit(0)
    micros = F.expr("cast(date_part('second', ts) * 1000000 as bigint) % 1000000")
    day = [F.year(ts), F.month(ts), F.dayofmonth(ts)]
    date, clock = _CELL["dt"].dataType, _CELL["tm"].dataType
    return {
        "_props": _cell("bytes", b=F.col("props").cast("binary")),
        "_at": _cell("date", dt=_parts(date, *day, F.hour(ts), F.minute(ts), F.second(ts), micros)),
        "_day": _cell("date", dt=_parts(date, *day, zero, zero, zero, zero)),
        "_gap": _cell("time", tm=_parts(clock, e % 2 == 1, e % 40, e % 24, e % 60, e % 60, e % 1000000)),
        "_blob": _cell("bytes", b=F.concat(F.unhex(F.lit("ff")), e.cast("string").cast("binary"))),
        "_big": _cell("uint", u=F.lit(Decimal(18446744073709551615)) - e),
        "_extra": F.when(e % 2 == 0, _cell("null")).otherwise(
            _cell("json", raw=F.concat(F.lit('{"n":'), e.cast("string"), F.lit("}")))
        ),
    }


def _image(i: Column, shift: float) -> Column:
    """Ten cells, one of each kind."""
    value = F.col("value") + i + F.lit(shift)
    return F.array(
        _cell("int", i=F.col("user_id") + i),
        _cell("double", d=value),
        *[F.col(name) for name in ("_props", "_at", "_day", "_gap")],
        _cell("float", f=value.cast("float")),
        *[F.col(name) for name in ("_blob", "_big", "_extra")],
    )


_landed: dict[tuple[str, str], str] = {}


# Log files per part of the landed log, so that neither its files nor its tasks grow small.
FILES_PER_PART = 64


def _parts_of(spark: SparkSession, sf: str) -> int:
    last = load(spark, sf, "events").agg(F.max("event_id")).first()[0] or 0
    return max(2 * spark.sparkContext.defaultParallelism, last // (EVENTS_PER_FILE * FILES_PER_PART) + 1)


def row_events(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log as a capture agent would land it: in log order, a part per FILES_PER_PART log files.

    Derived from the tables once per application. A folder per log file would be a small file per 1,000 events to write, to
    list and to open in every scan; in parts in log order, bounds on `file_no` skip what lies outside all the same.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _landed:
        path = scratch_dir(spark, "row-events")
        # What is put in order is the source rows, from one scan; the log's events, and the changed rows, by far the most bytes,
        # are made where they are written.
        _with_rows(_headers(spark, sf, _parts_of(spark, sf))).write.parquet(path)
        _landed[key] = path
    return read_row_events(spark, _landed[key])


_headed: dict[tuple[str, str], str] = {}


def part_of_log(spark: SparkSession, sf: str, part: Column) -> DataFrame:
    """The events of the log whose headers pass a filter, to be landed.

    The headers are put in order and kept once per application, with the source columns; rows are made where they are written.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _headed:
        path = scratch_dir(spark, "headers")
        _headers(spark, sf, _parts_of(spark, sf)).write.parquet(path)
        _headed[key] = path
    headers = spark.read.schema(_headers(spark, sf).schema).parquet(_headed[key])
    return _with_rows(headers.filter(part))


def derive_row_events(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log, derived from `events`."""
    return _with_rows(_headers(spark, sf))


# Source columns that the changed rows are made of.
_SOURCE = ["event_id", "ts", "user_id", "value", "props"]


def _headers(spark: SparkSession, sf: str, parts: int | None = None) -> DataFrame:
    """The whole log without its changed rows; an event that has some carries `_kind` and its source columns.

    Each source row becomes its events where it is: metadata at the start of a file, its map, its rows event. With `parts` the
    log is in order, in so many parts; ranges of events keep a hot file from ending up in one task.
    """
    events = _events(spark, sf)
    if parts:
        events = events.repartitionByRange(parts, "event_id").sortWithinPartitions("event_id")
    e = F.col("event_id")
    fields = [f for f in ROW_EVENTS.fields if f.name != "rows"]
    own = ["start_pos", "end_pos", "ts_unix", "event_type", "table_id", "db_name", "table_name"]
    types = {f.name: f.dataType for f in fields}

    def event(kind: Column = F.lit(None), **columns: Column) -> Column:
        values = [columns.get(n, F.lit(None)).cast(types[n]).alias(n) for n in own]
        return F.struct(*values, kind.cast("string").alias("_kind"))

    metadata = F.transform(
        F.sequence(F.lit(0), F.when(F.col("file_no") % 5 == 0, 24).otherwise(1)),
        lambda k, _: event(
            start_pos=4 + 16 * k,
            end_pos=F.when(k == F.when(F.col("file_no") % 5 == 0, 24).otherwise(1), 516).otherwise(20 + 16 * k),
            ts_unix=F.lit(0), event_type=F.lit("OTHER"),
        ),
    )
    table_map = event(
        start_pos=F.col("base"), end_pos=F.col("base") + 64, event_type=F.lit("TABLE_MAP"),
        **{n: F.col(n) for n in ("ts_unix", "table_id", "db_name", "table_name")},
    )
    kind = F.get(F.array(*[F.lit(k) for k in EVENT_KINDS]), (e % 10).cast("int"))
    rows = event(
        F.when((e % 53 != 0) & (e % 211 != 7), kind),
        start_pos=F.col("base") + F.when(F.col("has_map"), 64).otherwise(0),
        end_pos=F.col("base") + 256,
        ts_unix=F.col("ts_unix"), event_type=F.when(e % 53 == 0, F.lit("OTHER")).otherwise(kind), table_id=F.col("table_id"),
    )
    usual = F.when(F.col("has_map"), F.array(table_map, rows)).otherwise(F.array(rows))
    made = F.when(F.col("seq") == 0, F.concat(metadata, usual)).otherwise(usual)
    made = events.select("log_name", "file_no", *_SOURCE, F.explode(made).alias("_e"))
    placed = [F.col(f"_e.{f.name}" if f.name in own else f.name).cast(f.dataType).alias(f.name) for f in fields]
    return made.select(*placed, *_SOURCE, "_e._kind")


def _with_rows(headers: DataFrame) -> DataFrame:
    """The log's events, those of a `_kind` with their changed rows."""
    e, kind = F.col("event_id"), F.col("_kind")
    changed = F.transform(
        F.sequence(F.lit(0), (e % 3).cast("int")),
        lambda i: F.struct(
            F.when(~kind.startswith("WRITE"), _image(i, -0.5)).alias("before"),
            F.when(~kind.startswith("DELETE"), _image(i, 0.0)).alias("after"),
            F.when((e + i) % 31 == 5, F.lit("unreadable row")).alias("error"),
        ),
    )
    rows = F.when(kind.isNotNull(), changed).cast(_ROWS).alias("rows")
    cells = {name: F.when(kind.isNotNull(), cell) for name, cell in _fixed_cells().items()}
    return headers.withColumns(cells).select(*[rows if f.name == "rows" else f.name for f in ROW_EVENTS.fields])


def alternating_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log as if the server had three table ids only: each is bound to another name again and again."""
    return row_events(spark, sf).withColumn("table_id", F.col("table_id") % 3)


def _catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    return events.select(database_of(F.col("user_id")).alias("db_name"), F.col("event_type").alias("table_name")).distinct()


def _names(table: str) -> Column:
    fallback = F.when(F.col("db_name") == "legacy", F.lit("ID")).when(F.col("db_name") == "app_2", F.lit("Id"))
    return F.array(*[fallback.otherwise(F.lit("id")) if n == "{id}" else F.lit(n) for n in CATALOG[table]])


def catalog_column_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(db_name, table_name, column_name, ordinal) of the tables in the feed."""
    names = F.coalesce(*[F.when(F.col("table_name") == t, _names(t)) for t in CATALOG])
    listed = _catalog_tables(spark, sf).select("db_name", "table_name", F.posexplode(names).alias("ordinal", "column_name"))
    return listed.withColumn("ordinal", (F.col("ordinal") + 1).cast("bigint"))


def catalog_key_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(db_name, table_name, constraint_name, column_name, ordinal): primary keys and other constraints."""
    keys = F.coalesce(
        *[F.when(F.col("table_name") == t, F.array(*[F.lit(n) for n in names])) for t, names in PRIMARY.items()]
    )
    # app_1.purchase has a key column that its rows lack.
    keys = F.when(
        (F.col("db_name") == "app_1") & (F.col("table_name") == "purchase"), F.array(F.lit("user_id"), F.lit("gone"))
    ).otherwise(keys)
    tables = _catalog_tables(spark, sf)
    primary = tables.select(
        "db_name", "table_name", F.lit("PRIMARY").alias("constraint_name"), F.posexplode(keys).alias("ordinal", "column_name")
    )
    other = tables.select(
        "db_name", "table_name", F.lit("uq_score").alias("constraint_name"), F.lit(0).alias("ordinal"),
        F.lit("score").alias("column_name"),
    )
    return primary.unionByName(other).withColumn("ordinal", (F.col("ordinal") + 1).cast("bigint"))


def wide_catalog_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A large catalog: every customer a database, every priority a table, every order a column."""
    orders = load(spark, sf, "orders")
    return orders.select(
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("db_name"),
        F.col("o_orderpriority").alias("table_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("PRIMARY"))
        .otherwise(F.concat(F.lit("fk_"), F.col("o_orderstatus"))).alias("constraint_name"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("column_name"),
        F.col("o_orderkey").alias("ordinal"),
    )


def instant_texts(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, text): each event's time in one of the accepted forms or in one that must be refused."""
    e = F.col("event_id")
    ts = F.expr("cast(ts as timestamp_ntz)")
    day_time = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    with_t = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    forms = [
        F.concat(with_t, F.lit("Z")),
        F.concat(with_t, F.lit("+08:00")),
        with_t,
        day_time,
        F.concat(with_t, F.lit(".987654-03:30")),
        F.date_format(ts, "yyyy-MM-dd"),
        F.date_format(ts, "yyyy-MM-dd HH:mm"),
        F.concat(F.lit("x"), day_time),
        F.date_format(ts, "yyyy-13-dd HH:mm:ss"),
    ]
    return load(spark, sf, "events").select("event_id", F.get(F.array(*forms), (e % len(forms)).cast("int")).alias("text"))


def start_specs(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, start_spec, since): a start specification per event, some with an instant."""
    e = F.col("event_id")
    file = F.concat(F.lit("changelog."), F.lpad((F.floor(e / EVENTS_PER_FILE) + 1).cast("string"), 6, "0"))
    forms = [
        F.lit("end"),
        F.lit("start"),
        F.concat(file, F.lit(":"), e.cast("string")),
        F.concat(F.lit("dir:"), file, F.lit(":"), e.cast("string")),
        file,
        F.concat(file, F.lit(":notanumber")),
        F.concat(file, F.lit(":18446744073709551616")),
    ]
    since = F.when(e % 3 == 0, F.col("text"))
    return instant_texts(spark, sf).select(
        "event_id", F.get(F.array(*forms), (e % len(forms)).cast("int")).alias("start_spec"), since.alias("since")
    )
