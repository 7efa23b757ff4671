"""Schemas of the tables that the operators read and write."""

from pyspark.sql import types as T

_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_TEXTS = T.ArrayType(_TEXT)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# One column value of a row image. `kind` names the field in use:
# null | bytes (b) | int (i) | uint (u) | float (f) | double (d) | date (dt) | time (tm) | json (raw)
CELL = struct(
    kind=_TEXT,
    b=T.BinaryType(),
    i=_LONG,
    u=T.DecimalType(20, 0),
    f=T.FloatType(),
    d=T.DoubleType(),
    dt=struct(y=_INT, mo=_INT, d=_INT, h=_INT, mi=_INT, s=_INT, us=_INT),
    tm=struct(neg=T.BooleanType(), days=_INT, h=_INT, mi=_INT, s=_INT, us=_INT),
    raw=_TEXT,
)
ROW_CHANGE = struct(before=T.ArrayType(CELL), after=T.ArrayType(CELL), error=_TEXT)

ROW_EVENTS = struct(
    log_name=_TEXT,
    file_no=_LONG,
    start_pos=_LONG,
    end_pos=_LONG,
    ts_unix=_LONG,
    event_type=_TEXT,
    table_id=_LONG,
    db_name=_TEXT,
    table_name=_TEXT,
    rows=T.ArrayType(ROW_CHANGE),
)

CHANGE_EVENTS = struct(
    timestamp=_TEXT,
    event_time=_LONG,
    operation=_TEXT,
    database=_TEXT,
    table=_TEXT,
    pk_columns=_TEXTS,
    primary_key=_TEXT,
    row=_TEXT,
    log_name=_TEXT,
    file_no=_LONG,
    start_pos=_LONG,
    row_index=_INT,
)

# `primary_key` is a variant when lines are read, because text would not tell "42" from 42.
CHANGE_LINES = struct(
    time=_TEXT,
    level=_TEXT,
    timestamp=_TEXT,
    event_time=_LONG,
    operation=_TEXT,
    database=_TEXT,
    table=_TEXT,
    pk_columns=_TEXTS,
    primary_key=T.VariantType(),
    row=_TEXT,
)

EVENT_STORE = struct(
    id=_LONG,
    captured_at=_TEXT,
    event_time=_TEXT,
    operation=_TEXT,
    db_name=_TEXT,
    table_name=_TEXT,
    primary_key=_TEXT,
    row_data=_TEXT,
)
STORE_COMMITS = struct(folder=_TEXT, first=_LONG, rows=_LONG, number=_LONG, writer=_TEXT, batch_id=_LONG)

CATALOG_COLUMN_ROWS = struct(db_name=_TEXT, table_name=_TEXT, column_name=_TEXT, ordinal=_LONG)
CATALOG_KEY_ROWS = struct(db_name=_TEXT, table_name=_TEXT, constraint_name=_TEXT, column_name=_TEXT, ordinal=_LONG)

# State between micro-batches.
TABLE_MAPS = struct(log_name=_TEXT, file_no=_LONG, table_id=_LONG, start_pos=_LONG, db_name=_TEXT, table_name=_TEXT)
COVERAGE = struct(file_no=_LONG, from_pos=_LONG, to_pos=_LONG)
LOADED_TABLES = struct(db_name=_TEXT, table_name=_TEXT, columns=_TEXTS, pk_columns=_TEXTS)
