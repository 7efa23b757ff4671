"""Reading of the tables that the operators work on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schema import CATALOG_COLUMN_ROWS, CATALOG_KEY_ROWS, ROW_EVENTS
from tidelog.streaming.batches import literal, rereadable

# Names of the information-schema views and of their columns.
_CATALOG_VIEWS = {
    "columns": ("information_schema.COLUMNS", CATALOG_COLUMN_ROWS),
    "primary_keys": ("information_schema.KEY_COLUMN_USAGE", CATALOG_KEY_ROWS),
}
_CATALOG_FIELDS = {
    "db_name": "TABLE_SCHEMA",
    "table_name": "TABLE_NAME",
    "constraint_name": "CONSTRAINT_NAME",
    "column_name": "COLUMN_NAME",
    "ordinal": "ORDINAL_POSITION",
}


def read_row_events(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """The landed row-change log. A log partitioned by `file_no` lets positions prune whole files."""
    if not stream:
        return spark.read.schema(ROW_EVENTS).parquet(path)
    reader = spark.readStream.schema(ROW_EVENTS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def of_files(session: SparkSession, files: list[str]) -> DataFrame:
        if not files:
            return session.createDataFrame([], ROW_EVENTS)
        plain = session.read.schema(ROW_EVENTS)
        if literal(path) == path:
            plain = plain.option("basePath", path)  # as the stream does, for folders that hold column values
        return plain.parquet(*[literal(f) for f in files])

    return rereadable(reader.parquet(path), of_files)


def read_catalog_rows(spark: SparkSession, kind: str, url: str, **options: str) -> DataFrame:
    """Catalog rows (`kind`: columns or primary_keys) straight from a database over JDBC.

    Filters on `db_name` and `table_name` are pushed to the database.
    """
    view, schema = _CATALOG_VIEWS[kind]
    rows = spark.read.format("jdbc").option("url", url).option("dbtable", view).options(**options).load()
    return rows.select(
        *[F.col(_CATALOG_FIELDS[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
