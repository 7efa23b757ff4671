"""Column and primary-key catalogs, and their joins with events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup_join

TABLE_KEY = ["db_name", "table_name"]


def ordered_list(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """One row per group with its values collected in order.

    A group is the columns of one table, which a database bounds to a few thousand.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda p: p["v"]).alias(out))


def _one_table(df: DataFrame, db_name: str | None, table_name: str | None) -> DataFrame:
    if db_name is not None:
        df = df.filter(F.col("db_name") == db_name)
    if table_name is not None:
        df = df.filter(F.col("table_name") == table_name)
    return df


def catalog_columns(rows: DataFrame, db_name: str | None = None, table_name: str | None = None) -> DataFrame:
    """(db_name, table_name, columns): column names in ordinal order, for all tables or one."""
    return ordered_list(_one_table(rows, db_name, table_name), TABLE_KEY, "ordinal", "column_name", "columns")


def catalog_primary_keys(rows: DataFrame, db_name: str | None = None, table_name: str | None = None) -> DataFrame:
    """(db_name, table_name, pk_columns): columns of the constraint named PRIMARY, in ordinal order."""
    keys = _one_table(rows, db_name, table_name).filter(F.col("constraint_name") == "PRIMARY")
    return ordered_list(keys, TABLE_KEY, "ordinal", "column_name", "pk_columns")


def catalog_counts(columns: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """Number of tables with known columns and with a known primary key."""
    tables = columns.agg(F.count("*").alias("tables"))
    with_pk = primary_keys.agg(F.count("*").alias("tables_with_pk"))
    return tables.select("tables", with_pk.scalar().alias("tables_with_pk"))


def attach_columns(df: DataFrame, columns: DataFrame) -> DataFrame:
    """Add `columns`; an unknown table has an empty list."""
    joined = lookup_join(df, columns, TABLE_KEY)
    return joined.withColumn("columns", F.coalesce("columns", F.array().cast("array<string>")))


def attach_primary_keys(df: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """Add `pk_columns`; a table without a known key has an empty list."""
    joined = lookup_join(df, primary_keys, TABLE_KEY)
    return joined.withColumn("pk_columns", F.coalesce("pk_columns", F.array().cast("array<string>")))


def unknown_tables(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """The tables of the feed that the catalog lacks."""
    return df.select(*TABLE_KEY).distinct().join(catalog, TABLE_KEY, "left_anti")
