"""Selection from the event store for exports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.render import OPERATIONS
from tidelog.operators.ordering import order_by_id
from tidelog.schema import EVENT_STORE


def export_filter(
    store: DataFrame, db: str | None = None, table: str | None = None, operation: str | None = None
) -> DataFrame:
    """Exact filters, all optional."""
    if operation is not None and operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {', '.join(OPERATIONS)}: {operation!r}")
    for name, wanted in (("db_name", db), ("table_name", table), ("operation", operation)):
        if wanted is not None:
            store = store.filter(F.col(name) == wanted)
    return store


def export_events(
    store: DataFrame,
    db: str | None = None,
    table: str | None = None,
    operation: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The eight store columns of the wanted events in id order; write them with `export_json` or `export_csv`."""
    return order_by_id(export_filter(store.select(*EVENT_STORE.names), db, table, operation), limit)
