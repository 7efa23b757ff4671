"""Running aggregates over groups of any size.

A plain running window puts a whole group into one task. Here the group is cut into buckets along its order: the window
runs inside each bucket, one small row per bucket carries the aggregate of the buckets before it, and an equi-join
brings the two together. The join finds the rows already partitioned and sorted by the window, so they shuffle once.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Running:
    """One running aggregate: `sum`, `max` or `min` of a value, with or without the current row."""

    fold: str
    value: Column
    inclusive: bool = True


def _merge(fold: str, local: Column, carry: Column) -> Column:
    if fold == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    return F.greatest(local, carry) if fold == "max" else F.least(local, carry)


def running(
    df: DataFrame, keys: list[str], bucket: Column, order: list[Column], outputs: dict[str, Running]
) -> DataFrame:
    """Add running aggregates per `keys`, in the order of `order`.

    `bucket` must not decrease along `order`; keys and bucket must not be null. Memory of a task is bounded by one
    bucket, and by the number of buckets of one key (one slim row each).
    """
    names = list(outputs)
    staged = df.withColumn("_bucket", bucket)
    for name in names:
        staged = staged.withColumn(f"_value_{name}", outputs[name].value)

    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    local = staged
    for name in names:
        spec = outputs[name]
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if spec.inclusive else -1)
        local = local.withColumn(f"_local_{name}", _FOLD[spec.fold](f"_value_{name}").over(frame))

    totals = staged.groupBy(*keys, "_bucket").agg(
        *[_FOLD[outputs[name].fold](f"_value_{name}").alias(f"_total_{name}") for name in names]
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys,
        "_bucket",
        *[_FOLD[outputs[name].fold](f"_total_{name}").over(before).alias(f"_carry_{name}") for name in names],
    )

    joined = local.join(carry, [*keys, "_bucket"], "left")
    merged = [
        _merge(outputs[name].fold, F.col(f"_local_{name}"), F.col(f"_carry_{name}")).alias(name) for name in names
    ]
    kept = [c for c in df.columns if c not in names]
    return joined.select(*kept, *merged)
