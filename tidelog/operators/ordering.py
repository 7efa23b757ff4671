"""Sort by id with an optional limit of any size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.scan import Running, running

_IDS_PER_BUCKET = 1 << 20
_BUCKETS_PER_GROUP = 4096


def _bound(df: DataFrame, n: int) -> tuple[int, int] | None:
    """The n-th smallest id, and how many of its rows are among the first n; null when there are no more than n rows."""
    counts = df.groupBy(F.floor(F.col("id") / _IDS_PER_BUCKET).alias("bucket")).agg(F.count("*").alias("rows"))
    before = running(
        counts,
        [],
        F.floor(F.col("bucket") / _BUCKETS_PER_GROUP),
        [F.col("bucket")],
        {"before": Running("sum", F.col("rows"), inclusive=False)},
    )
    hit = before.filter((F.col("before") <= n) & (F.col("before") + F.col("rows") > n)).first()
    if hit is None:
        return None
    low = hit["bucket"] * _IDS_PER_BUCKET
    inside = df.filter((F.col("id") >= low) & (F.col("id") < low + _IDS_PER_BUCKET))
    # One row per id of the bucket.
    upto = F.sum("count").over(Window.orderBy("id")) + hit["before"]
    ids = inside.groupBy("id").count().withColumn("upto", upto)
    at = ids.filter(F.col("upto") > n).orderBy("id").first()
    return at["id"], n - (at["upto"] - at["count"])


def order_by_id(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows in id order, at most `limit` of them (0 gives none); of rows that share the last id, as many as fit."""
    if limit is None:
        return df.orderBy("id")
    if limit < 0:
        raise ValueError("limit must not be negative")
    bound = _bound(df, limit)
    if bound is None:
        return df.orderBy("id")
    # An id bound reaches the scan, where it skips row groups.
    below = df.filter(F.col("id") < bound[0])
    if bound[1]:
        below = below.unionByName(df.filter(F.col("id") == bound[0]).limit(bound[1]))
    return below.orderBy("id")
