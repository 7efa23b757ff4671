"""Equi-joins of large facts with lookup tables whose size is not known beforehand."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.settings import broadcast_bytes, salts


def encoded_bytes(df: DataFrame) -> int:
    """Size of a table, measured as the length of its rows as JSON. Runs one aggregate over it."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Join facts with a lookup table on `keys` (`how`: inner, left, left_semi or left_anti).

    A lookup below the size limit is broadcast, so the facts stay where they are. A larger one is joined by shuffle:
    each fact key is spread over salts (taken from `spread_by`) against as many copies of the lookup, so one hot key is
    shared by many tasks. `at_most` is a known bound on the lookup's bytes; without it the lookup is measured.
    """
    size = encoded_bytes(lookup) if at_most is None else at_most
    if size <= broadcast_bytes(facts.sparkSession):
        return facts.join(F.broadcast(lookup), keys, how)
    n = salts(facts.sparkSession)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(n)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
