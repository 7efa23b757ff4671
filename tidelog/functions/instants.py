"""Instants and log positions as text."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_U64_MAX = Decimal(18446744073709551615)


def _utc_text(seconds: Column, pattern: str) -> Column:
    """Format unix seconds in UTC, whatever the session time zone is (a zone-less timestamp has none)."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    zero = F.lit(0)
    return F.date_format(epoch + F.make_dt_interval(zero, zero, zero, seconds), pattern)


def format_event_time(seconds: Column) -> Column:
    """Unix seconds as `2026-04-17T10:00:00+00:00`."""
    return _utc_text(seconds, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def format_utc_z(seconds: Column) -> Column:
    """Unix seconds as `2026-04-17T10:00:00Z`; null stays null."""
    return _utc_text(seconds, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def now_text(pattern: str) -> Column:
    """The time of this run in UTC (one value for the whole run)."""
    micros = F.unix_micros(F.current_timestamp())
    return _utc_text(micros.cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)"), pattern)


def parse_instant(text: Column) -> Column:
    """Text to unix seconds; null marks text that is not an instant.

    Accepted: RFC 3339 with `Z` or an offset (a fraction is cut), and `date time` or `dateTtime` without a zone,
    read as UTC. The shape is checked first because a Spark cast alone also takes partial dates and times.
    """
    zoned = r"^(\d{4}-\d{2}-\d{2})[Tt ](\d{2}:\d{2}:\d{2})(?:\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
    plain = r"^(\d{4}-\d{1,2}-\d{1,2})[T ](\d{1,2}:\d{1,2}:\d{1,2})$"

    def seconds(pattern: str) -> Column:
        day = F.regexp_extract(text, pattern, 1)
        # A leap second counts as the second before it.
        clock = F.regexp_replace(F.regexp_extract(text, pattern, 2), ":60$", ":59")
        stamp = F.concat(day, F.lit(" "), clock, F.lit("Z"))
        return F.unix_seconds(stamp.try_cast("timestamp_ltz"))

    zone = F.regexp_extract(text, zoned, 3)
    hours = F.substring(zone, 2, 2).try_cast("int")
    minutes = F.substring(zone, 5, 2).try_cast("int")
    offset = F.when(F.lower(zone) == "z", F.lit(0)).when(
        (hours < 24) & (minutes < 60),
        F.when(F.substring(zone, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1)) * (hours * 3600 + minutes * 60),
    )
    return F.when(text.rlike(zoned), seconds(zoned) - offset).when(text.rlike(plain), seconds(plain))


def parse_start_spec(text: Column) -> Column:
    """`end`, `start` or `<file>:<position>` to a struct (kind, log_name, pos); kind is null for any other text.

    The last colon separates; a position is an unsigned 64-bit number.
    """
    at = r"(?s)^(.*):\+?0*([0-9]{1,20})$"
    pos = F.regexp_extract(text, at, 2).try_cast("decimal(20,0)")
    is_at = text.rlike(at) & (pos <= F.lit(_U64_MAX))
    kind = F.when(text.isin("end", "start"), text).when(is_at, F.lit("at"))
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "at", F.regexp_extract(text, at, 1)).alias("log_name"),
        F.when(kind == "at", pos).alias("pos"),
    )


def file_number(log_name: Column) -> Column:
    """Numeric suffix of a log file name; files are ordered by it, never by name (999999 precedes 1000000)."""
    return F.regexp_extract(log_name, r"([0-9]+)$", 1).try_cast("bigint")


def position_label(log_name: Column, pos: Column) -> Column:
    """`file:position`."""
    return F.concat_ws(":", log_name, pos.cast("string"))
